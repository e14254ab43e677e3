"""Nested category nodes to flat rows, level by level."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallweave.functions.jsonx import json_items, usable_member
from stallweave.functions.text import child_path, link_category_id
from stallweave.session import materialise
from stallweave.sources.landed import menu_roots

#: Alternative keys of a node, in order of preference.
ID_KEYS = ("id", "code", "key")
NAME_KEYS = ("text", "name", "title", "label")
LINK_KEYS = ("link", "url", "href")
CHILD_KEYS = ("children", "sub_menu", "items")

_NODE_KEYS = ID_KEYS + NAME_KEYS + LINK_KEYS + CHILD_KEYS


def flatten_tree(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows ``menu_id … raw_node`` for every node of every payload, next to the other columns of ``df``.

    Each round opens one level of all trees at once: a node is parsed once for its texts and once for its types, its children
    become the next frontier.  A level is written once to the shared folder, so round ``n`` reads only level
    ``n - 1``.  The driver loops over depth, never over rows; a text holds no cycle, so the loop ends.
    """
    carried = [name for name in df.columns if name != payload]
    frontier = menu_roots(df, payload, "raw_node").select(
        *carried,
        "raw_node",
        F.lit(None).cast("string").alias("parent_menu_id"),
        F.lit(None).cast("bigint").alias("parent_category_id"),
        F.lit(None).cast("string").alias("parent_path"),
    )
    levels: list[DataFrame] = []
    for depth in count(1):
        level = materialise(_open_level(frontier, carried, depth), f"tree-{depth}")
        levels.append(level)
        parents = level.where(~F.col("is_leaf"))
        if parents.isEmpty():
            break
        frontier = parents.select(
            *carried,
            F.explode("children").alias("raw_node"),
            F.col("menu_id").alias("parent_menu_id"),
            F.col("category_id").alias("parent_category_id"),
            F.col("path").alias("parent_path"),
        )
    rows = reduce(DataFrame.unionByName, levels)
    identified = F.coalesce("menu_id", F.col("category_id").cast("string"), "category_name").isNotNull()
    return rows.where(identified).drop("children")


def _open_level(frontier: DataFrame, carried: list[str], depth: int) -> DataFrame:
    raw = {key: f"_{key}" for key in _NODE_KEYS}
    pick = lambda keys: F.coalesce(*[usable_member(F.col("_typed"), F.col(raw[k]), k) for k in keys])
    typed = frontier.withColumn("_typed", F.try_parse_json("raw_node"))
    opened = typed.select("*", F.json_tuple("raw_node", *_NODE_KEYS).alias(*raw.values())).select(
        *carried,
        "raw_node",
        "parent_menu_id",
        "parent_category_id",
        "parent_path",
        pick(ID_KEYS).alias("menu_id"),
        pick(NAME_KEYS).alias("category_name"),
        pick(LINK_KEYS).alias("link"),
        F.coalesce(json_items(pick(CHILD_KEYS)), F.array().cast("array<string>")).alias("children"),
    )
    return opened.select(
        *carried,
        "menu_id",
        link_category_id(F.col("link")).alias("category_id"),
        "category_name",
        "link",
        "parent_menu_id",
        "parent_category_id",
        F.lit(depth).alias("level"),
        child_path(F.col("parent_path"), F.col("category_name")).alias("path"),
        (F.size("children") == 0).alias("is_leaf"),
        "raw_node",
        "children",
    )
