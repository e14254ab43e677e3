"""Landed JSON documents to rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallweave.functions.jsonx import json_items, json_text
from stallweave.schemas import ROTATION_STATE
from stallweave.sources.parquet import is_absent

#: Members of a menu payload that may hold its tree, in order of preference; the first one
#: holds it under ``items``.
MENU_MEMBERS = ("menu_block", "menu", "items", "data")


def read_documents(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Landed documents as ``path`` and whole ``payload``: one per file, or one per line of larger files."""
    return spark.read.text(path, wholetext=one_per_file).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload")
    )


def page_items(pages: DataFrame, payload: str = "payload", field: str = "$.data", alias: str = "item") -> DataFrame:
    """One row per element of the page's list; pages without a list give no rows."""
    kept = [F.col(name) for name in pages.columns if name != payload]
    return pages.select(*kept, F.explode(json_items(json_text(F.col(payload), field))).alias(alias))


def _list_text(c: Column) -> Column:
    """Text of a JSON array with at least one element."""
    return F.when(c.startswith("[") & (c != "[]"), c)


def menu_roots(df: DataFrame, payload: str = "payload", alias: str = "node") -> DataFrame:
    """One row per top-level node of a menu payload, else of the first member that lists objects.

    One ``json_tuple`` call probes all named places; only payloads without any are read member by member.
    """
    kept = [F.col(name) for name in df.columns if name != payload]
    names = [f"_{member}" for member in MENU_MEMBERS]
    probed = df.select(*kept, payload, F.json_tuple(payload, *MENU_MEMBERS).alias(*names))
    block, *others = [F.col(name) for name in names]
    members = F.map_values(F.from_json(payload, "map<string,string>"))
    listed = F.get(F.filter(members, lambda v: v.rlike(r"^\s*\[\s*\{")), 0)
    chosen = F.coalesce(_list_text(json_text(block, "$.items")), *[_list_text(c) for c in others], listed)
    return probed.select(*kept, F.explode(json_items(chosen)).alias(alias))


def read_state(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Rotation state documents to ``(category_id, last_crawled_at)``; empty when none was written."""
    try:
        documents = read_documents(spark, path, one_per_file)
    except AnalysisException as err:
        if is_absent(err):
            return spark.createDataFrame([], ROTATION_STATE)
        raise
    parsed = F.from_json("payload", "updated_at STRING, watermark MAP<STRING,STRING>")
    return documents.select(F.explode(parsed["watermark"]).alias("k", "v")).select(
        F.col("k").try_cast("bigint").alias("category_id"), F.col("v").try_cast("timestamp").alias("last_crawled_at")
    )
