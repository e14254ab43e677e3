"""One or N rows per key.

The plan is always ``row_number() … <= n``: Spark then limits every key inside each input partition before the
shuffle (WindowGroupLimit), so a key holding a third of all rows moves at most ``n`` rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A column name means "descending, NULLs last"; pass a Column for anything else.
Order = str | Column


def _ordering(order: Sequence[Order]) -> list[Column]:
    return [F.desc_nulls_last(o) if isinstance(o, str) else o for o in order]


def _total_order(df: DataFrame) -> list[Column]:
    """Tiebreak over the whole row: the winner does not depend on partitioning or file order."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return [F.xxhash64(*plain).desc()]


def ranked(
    df: DataFrame, keys: Sequence[Order], order: Sequence[Order], rank: str, tiebreak: Sequence[Order] | None = None
) -> DataFrame:
    ties = _total_order(df) if tiebreak is None else _ordering(tiebreak)
    window = Window.partitionBy(*keys).orderBy(*_ordering(order), *ties)
    return df.withColumn(rank, F.row_number().over(window))


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[Order],
    order: Sequence[Order],
    n: int,
    rank: str = "rn",
    tiebreak: Sequence[Order] | None = None,
) -> DataFrame:
    """The first ``n`` rows of every group with their rank."""
    return ranked(df, keys, order, rank, tiebreak).where(F.col(rank) <= n)


def latest_per_key(
    df: DataFrame, keys: Sequence[Order], order: Sequence[Order], tiebreak: Sequence[Order] | None = None
) -> DataFrame:
    """The newest row per key.  NULL keys form one group; filter them first (P3) where unwanted."""
    return top_n_per_group(df, keys, order, 1, "_rn", tiebreak).drop("_rn")


def canonical_per_key(df: DataFrame, keys: Sequence[Order], level: str, seen: str) -> DataFrame:
    """The shallowest row per key, then the newest."""
    return latest_per_key(df, keys, [F.asc_nulls_last(level), F.desc_nulls_last(seen)])


def merge_latest(prev: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """Cumulative merge of an earlier state and new observations; the order of merging does not matter."""
    return latest_per_key(prev.unionByName(new), keys, order)


def concat_ranked(df: DataFrame, key: str, text: str, rank: str, sep: str, alias: str) -> DataFrame:
    """A3: texts of a group joined in rank order; meant for groups already cut to their first N rows."""
    return df.groupBy(key).agg(
        F.expr(f"listagg({text}, '{sep}') WITHIN GROUP (ORDER BY {rank})").alias(alias)
    )


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of the named columns."""
    return df.select(*columns).distinct()
