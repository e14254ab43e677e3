"""Small aggregates and top-k cuts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_by_group(df: DataFrame, group: str, measure: str) -> DataFrame:
    """A1."""
    return df.groupBy(group).agg(F.max(measure).alias(measure))


def distinct_by_group(df: DataFrame, group: str, counted: str, alias: str) -> DataFrame:
    """A2: Spark first removes duplicates per (group, value), so a hot group is counted in parallel."""
    return df.groupBy(group).agg(F.countDistinct(counted).alias(alias))


#: log2 of the registers of distinct sketches: 2**14 give a standard error of 0.8 %.
SKETCH_BITS = 14


def distinct_sketches(df: DataFrame, groups: Sequence[str], counted: str) -> DataFrame:
    """A2: (groups, sketch): one mergeable sketch of the distinct values per group, a few KB whatever the group holds.

    Nulls are not counted.  Sketches of runs are stored as they are made and merged later (``merged_sketches``), so a new run
    costs its own size.
    """
    return df.groupBy(*groups).agg(F.hll_sketch_agg(F.col(counted).cast("string"), SKETCH_BITS).alias("sketch"))


def merged_sketches(sketches: DataFrame, groups: Sequence[str], alias: str) -> DataFrame:
    """A2: estimated distinct values per group over all its stored sketches."""
    return sketches.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(alias))


def coverage(df: DataFrame, column: str, n: int) -> DataFrame:
    """A4: most frequent values."""
    return top_k(df.groupBy(column).agg(F.count("*").alias("n")), n, F.col("n").desc(), F.asc_nulls_last(column))


def row_count(df: DataFrame, name: str) -> DataFrame:
    """A5."""
    return df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """L1-L4: planned as TakeOrderedAndProject, ``k`` rows per task."""
    return df.orderBy(*order).limit(k)


def sample_one(df: DataFrame) -> DataFrame:
    """L6."""
    return df.limit(1)


def has_rows(df: DataFrame) -> bool:
    """L6."""
    return not df.isEmpty()


def profile(tables: dict[str, DataFrame], values: bool = False) -> DataFrame:
    """One row per column of every table: position, name, type, rows and columns of the table.

    With ``values`` also the nulls of each column, exactly, and its distinct values, by a sketch (about 1 %); every table is
    scanned once and one row per task moves.
    """
    return reduce(DataFrame.unionByName, [_profile_one(name, df, values) for name, df in tables.items()])


def _profile_one(name: str, df: DataFrame, values: bool) -> DataFrame:
    fields = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
            *([F.col(f"_nulls_{i}").alias("null_count"), F.hll_sketch_estimate(f"_sketch_{i}").alias("distinct_estimate")] if values else []),
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    counts = [
        c
        for i, f in enumerate(df.schema.fields, start=1)
        for c in (F.count_if(F.col(f.name).isNull()).alias(f"_nulls_{i}"), F.hll_sketch_agg(F.col(f.name).cast("string"), SKETCH_BITS).alias(f"_sketch_{i}"))
        if values
    ]
    return df.agg(F.count("*").alias("row_count"), *counts).select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(len(fields)).alias("column_count"),
        F.inline(F.array(*fields)),
    )


def sample_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """One example row per table as JSON text."""
    samples = [
        df.limit(1).select(F.lit(name).alias("table_name"), F.to_json(F.struct("*")).alias("sample"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, samples)
