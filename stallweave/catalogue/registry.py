"""Names, queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the equivalent SQL where there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def plain(df: DataFrame, *as_text: str) -> DataFrame:
    """Types both engines print alike: times, dates and whole numbers with gaps as text, floats as double."""

    def column(field: T.StructField):
        c = F.col(field.name)
        if field.name in as_text:
            c = c.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def as_text(*columns: str) -> str:
    """SQL side of ``plain``: the star list with these columns as text."""
    return "* REPLACE (" + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns) + ")"
