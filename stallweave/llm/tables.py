"""Helpers the operators share: intermediate tables, batched Arrow output, text folds."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallweave.session import materialise, scratch_path

__all__ = ["ascii_lower", "crc_of", "drop_path", "materialise", "per_worker", "read", "scratch_path", "sliced", "slices", "stored"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; texts without other letters take the cheap built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def crc_of(key: Column) -> Column:
    """crc32 of a key written as text; null for null."""
    return F.crc32(key.cast("string").cast("binary"))


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Like ``materialise``, with the path, for tables that a loop drops as soon as they are used up."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a table that ``stored`` wrote."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def sliced(work: Callable[[pa.RecordBatch], pa.RecordBatch], most_bytes: int = 8 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs ``work`` over slices of about ``most_bytes``, so that a task's memory follows its longest text, not its batch.

    At its end a task gives back what its worker's allocators hold, since workers outlive tasks and share their executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(work, slices(batches, most_bytes))
        give_back()

    return run


def give_back() -> None:
    """Returns freed memory of this process to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def slices(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``most_bytes``, by the mean size of their rows."""
    for batch in batches:
        rows = max(1, batch.num_rows * most_bytes // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def per_worker(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a Python worker; the package's own globals travel anew with every task.

    A worker keeps one such object, the last one asked for: workers live on from stage to stage, and what earlier stages
    made must not add up in them.
    """
    kept = sys.modules.setdefault("stallweave_worker", types.ModuleType("stallweave_worker")).__dict__
    if kept.get("name") != name:
        if "name" in kept:
            kept["value"] = None
            give_back()
        kept["value"], kept["name"] = make(), name
    return kept["value"]
