"""Landing rows and the records kept beside them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stallweave.functions.clock import as_clock, run_dt, run_id
from stallweave.functions.jsonx import nested_to_text
from stallweave.session import materialise
from stallweave.sinks.keyed import CODEC, counted


def stamp(df: DataFrame, run_clock: dt.datetime | str | Column, **constants) -> DataFrame:
    """Provenance columns of a run plus any constants (category slot, page, ...)."""
    clock = as_clock(run_clock)
    return df.withColumns(
        {
            **{name: F.lit(value) for name, value in constants.items()},
            "extracted_at": run_id(clock),
            "dt": run_dt(clock),
            "run_id": run_id(clock),
        }
    )


def append_partitioned(
    df: DataFrame, root: str, partitions: tuple[str, ...] = ("dt", "run_id"), one_run: bool = False, max_rows: int = 0
) -> int:
    """Append below ``root/dt=…/run_id=…``; nested columns become JSON text.  Returns the rows written.

    The rows of one run share their partition values, so every task writes its own file (``one_run``, no
    shuffle).  A mixed log is rebalanced first: a value holding a third of the rows is split over tasks, small
    ones share a task instead of leaving one file per task.  An empty batch leaves no file.
    """
    flat = nested_to_text(df)
    ready = flat if one_run else flat.hint("rebalance", *partitions)
    return counted(ready, lambda rows: rows.write.mode("append").option("compression", CODEC).option("maxRecordsPerFile", max_rows).partitionBy(*partitions).parquet(root))


#: Folder value of a NULL partition column, as Hive and Spark write it.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def run_folders(spark: SparkSession, root: str, partitions: Sequence[str] = ("dt", "run_id")) -> list[str]:
    """K8: the runs of a log, as their folders below ``root`` (``dt=…/run_id=…``).

    Only folders are listed, level by level; the driver holds one name for each run.  A missing log has none.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [""] if fs.exists(at(root)) else []
    for column in partitions:
        below = []
        for folder in found:
            names = [s.getPath().getName() for s in fs.listStatus(at(f"{root}/{folder}" if folder else root)) if s.isDirectory()]
            below += [f"{folder}/{n}" if folder else n for n in names if n.startswith(f"{column}=")]
        found = below
    return sorted(found)


#: Place of a row in a log: 22 bits for its file, by the path's hash, and 40 for its number in the file.
PLACE = "_place"


def read_runs(
    spark: SparkSession, root: str, schema: StructType, runs: Sequence[str], partitions: Sequence[str] = ("dt", "run_id"), places: bool = False
) -> DataFrame:
    """The rows of some runs of a log and nothing else, with their ``places`` where these are asked for.

    Only their folders are given to the scan, and the runs stand in it as literals on the partition columns, so the plan's
    ``PartitionFilters`` name them.
    """
    if not runs:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(PLACE, F.lit(0).cast("bigint")) if places else empty
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION))) for c in partitions]
    read = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{run}" for run in runs])
    if places:
        file = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(1 << 22))
        read = read.select("*", (F.shiftleft(file, 40) + F.col("_metadata.row_index")).alias(PLACE))
    named = [unquote(run) for run in runs]
    for column, values in zip(partitions, zip(*[run.split("/") for run in runs])):
        if f"{column}={NULL_PARTITION}" not in values:
            read = read.where(F.col(column).cast("string").isin(sorted({unquote(v.split("=", 1)[1]) for v in values})))
    return read.where(F.concat_ws("/", *parts).isin(named))


#: Bitmaps that a join holds at most: 4 KB for 32,768 rows of a log, so 256 MB for two thousand million.
_MOST_BITMAPS = 65_536


def newest_rows(log: DataFrame, key: Column, stamp: str) -> DataFrame:
    """Of a log read with ``places`` the rows with the latest ``stamp`` of their key, all that share it; a cut by the whole
    order finds the same rows in these.

    A log sees its keys again in file after file, so a cut of whole rows moves most of them.  Here key, stamp and place move; the places
    that are kept come back as one bit for each row of the log, and the others are dropped as the log is read again.  Two files of one
    hash only leave more rows in.  A log too long for that stays as it is.
    """
    places = log.select(key.alias("_key"), F.col(stamp).alias("_stamp"), PLACE)
    # Rows without a key are one more; they share no rank, so that few of them move.
    apart = F.when(F.col("_key").isNull(), F.col(PLACE))
    newest = Window.partitionBy("_key").orderBy(F.desc_nulls_last("_stamp"), apart)
    kept = places.withColumn("_rank", F.rank().over(newest)).where("_rank <= 1")
    number = F.col(PLACE) + 1
    block, bit = F.bitmap_bucket_number(number), F.bitmap_bit_position(number)
    blocks = kept.select(block.alias("_block"), bit.alias("_bit")).repartition("_block").groupBy("_block")
    bitmaps = materialise(blocks.agg(F.bitmap_construct_agg("_bit").alias("_bits")), "newest")
    own = [c for c in log.columns if c != PLACE]
    if bitmaps.count() > _MOST_BITMAPS:
        return log.select(*own)
    # Sent to all tasks, whatever Spark takes for small: anything else would move the whole log.
    met = log.withColumns({"_block": block, "_bit": bit}).join(F.broadcast(bitmaps), "_block")
    byte = F.conv(F.hex(F.expr("substring(_bits, CAST(_bit DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    return met.where(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).select(*own)


def landed_rows(spark: SparkSession, root: str, run_clock: dt.datetime | str) -> int:
    """Rows of one run as they lie in bronze: one partition, counted from file footers.

    Counting what was written, not what passed through the tasks, stays right when tasks are repeated.
    """
    clock = as_clock(run_clock)
    named = spark.range(1).select(run_dt(clock).alias("dt"), run_id(clock).alias("run_id")).first()
    return spark.read.parquet(f"{root.rstrip('/')}/dt={named['dt']}/run_id={named['run_id']}").count()


def write_manifest(
    spark: SparkSession, path: str, run_clock: dt.datetime | str, row_count: int, entity: str | None = None
) -> None:
    """K3: completion record of a run; a run that produced nothing must not look complete."""
    if row_count <= 0:
        raise ValueError("no rows were written: refusing to record the run as complete")
    clock = as_clock(run_clock)
    spark.range(1).select(
        run_dt(clock).alias("dt"),
        run_id(clock).alias("run_id"),
        F.lit(entity).cast("string").alias("entity"),
        F.lit(row_count).cast("bigint").alias("row_count"),
        F.current_timestamp().alias("completed_at"),
    ).write.mode("append").json(path)


def csv_preview(df: DataFrame, path: str, rows: int = 100) -> None:
    """K6: a readable sample beside the batch."""
    df.limit(rows).write.mode("overwrite").csv(path, header=True)


def split_rejects(df: DataFrame, accepted: Column) -> tuple[DataFrame, DataFrame]:
    """K7: rows that parsed and rows that did not; a NULL verdict counts as rejected."""
    verdict = F.coalesce(accepted, F.lit(False))
    return df.where(verdict), df.where(~verdict)


def write_rejects(rejects: DataFrame, root: str) -> None:
    """K7: raw payloads that gave no rows, by date, for a later parser."""
    rejects.hint("rebalance", "dt").write.mode("append").partitionBy("dt").json(root)


def write_run_rejects(rejects: DataFrame, root: str, partitions: Sequence[str] = ("dt", "run_id")) -> int:
    """K7: rejects of some runs, beside those of all others; a run consumed again replaces its own.  Returns the rows written."""

    def write(rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(root)

    return counted(rejects.hint("rebalance", *partitions), write)
