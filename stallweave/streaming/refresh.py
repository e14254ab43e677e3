"""Bronze files to a silver table in micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stallweave.operators.dedupe import latest_per_key
from stallweave.sinks.bronze import run_folders
from stallweave.sinks.keyed import Pointer
from stallweave.sinks.tables import VersionedTable

#: Fixed value: collection units per refresh.
FILES_PER_BATCH = 5

_OUTCOME_ROW = "batch_id BIGINT, status STRING, row_count BIGINT, error STRING"
OUTCOMES = _OUTCOME_ROW + ", completed_at TIMESTAMP"


def bronze_stream(
    spark: SparkSession, root: str, schema: StructType, files_per_batch: int | None = FILES_PER_BATCH, archive: str | None = None,
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """New files below ``root``, ``files_per_batch`` at a time, or as many as hold ``bytes_per_batch`` (``"10g"``).

    Batches by size are the choice for large logs, whose files may be many and small.

    With ``archive`` Spark moves consumed files there.  Moving lags behind processing, so exactly-once rests
    on the checkpoint of the query and not on the move.
    """
    reader = spark.readStream.schema(schema)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    elif files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(root)


def silver_stream(
    stream: DataFrame,
    table: VersionedTable,
    transform: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    outcomes: str,
    parked: str,
    compact_every: int = 20,
) -> StreamingQuery:
    """Add every micro-batch to ``table``; an outcome row closes each batch.

    A batch costs its own size: its latest rows are written beside the table and folded in every
    ``compact_every`` batches.  Versions start at 1 and follow the batch id, so a replay changes nothing, and
    the newest observation wins in whatever order batches arrive.  A batch whose transformation fails does
    not stop the stream: its raw rows are parked for ``retry_parked``.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, batch_id + 1
        rows = batch.count()  # read from file footers
        try:
            table.add(transform(batch), version)
            status, error = "ok", None
        except Exception as err:  # noqa: BLE001 - ingestion goes on, the rows are kept
            batch.write.mode("overwrite").parquet(f"{parked}/batch={batch_id}")
            status, error = "failed", f"{type(err).__name__}: {err}"
        outcome = spark.createDataFrame([(batch_id, status, rows, error)], _OUTCOME_ROW)
        outcome.withColumn("completed_at", F.current_timestamp()).coalesce(1).write.mode("append").json(outcomes)
        if version % compact_every == 0:
            table.compact()

    return (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Last outcome of every batch; a replayed batch has recorded more than one."""
    rows = spark.read.schema(OUTCOMES).json(path)
    return latest_per_key(rows, ["batch_id"], ["completed_at"])


def retry_parked(
    spark: SparkSession, table: VersionedTable, transform: Callable[[DataFrame], DataFrame], parked: str, schema: StructType
) -> int:
    """Adds parked rows once their problem is fixed; late adding gives the same table.  Returns the batches added.

    Only batches not added before are read, and only their rows are written.  They are noted last: a driver lost before adds
    them again, which changes nothing.
    """
    done = Pointer(spark, f"{parked}/added.json")
    added = done.read() or []
    waiting = [run for run in run_folders(spark, parked, ("batch",)) if run not in added]
    if waiting:
        rows = spark.read.schema(schema).parquet(*[f"{parked}/{run}" for run in waiting])
        table.amend(transform(rows).select(table.schema.names))
        done.write(added + waiting)
    return len(waiting)
