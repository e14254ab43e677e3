"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Settings that change results or plan shape.  Sizes such as shuffle partitions are left to the cluster;
#: adaptive execution coalesces small shuffle partitions and splits skewed ones at run time.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans are built column by column from Python; recording a call site for each would cost more than the call.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "stallweave", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; keyword settings use ``__`` for ``.`` and win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` as the cluster names it.

    A local master without the setting uses the session's warehouse folder; anywhere else its absence is an error,
    because a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared"


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_root(spark)}/stallweave/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, *parts: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; a reader of some values of ``parts`` reads their folders only.

    Cuts the lineage for iterative work: the rows survive the loss of any executor and are computed once
    (an eager ``checkpoint()`` would compute them twice).
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the execution that wrote them; otherwise they lie on the disks until the driver collects garbage.

    For work that writes what it makes: an execution of the same DataFrame again would shuffle again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def side_by_side(spark: SparkSession, work: Sequence[Callable[[], Any]]) -> list[Any]:
    """Independent jobs at once, results in their order: the last tasks of one leave no core idle while others wait.

    Spark gives free cores to whichever job has tasks, so no more of them run together than otherwise.  All are waited for; then the
    first error in order is raised.
    """
    with ThreadPoolExecutor(max(1, len(work))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in work]
    return [job.result() for job in running]
