"""Tables with one row per key that grow by the rows that changed.

A table is a folder of batches, ``batch=<n>/bucket=<b>/``, and one small pointer file that names those which count.  A
batch holds the new rows of the keys it changed, at most one each; the latest batch that has a key has its row.  Keys are
dealt to a fixed number of buckets and sorted inside them, so a few keys are looked up in a few folders and, by the
files' statistics and Bloom filters, in a few row groups.  The pointer is replaced in one step after its batch is written:
readers find the former table or the new one, never none, and what a lost driver leaves behind is not named.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from stallweave.operators.dedupe import Order, latest_per_key
from stallweave.session import materialise

#: Buckets of a table unless its first batch says otherwise.
BUCKETS = 64
_OWN = ("changed_in", "bucket", "batch")

#: Codec of logs and tables: their texts take little more than half of what the default leaves of them.
CODEC = "zstd"


class Pointer:
    """A small JSON document that readers see whole: the former one until the new one has taken its place."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.jvm = spark._jvm
        self.at = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.at.getFileSystem(spark._jsc.hadoopConfiguration())

    def read(self) -> Any:
        """The document, or ``None`` before the first."""
        if not self.fs.exists(self.at):
            return None
        stream = self.fs.open(self.at)
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, document: Any) -> None:
        beside = self.at.suffix(".next")
        self.fs.mkdirs(self.at.getParent())
        stream = self.fs.create(beside, True)
        stream.write(bytearray(json.dumps(document).encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        overwrite = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(context.makeQualified(beside), context.makeQualified(self.at), overwrite)


def counted(rows: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """The number of rows that ``write`` writes, taken while it does.

    The count belongs to the tasks that write, after all shuffles; Spark counts each of their partitions once, however
    often its task is repeated.  ``write`` must therefore not shuffle.
    """
    seen = Observation()
    write(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


class KeyedTable:
    """One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        self.pointer = Pointer(spark, f"{self.root}/current.json")

    def state(self) -> dict:
        """``batch`` (the last number), ``live`` (batches that count, the base first), ``schema``, ``buckets``, ``inputs``."""
        return self.pointer.read() or {"batch": 0, "live": [], "schema": None, "buckets": self.buckets, "inputs": {}}

    def bucket_of(self, key: Column, state: dict) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(state["buckets"])).cast("int")

    def read(self) -> DataFrame:
        """Current rows, without the table's own columns."""
        state = self.state()
        return self._current(state, None).drop(*_OWN)

    def lookup(self, keys: DataFrame | None) -> DataFrame:
        """Current rows of some ``keys`` (a DataFrame with the key column), from the buckets these are in; of all keys for ``None``."""
        if keys is None:
            return self.read()
        state = self.state()
        wanted = keys.select(F.col(self.key)).where(F.col(self.key).isNotNull()).distinct()
        buckets = [r[0] for r in wanted.select(self.bucket_of(F.col(self.key), state)).distinct().collect()]
        return self._current(state, buckets).drop(*_OWN).join(wanted, self.key, "left_semi")

    def changed_since(self, batch: int) -> DataFrame:
        """Keys whose row is newer than ``batch``, read from newer batches and a base that was made since."""
        state = self.state()
        newer = [n for k, n in enumerate(state["live"]) if n > batch or k == 0]
        return self._rows(state, newer, None).where(F.col("changed_in") > batch).select(self.key).distinct()

    def merge(self, rows: DataFrame, order: Sequence[Order], inputs: dict | None = None) -> int:
        """New observations, at most one per key; the first by ``order`` of these and the present row stays.

        Equal rows stay what they are, so merging the same observations again changes nothing.  Returns the rows changed.
        """
        state = self._with_schema(rows)
        rows = rows.where(F.col(self.key).isNotNull())
        former = None
        if state["live"]:
            # Read twice, for the keys and for the rows; the first rows of a table are read once and go straight to its first batch.
            rows = materialise(rows, "observed")
            former = self.lookup(rows).withColumn("_former", F.lit(1))
        both = rows.withColumn("_former", F.lit(0))
        both = both if former is None else both.unionByName(former)
        ties = [F.xxhash64(*[f["name"] for f in state["schema"]["fields"]]).desc(), F.col("_former").desc()]
        newest = latest_per_key(both, [self.key], order, ties)
        return self._commit(newest.where("_former = 0").drop("_former"), state, inputs)

    def put(self, rows: DataFrame, inputs: dict | None = None) -> int:
        """K5: new rows of some keys, one each; those equal to the present row are left out.  Returns the rows changed."""
        state = self._with_schema(rows)
        if state["live"]:
            rows = materialise(rows, "rebuilt")
            names = [f["name"] for f in state["schema"]["fields"]]
            former = self.lookup(rows).select(F.col(self.key).alias("_key"), F.struct(*names).alias("_former"))
            joined = rows.join(former, F.col(self.key) == F.col("_key"), "left")
            same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col("_former")[n]) for n in names])
            rows = joined.where(F.col("_former").isNull() | ~same).select(*names)
        return self._commit(rows, state, inputs)

    def compact(self) -> None:
        """Folds all batches into one base; rows keep the number of the batch that changed them."""
        state = self.state()
        if len(state["live"]) > 1:
            self._commit(self._current(state, None).drop("bucket", "batch"), {**state, "live": []}, None)

    def _with_schema(self, rows: DataFrame) -> dict:
        state = self.state()
        return state if state["schema"] else {**state, "schema": json.loads(rows.schema.json())}

    def _commit(self, rows: DataFrame, state: dict, inputs: dict | None) -> int:
        batch = state["batch"] + 1
        if "changed_in" not in rows.columns:
            rows = rows.withColumn("changed_in", F.lit(batch).cast("long"))
        dealt = rows.withColumn("bucket", self.bucket_of(F.col(self.key), state)).hint("rebalance", "bucket").sortWithinPartitions("bucket", self.key)
        written = counted(
            dealt,
            lambda df: df.write.mode("overwrite").partitionBy("bucket").option("compression", CODEC).option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            .parquet(f"{self.root}/batch={batch}"),
        )
        live = [*state["live"], batch] if written else state["live"]
        self.pointer.write({**state, "batch": batch if written else state["batch"], "live": live, "inputs": {**state["inputs"], **(inputs or {})}})
        return written

    def _rows(self, state: dict, batches: list[int], buckets: list[int] | None) -> DataFrame:
        """Rows of some batches; only their folders are listed, and only some buckets of them read."""
        fields = StructType.fromJson(state["schema"]) if state["schema"] else StructType([])
        schema = StructType([*fields.fields, StructField("changed_in", LongType()), StructField("bucket", IntegerType()), StructField("batch", IntegerType())])
        if not batches:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", self.root).parquet(*[f"{self.root}/batch={n}" for n in batches])
        return found if buckets is None else found.where(F.col("bucket").isin(buckets))

    def _current(self, state: dict, buckets: list[int] | None) -> DataFrame:
        """The latest row of every key.  Only keys of later batches compete; the base is not shuffled while these are few."""
        live = state["live"]
        base = self._rows(state, live[:1], buckets)
        if len(live) < 2:
            return base
        later = latest_per_key(self._rows(state, live[1:], buckets), [self.key], ["batch"], [])
        return base.join(later.select(self.key), self.key, "left_anti").unionByName(later)
