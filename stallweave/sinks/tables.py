"""Tables that are replaced or merged without overwriting what is being read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stallweave.operators.dedupe import Order, latest_per_key
from stallweave.sinks.keyed import Pointer, counted
from stallweave.sources.parquet import empty, is_absent, try_read

#: Layers and their folders below the warehouse root.
LAYERS = {"silver": "silver", "marts": "lakehouse/marts"}

_COMMIT = "version BIGINT, folders ARRAY<STRING>, committed_at TIMESTAMP"


def layer_path(warehouse: str, layer: str, model: str) -> str:
    """K2: folder of a model; an unknown layer is an error."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer: {layer}")
    return f"{warehouse.rstrip('/')}/{LAYERS[layer]}/{model}"


def write_model(df: DataFrame, warehouse: str, layer: str, model: str) -> str:
    """K2: full refresh of a model; returns its place."""
    path = layer_path(warehouse, layer, model)
    replace_table(df, path)
    return path


def read_model(spark: SparkSession, warehouse: str, layer: str, model: str) -> DataFrame:
    """K2: the current rows of a model."""
    return read_table(spark, layer_path(warehouse, layer, model))


def replace_table(df: DataFrame, path: str) -> int:
    """Writes ``df`` into a new folder below ``path`` and then points there; returns the rows written.

    ``df`` may read the current rows.  The pointer is replaced in one step, so readers find the former rows or the new
    ones and never none, and a failure leaves the former.  Folders that are no longer pointed at are deleted by the next
    replacement but one, so readers that began before may finish.
    """
    spark, pointer = df.sparkSession, Pointer(df.sparkSession, f"{path}/current.json")
    before = pointer.read() or {"folder": None, "former": None}
    folder = f"v-{uuid.uuid4().hex}"
    rows = counted(df, lambda counting: counting.write.parquet(f"{path}/{folder}"))
    pointer.write({"folder": folder, "former": before["folder"]})
    if before["former"]:
        fs, at = _file_system(spark, path)
        fs.delete(at(f"{path}/{before['former']}"), True)
    return rows


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """K2: the current rows of a table that ``replace_table`` wrote."""
    current = Pointer(spark, f"{path}/current.json").read()
    if current is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(f"{path}/{current['folder']}")


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and its path constructor: whatever store Spark writes to."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def register_views(spark: SparkSession, paths: dict[str, str]) -> None:
    """K9: named views over models, as they are when the views are made."""
    for name, path in paths.items():
        read_table(spark, path).createOrReplaceTempView(name)


class VersionedTable:
    """A table kept as write-once folders plus a small commit log, one writer at a time.

    ``replace`` writes a new base (K4, K5).  ``add`` writes only the rows of one batch, so a micro-batch
    costs its own size and not that of the table; ``read`` unites base and batches and keeps the latest row
    per key; ``compact`` folds the batches into a new base.  Every commit names all folders that are live
    after it, so the newest commit is the whole state.  Of several rows of a key the first by ``order`` counts, or, with
    ``last_commit_wins``, the one committed last, whatever its clock says.  Batch versions only grow: one that is not above the
    committed version is a replay and is ignored.  Folder names are unique: nothing that can be read is ever
    overwritten, and a folder left by a lost driver is simply not in the log.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str] = (), order: Sequence[Order] = (),
        last_commit_wins: bool = False,
    ):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.order, self.last_commit_wins = list(keys), list(order), last_commit_wins

    def state(self) -> tuple[int, list[str]]:
        """Committed version (0 before the first) and live folders."""
        try:
            log = self.spark.read.schema(_COMMIT).json(f"{self.root}/_commits")
        except AnalysisException as err:
            if is_absent(err):
                return 0, []
            raise
        newest = F.max_by(F.struct("version", "folders"), F.struct("version", "committed_at"))
        row = log.agg(newest.alias("newest")).first()["newest"]
        return (row["version"], list(row["folders"])) if row else (0, [])

    def version(self) -> int:
        return self.state()[0]

    def _commit(self, df: DataFrame, version: int, kept: list[str]) -> int:
        folder = f"v{version:012d}-{uuid.uuid4().hex[:8]}"
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).write.parquet(
            f"{self.root}/{folder}"
        )
        self.spark.range(0, 1, 1, 1).select(
            F.lit(version).cast("bigint").alias("version"),
            F.array(*[F.lit(name) for name in [*kept, folder]]).alias("folders"),
            F.current_timestamp().alias("committed_at"),
        ).write.mode("append").json(f"{self.root}/_commits")
        return version

    def replace(self, df: DataFrame) -> int:
        """New base under the next version; ``df`` may read the current one."""
        return self._commit(df, self.version() + 1, [])

    def rebase(self, df: DataFrame) -> int:
        """New base under the current version, so that numbers of batches to come stay free."""
        return self._commit(df, self.version(), [])

    def add(self, df: DataFrame, version: int, unique: bool = False) -> bool:
        """Rows of one batch, reduced to one per key unless they are known to be; False when the version is already there."""
        committed, folders = self.state()
        if version <= committed:
            return False
        self._commit(latest_per_key(df, self.keys, self.order) if self.keys and not unique else df, version, folders)
        return True

    def amend(self, df: DataFrame) -> None:
        """Rows that belong to the versions already there, at their own size; the order of rows decides, not that of commits."""
        version, folders = self.state()
        self._commit(latest_per_key(df, self.keys, self.order), version, folders)

    def read(self) -> DataFrame:
        """Current rows; keys are never NULL.

        Only base rows whose key occurs in a later batch compete with the batches.  The batch keys decide how:
        when they are few Spark sends them to the base scan and the base is not shuffled.
        """
        folders = [f"{self.root}/{name}" for name in self.state()[1]]
        if not folders:
            return empty(self.spark, self.schema)
        base = self.spark.read.schema(self.schema).parquet(folders[0])
        if not self.keys or len(folders) == 1:
            return base
        fresh = self.spark.read.schema(self.schema).parquet(*folders[1:])
        if self.last_commit_wins:
            # The place of a row's folder in the log; a key stands in it once, so no other column has to be read to decide.
            names = [folder.rsplit("/", 1)[1] for folder in folders]
            commit = F.array_position(F.lit(names), F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]*)/[^/]*$", 1))
            newest = latest_per_key(fresh.withColumn("_commit", commit), self.keys, ["_commit"], []).drop("_commit")
            return base.join(newest.select(*self.keys), self.keys, "left_anti").select(self.schema.names).unionByName(newest)
        touched = fresh.select(*self.keys)
        contested = base.join(touched, self.keys, "left_semi").select(self.schema.names).unionByName(fresh)
        settled = base.join(touched, self.keys, "left_anti").select(self.schema.names)
        return settled.unionByName(latest_per_key(contested, self.keys, self.order))

    def compact(self) -> int:
        """Fold the batches into one base."""
        return self.rebase(self.read())


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """K5: rows of ``new`` win.  Only keys of ``new`` meet ``old``, so a small refresh joins without moving ``old``."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def unconsumed(partitions: DataFrame, ledger: DataFrame) -> DataFrame:
    """K8: partitions not yet recorded as consumed."""
    return partitions.join(ledger.select("entity", "dt", "run_id"), ["entity", "dt", "run_id"], "left_anti")


def record_consumed(partitions: DataFrame, path: str) -> None:
    """K8: append partitions to the ledger; repeating a record is harmless, the ledger is read as a set."""
    partitions.select("entity", "dt", "run_id", F.current_timestamp().alias("consumed_at")).write.mode(
        "append"
    ).parquet(path)


def read_ledger(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    found = try_read(spark, path, schema)
    return empty(spark, schema) if found is None else found
