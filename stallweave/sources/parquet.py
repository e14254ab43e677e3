"""Parquet reads that tolerate missing columns, drifting types and missing locations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stallweave.sources.listing import list_files

_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def is_absent(err: AnalysisException) -> bool:
    """True when the error only says that a location holds nothing."""
    return (err.getCondition() or "") in _ABSENT


def read_partitioned(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """Hive-partitioned Parquet, columns united by name, missing ones NULL.

    With a declared ``schema`` no footer is read before the scan, which is what a large log needs; without
    one, Spark merges all footers (a distributed job).
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(root)
    return spark.read.option("mergeSchema", "true").parquet(root)


def try_read(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The read, or ``None`` when the location does not exist or holds no files."""
    try:
        found = spark.read.parquet(path)  # listing decides existence; a declared schema alone would not
    except AnalysisException as err:
        if is_absent(err):
            return None
        raise
    return read_partitioned(spark, path, schema) if schema is not None else found


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of reads by column name, missing columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """Typed empty relation."""
    return spark.createDataFrame([], schema)


def read_locations(spark: SparkSession, roots: Sequence[str], schema: StructType) -> DataFrame:
    """Union of the locations that have files (live and archive); typed empty when none has."""
    frames = [df for df in (try_read(spark, root, schema) for root in roots) if df is not None]
    return union_by_name(frames) if frames else empty(spark, schema)


def read_first_available(
    spark: SparkSession, paths: Sequence[str], schema: StructType | None = None, require_rows: bool = False
) -> DataFrame:
    """First location that exists (and has a row, if asked); typed empty when a schema is given."""
    for path in paths:
        df = try_read(spark, path, schema)
        if df is not None and not (require_rows and df.isEmpty()):
            return df
    if schema is None:
        raise FileNotFoundError(f"none of {list(paths)} holds data")
    return empty(spark, schema)


#: What Spark says of files whose types do not merge.
_DISAGREE = {"CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE"}


def agreeing(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """S3: reads of ``paths`` (folders), as few as their files' types allow.

    Spark merges the footers of all paths in one distributed job, through the file system it reads with.  Where types do not
    merge the paths are halved, so a log whose types changed k times takes about k log n such jobs; a folder that disagrees
    in itself is read file by file.
    """
    if not paths:
        return []
    try:
        return [spark.read.option("mergeSchema", "true").parquet(*paths)]
    except (PySparkException, Py4JJavaError) as err:
        if isinstance(err, AnalysisException) and is_absent(err):
            return []
        if not _disagree(err):
            raise
    if len(paths) == 1:
        inside = [r["path"] for r in list_files(spark, paths[0], suffix=".parquet").select("path").orderBy("path").collect()]
        return [spark.read.parquet(path) for path in inside] if inside == list(paths) else agreeing(spark, inside)
    half = len(paths) // 2
    return agreeing(spark, paths[:half]) + agreeing(spark, paths[half:])


def _disagree(err: Exception) -> bool:
    """Whether an error says so; it comes from the JVM unconverted."""
    return any(name in str(err) for name in _DISAGREE)


def folders_with_files(spark: SparkSession, root: str) -> list[str]:
    """Folders below ``root`` that hold Parquet files, in the order of their names: one name for each run."""
    folder = F.regexp_replace("path", r"/[^/]+$", "")
    return [r["folder"] for r in list_files(spark, root, suffix=".parquet").select(folder.alias("folder")).distinct().orderBy("folder").collect()]


def read_drifting(spark: SparkSession, root: str, columns: Sequence[str]) -> DataFrame:
    """S3: only ``columns``, each as text, from files whose physical types disagree.

    The driver holds the folders, one for each run, and no file of a folder that agrees in itself.  Partition values in the
    path are not read: the payload columns count.
    """
    frames = [
        df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast("string").alias(n) for n in columns])
        for df in agreeing(spark, folders_with_files(spark, root))
    ]
    return union_by_name(frames) if frames else empty(spark, StructType([StructField(n, StringType()) for n in columns]))
