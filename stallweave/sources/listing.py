"""Object listings as DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FILES = "path STRING, length BIGINT, modificationTime TIMESTAMP"


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """Path, size and time of every file below ``root``; contents are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    try:
        return reader.load(root).select("path", "length", "modificationTime")
    except AnalysisException as err:
        if (err.getCondition() or "") == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _FILES)
        raise


def inventory(files: DataFrame, prefix: Column) -> DataFrame:
    """A10: number of objects and bytes per prefix."""
    return files.groupBy(prefix.alias("prefix")).agg(
        F.count("*").alias("objects"), F.sum("length").alias("bytes")
    )
