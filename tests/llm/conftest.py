from __future__ import annotations

import pytest

#: Under the same name as in the folder above: a run of all tests finds whichever ``conftest`` was loaded first.
SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text[, lang]) rows; the other columns follow."""

    def build(rows, **extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        from pyspark.sql import functions as F

        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df

    return build


@pytest.fixture(scope="session")
def small(spark):
    """The sample tables at the smallest scale, by name."""
    return lambda table: spark.read.parquet(f"{SF_DIR}/{table}.parquet")
