from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from stallweave.session import build_session

    session = build_session(
        "tests", master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over a single row of named texts."""

    def evaluate(build, **values):
        from pyspark.sql import functions as F

        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
        return row.select(build(*[F.col(k) for k in values]).alias("v")).first()["v"]

    return evaluate
