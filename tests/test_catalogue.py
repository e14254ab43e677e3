"""Every registered query beside its SQL, and the plans Spark chooses."""

from __future__ import annotations

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from stallweave.operators.dedupe import latest_per_key, top_n_per_group

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(round(value, 9) + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(map(cell, row)) for row in df.select(*columns).collect())
    if name not in ORACLES:
        assert got
        return
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    want = sorted(tuple(map(cell, row)) for row in relation.select(*[f'"{c}"' for c in columns]).fetchall())
    assert got == want


def test_contract(spark):
    assert set(ORACLES) <= set(QUERIES)
    assert contract.entry(spark).count() == 10


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    for df in (latest_per_key(lines, ["l_partkey"], ["l_shipdate"]), top_n_per_group(lines, ["l_partkey"], ["l_shipdate"], 5)):
        assert plan(df).count("WindowGroupLimit") == 2
    for name in ("top_products", "top_sellers", "crawl_plan", "coverage_by_category", "single_question_topk"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR)), name
    for name in ("top_products", "fct_reviews_enriched", "bi_fact_path", "product_documents", "hybrid_topk", "prompt_rows", "ttl_dedupe"):
        text = plan(QUERIES[name](spark, SF_DIR))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in text, (name, bad)
    scan = plan(QUERIES["filtered_products"](spark, SF_DIR))
    assert "PushedFilters" in scan and "p_partkey" in scan


def test_landed_files_are_bounded_by_rows(spark, monkeypatch):
    """a larger log lands as more files and not as larger ones."""
    from stallweave.catalogue import control

    monkeypatch.setattr(control, "_FILE_ROWS", 500, raising=False)
    landed = spark.read.parquet(control._landed_listing(spark, SF_DIR)[0])
    files = [r["n"] for r in landed.groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()]
    assert max(files) <= 500 and len(files) >= 12 and sum(files) == spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
