"""Sources, sinks, versioned tables, refresh, streams."""

from __future__ import annotations

import glob
import json

import pytest
from pyspark.sql import functions as F

from stallweave import schemas
from stallweave.operators.predicates import require_key
from stallweave.plans import rotation
from stallweave.plans.refresh import MODELS, downstream, refresh
from stallweave.session import materialise, shared_root
from stallweave.sinks import bronze, tables
from stallweave.sources import landed, listing
from stallweave.sources.parquet import read_drifting, read_first_available, read_locations, read_partitioned
from stallweave.streaming.refresh import bronze_stream, read_outcomes, retry_parked, silver_stream
from stallweave.streaming.ttl import suppress_repeats


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_shared_root_follows_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    kept = materialise(spark.range(3), "kept")
    assert kept.count() == 3 and all(shared_root(spark) in path for path in kept.inputFiles())


def test_partitioned_append_and_read(spark, tmp_path):
    root = str(tmp_path / "products")
    rows = spark.createDataFrame([(1, {"a": "x"})], "id int, extra map<string,string>")
    bronze.append_partitioned(bronze.stamp(rows, "2024-01-31 10:00:00", page=3), root)
    bronze.append_partitioned(bronze.stamp(rows.drop("extra"), "2024-02-01 10:00:00"), root)
    bronze.append_partitioned(bronze.stamp(rows.limit(0), "2024-02-02 10:00:00"), root)
    df = read_partitioned(spark, root)
    assert values(df.select("id", "extra", "page", F.col("dt").cast("string"), "run_id")) == [
        (1, '{"a":"x"}', 3, "2024-01-31", "20240131_100000"), (1, None, None, "2024-02-01", "20240201_100000")]
    assert not glob.glob(root + "/dt=2024-02-02/*")
    files = listing.list_files(spark, root, ".parquet")
    assert files.count() == 2
    assert listing.inventory(files, F.lit("all")).first()["objects"] == 2
    assert listing.list_files(spark, str(tmp_path / "none")).count() == 0


def test_locations_live_archive_both_none(spark, tmp_path):
    live, archive = str(tmp_path / "c"), str(tmp_path / "c/_processed")
    schema = schemas.BRONZE_CATEGORIES
    assert read_locations(spark, [live, archive], schema).schema == schema
    row = spark.createDataFrame([("1", "2024-01-01", "r1")], "category_id string, dt string, run_id string")
    bronze.append_partitioned(row, archive)
    assert read_locations(spark, [live, archive], schema).count() == 1
    bronze.append_partitioned(row, live)
    assert read_locations(spark, [live, archive], schema).count() == 2


def test_drifting_types(spark, tmp_path):
    root = str(tmp_path / "sellers")
    spark.sql("SELECT 1L AS data, '20240101_000000' AS extracted_at, DATE'2024-01-01' AS dt").write.parquet(f"{root}/dt=2024-01-01/run_id=a")
    spark.sql("SELECT '{}' AS data, '20240102_000000' AS extracted_at, '2024-01-02' AS dt, 5 AS stray").write.parquet(f"{root}/dt=2024-01-02/run_id=b")
    spark.sql("SELECT true AS data, '20240103_000000' AS extracted_at").write.mode("append").parquet(f"{root}/dt=2024-01-02/run_id=b")
    df = read_drifting(spark, root, ["data", "extracted_at", "dt"])
    assert values(df) == [("1", "20240101_000000", "2024-01-01"), ("true", "20240103_000000", None), ("{}", "20240102_000000", "2024-01-02")]
    assert read_drifting(spark, str(tmp_path / "none"), ["data"]).count() == 0


def test_first_available(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    spark.range(2).write.parquet(str(tmp_path / "full"))
    paths = [str(tmp_path / p) for p in ("none", "empty", "full")]
    assert read_first_available(spark, paths).count() == 0
    assert read_first_available(spark, paths, require_rows=True).count() == 2
    assert read_first_available(spark, paths[:1], schemas.LEDGER).schema == schemas.LEDGER
    with pytest.raises(FileNotFoundError):
        read_first_available(spark, paths[:1])


def test_landed_pages(spark, tmp_path):
    (tmp_path / "p").mkdir()
    pages = [{"data": [{"id": 1, "name": "Fake Product", "price": 100}]}, {"data": []}, {"other": 1}, {"data": [{"id": 2}, {"id": 3}]}]
    for i, page in enumerate(pages):
        (tmp_path / "p" / f"{i}.json").write_text(json.dumps(page, indent=1))
    items = landed.page_items(landed.read_documents(spark, str(tmp_path / "p")))
    assert sorted(json.loads(r["item"])["id"] for r in items.collect()) == [1, 2, 3]


def test_state_documents(spark, tmp_path):
    path = str(tmp_path / "state")
    assert landed.read_state(spark, path).count() == 0
    state = spark.sql("SELECT id AS category_id, TIMESTAMP'2024-01-01 00:00:01' AS last_crawled_at FROM range(25)")
    rotation.write_state_documents(state, path, "2024-03-01 00:00:00", per_document=10)
    assert spark.read.text(path).count() > 1
    assert values(landed.read_state(spark, path, one_per_file=False)) == values(state)
    single = tmp_path / "single.json"
    single.write_text(json.dumps({"updated_at": "x", "watermark": {"7": "2024-01-01T00:00:00+00:00"}}, indent=2))
    assert [r["category_id"] for r in landed.read_state(spark, str(single)).collect()] == [7]


def test_manifest_refuses_empty_runs(spark, tmp_path):
    with pytest.raises(ValueError):
        bronze.write_manifest(spark, str(tmp_path / "m"), "2024-01-01", 0)
    bronze.write_manifest(spark, str(tmp_path / "m"), "2024-01-01 01:02:03", 5, "x")
    row = spark.read.schema(schemas.MANIFEST).json(str(tmp_path / "m")).first()
    assert (row["dt"], row["run_id"], row["row_count"]) == ("2024-01-01", "20240101_010203", 5)


def test_rejects_and_accepted_partition_the_input(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, ok boolean")
    good, bad = bronze.split_rejects(df, F.col("ok"))
    assert values(good.select("id")) == [(1,)] and values(bad.select("id")) == [(2,), (3,)]


def test_layers_and_views(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.layer_path("/w", "gold", "x")
    path = tables.write_model(spark.range(3), str(tmp_path), "marts", "m")
    assert tables.write_model(spark.range(2), str(tmp_path), "marts", "m") == path
    tables.register_views(spark, {"v_m": path})
    assert spark.sql("SELECT count(*) FROM v_m").first()[0] == 2


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    parts = spark.createDataFrame([("e", "1", "a"), ("e", "2", "b")], "entity string, dt string, run_id string")
    assert tables.unconsumed(parts, tables.read_ledger(spark, path, schemas.LEDGER)).count() == 2
    tables.record_consumed(parts.where("dt = '1'"), path)
    tables.record_consumed(parts.where("dt = '1'"), path)
    assert values(tables.unconsumed(parts, tables.read_ledger(spark, path, schemas.LEDGER))) == [("e", "2", "b")]


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), "k bigint, t string, v string")


def test_versioned_table_order_replay_compaction(spark, tmp_path):
    batches = [keyed(spark, (1, "1", "a"), (2, "1", "b")), keyed(spark, (1, "3", "c")), keyed(spark, (1, "2", "late"), (3, "1", "d"))]
    for n, order in enumerate([(0, 1, 2), (2, 1, 0)]):
        table = tables.VersionedTable(spark, str(tmp_path / f"t{n}"), batches[0].schema, ["k"], ["t"])
        assert table.read().count() == 0 and table.version() == 0
        for version, i in enumerate(order, start=1):
            assert table.add(batches[i], version)
            assert not table.add(batches[i], version)
        want = [(1, "3", "c"), (2, "1", "b"), (3, "1", "d")]
        assert values(table.read()) == want
        assert table.compact() == 3 and len(table.state()[1]) == 1 and values(table.read()) == want
        table.compact()
        assert values(table.read()) == want
        assert table.add(keyed(spark, (4, "1", "e")), 4) and table.read().count() == 4


def test_versioned_table_replace_reads_what_it_replaces(spark, tmp_path):
    table = tables.VersionedTable(spark, str(tmp_path / "t"), keyed(spark, (1, "1", "a")).schema)
    table.replace(keyed(spark, (1, "1", "a"), (2, "1", "b")))
    table.replace(tables.upsert(table.read(), keyed(spark, (2, "2", "B"), (3, "1", "c")), "k"))
    assert values(table.read()) == [(1, "1", "a"), (2, "2", "B"), (3, "1", "c")] and table.version() == 2


def landed_models(spark):
    def empty(schema):
        return spark.createDataFrame([], schema)

    return {
        "products": spark.createDataFrame([tuple(["1"] + [None] * 14 + ["20240101_000000", None, None])], schemas.BRONZE_PRODUCTS),
        "details": empty(schemas.BRONZE_DETAILS), "sellers": empty(schemas.BRONZE_SELLERS),
        "reviews": empty(schemas.BRONZE_REVIEWS), "categories": empty(schemas.BRONZE_CATEGORIES),
    }


def test_refresh_outcomes(spark, tmp_path):
    inputs = landed_models(spark)
    done = refresh(spark, inputs, str(tmp_path / "w"))
    assert done.passed == len(MODELS)
    broken = {**inputs, "reviews": spark.range(1)}
    partial = refresh(spark, broken, str(tmp_path / "w2"))
    status = {r["model"]: r["status"] for r in partial.summary(spark).collect()}
    assert status["stg_reviews"] == "failed" and status["fct_reviews"] == "failed" and status["fct_products"] == "ok"
    with pytest.raises(RuntimeError):
        refresh(spark, broken, str(tmp_path / "w3"), only={"stg_reviews"})
    assert downstream("stg_categories") == {"stg_categories", "dim_categories"}


def bronze_files(spark, path, files):
    for i, rows in enumerate(files):
        keyed(spark, *rows).coalesce(1).write.mode("append").parquet(f"{path}")


def test_stream_matches_batch_and_parks_failures(spark, tmp_path):
    src = str(tmp_path / "src")
    files = [[(1, "1", "a")], [(2, "1", "b")], [(1, "3", "c")], [(1, "2", "late")], [(None, "9", "x")], [(3, "1", "bad")], [(2, "2", "B")]]
    bronze_files(spark, src, files)
    schema = keyed(spark, (1, "1", "a")).schema
    want = [(1, "3", "c"), (2, "2", "B"), (3, "1", "bad")]
    landed_rows = len(files)
    for per_batch in (1, 5):
        out = tmp_path / f"out{per_batch}"
        table = tables.VersionedTable(spark, str(out / "silver"), schema, ["k"], ["t"])
        run = lambda fn: silver_stream(
            bronze_stream(spark, src, schema, per_batch), table, fn, str(out / "cp"), str(out / "log"), str(out / "parked"), compact_every=3
        ).awaitTermination()
        failing = {"on": per_batch == 1}

        def transform(batch):
            if failing["on"] and not batch.where("v = 'bad'").isEmpty():
                raise RuntimeError("cannot read this yet")
            return require_key(batch, "k")

        run(transform)
        outcomes = read_outcomes(spark, str(out / "log"))
        assert outcomes.agg(F.sum("row_count")).first()[0] == landed_rows
        assert outcomes.count() == -(-landed_rows // per_batch)
        if per_batch == 1:
            assert outcomes.where("status = 'failed'").count() == 1
            assert values(table.read()) == want[:2]
            retry_parked(spark, table, lambda df: require_key(df, "k"), str(out / "parked"), schema)
        assert [r for r in values(table.read()) if r[0] < 4] == want
        bronze_files(spark, src, [[(4, "1", "new")]])
        landed_rows += 1
        run(lambda batch: require_key(batch, "k"))
        assert values(table.read()) == want + [(4, "1", "new")]


def test_stream_ttl_suppresses_within_a_day(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    at = lambda *rows: spark.createDataFrame(rows, "request_key string, t string").select(
        "request_key", F.col("t").cast("timestamp").alias("requested_at"))
    for rows in ([("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 01:00:00")], [("a", "2024-01-01 12:00:00")],
                 [("c", "2024-01-05 00:00:00")], [("a", "2024-01-05 01:00:00")]):
        at(*rows).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(at(*rows).schema).parquet(src)
        (suppress_repeats(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
         .trigger(availableNow=True).start().awaitTermination())
    got = sorted((r[0], str(r[1])) for r in spark.read.parquet(out).collect())
    assert got == [("a", "2024-01-01 00:00:00"), ("a", "2024-01-05 01:00:00"), ("b", "2024-01-01 01:00:00"), ("c", "2024-01-05 00:00:00")]
