"""Refreshes by new runs and change sets: what they read, what they write, what they keep."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from stallweave import schemas
from stallweave.plans import increments as inc
from stallweave.plans import refresh as full
from stallweave.sinks import bronze
from stallweave.sinks.keyed import KeyedTable, Pointer, counted
from stallweave.sinks.tables import read_model

RUNS = ["20240101_000000", "20240102_000000", "20240103_000000"]


def rows(spark, schema, *dicts):
    day = lambda run: f"{run[:4]}-{run[4:6]}-{run[6:8]}"
    made = [{**{n: None for n in schema.names}, **d, "run_id": d["extracted_at"], "dt": day(d["extracted_at"])} for d in dicts]
    text = ", ".join(f"{f.name} {'STRING' if f.name == 'dt' else f.dataType.simpleString()}" for f in schema.fields)
    return spark.createDataFrame([tuple(m[n] for n in schema.names) for m in made], text).withColumn("dt", F.to_date("dt"))


def land(spark, root, **logs):
    for name, dicts in logs.items():
        if dicts:
            bronze.append_partitioned(rows(spark, inc.LOG_SCHEMAS[name], *dicts), f"{root}/{name}")


def listing(run, *pairs):
    return [{"id": i, "name": f"P{i}", "seller_id": sid, "price": "1", "extracted_at": run} for i, sid in pairs]


def seller(run, sid, name):
    return {"data": json.dumps({"seller": {"id": sid, "name": name}}), "extracted_at": run}


def reviews(run, product, sid, *items):
    return {"product_id": product, "seller_id": sid, "page": "1", "data": json.dumps(list(items)), "extracted_at": run}


def detail(run, i, category):
    return {"id": i, "categories": json.dumps({"id": category, "name": f"C{category}"}), "extracted_at": run}


def first_run(run=RUNS[0]):
    return dict(
        products=listing(run, ("1", "5"), ("2", "6"), ("3", "5"), (None, "5"), ("x", "6"), ("2.0", "6")),
        sellers=[seller(run, 5, "five"), seller(run, 6, "six"), {"data": "{cut", "extracted_at": run}, {"data": "{}", "extracted_at": run}],
        reviews=[reviews(run, "1", "5", {"id": 11, "rating": 4}, {"rating": 1}, 7), reviews(run, "2", "6", {"id": 12}), {"data": "[1,", "extracted_at": run}],
        details=[detail(run, "1", 100), detail(run, "2", 200)],
        categories=[{"category_id": "100", "category_name": "C", "level": "1", "extracted_at": run}, {"category_id": "c", "extracted_at": run}, {"category_name": "group", "extracted_at": run}],
    )


def counts(result):
    assert result.passed == len(result.outcomes), [o[5] for o in result.outcomes]
    return {o[0]: o[3] for o in result.outcomes if o[3]}


def same_as_full(spark, root, warehouse, tmp_path):
    """Facts and dimensions equal a full build from all that has landed."""
    logs = {name: spark.read.schema(schema).parquet(f"{root}/{name}") for name, schema in inc.LOG_SCHEMAS.items()}
    where = str(tmp_path / "full")
    assert full.refresh(spark, logs, where).passed == len(full.MODELS)
    tables = inc.Warehouse(spark, warehouse).tables
    for model in full.MODELS:
        if model.layer != "marts":
            continue
        a, b = read_model(spark, where, "marts", model.name), tables[model.name].read()
        assert a.columns == b.columns and a.count() == b.count() and a.exceptAll(b).count() == 0, model.name


def test_only_new_runs_are_read(spark, tmp_path):
    root = str(tmp_path / "a blank" / "products")
    for run in RUNS:
        bronze.append_partitioned(rows(spark, schemas.BRONZE_PRODUCTS, *listing(run, ("1", "5"))), root, one_run=True)
    runs = bronze.run_folders(spark, root)
    assert runs == [f"dt=2024-01-0{d}/run_id=2024010{d}_000000" for d in (1, 2, 3)]
    read = bronze.read_runs(spark, root, schemas.BRONZE_PRODUCTS, runs[1:2])
    spark.conf.set("spark.sql.maxMetadataStringLength", "9999")
    plan = read._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert f"= {RUNS[1]})" in filters and "2024-01-02" in filters and RUNS[0] not in plan
    assert len(read.inputFiles()) == 1 and RUNS[1] in read.inputFiles()[0]
    assert [(r["id"], r["run_id"]) for r in read.collect()] == [("1", RUNS[1])]
    assert bronze.read_runs(spark, root, schemas.BRONZE_PRODUCTS, []).count() == 0 and bronze.run_folders(spark, str(tmp_path / "none")) == []


def test_null_and_escaped_partitions(spark, tmp_path):
    root = str(tmp_path / "log")
    odd = spark.createDataFrame([(1, None), (2, "a:b c"), (3, "x")], "v int, part string")
    assert bronze.append_partitioned(odd, root, ("part",)) == 3
    runs = bronze.run_folders(spark, root, ("part",))
    assert len(runs) == 3
    for run in runs:
        assert bronze.read_runs(spark, root, odd.schema, [run], ("part",)).count() == 1
    assert sorted(r["v"] for r in bronze.read_runs(spark, root, odd.schema, runs, ("part",)).collect()) == [1, 2, 3]


def test_refreshes_equal_a_full_build_and_change_what_they_must(spark, tmp_path):
    root, warehouse = str(tmp_path / "raw"), str(tmp_path / "w")
    logs = inc.logs_below(root)
    land(spark, root, **first_run())
    assert counts(inc.refresh_incremental(spark, logs, warehouse)) == {
        "stg_products": 3, "stg_product_details": 2, "stg_seller_info": 2, "stg_reviews": 2, "stg_categories": 1,
        "dim_products": 2, "dim_sellers": 2, "dim_categories": 1, "fct_reviews": 2, "fct_products": 3,
    }
    assert counts(inc.refresh_incremental(spark, logs, warehouse)) == {}
    # One seller's new name: its own rows and those of its facts.
    land(spark, root, sellers=[seller(RUNS[1], 5, "FIVE")])
    assert counts(inc.refresh_incremental(spark, logs, warehouse)) == {"stg_seller_info": 1, "dim_sellers": 1, "fct_reviews": 1, "fct_products": 2}
    # A product goes to another seller, one gets a category, one is new, one is seen again unchanged but later.
    land(spark, root, products=listing(RUNS[2], ("1", "6"), ("9", "5")), details=[detail(RUNS[2], "3", 300)])
    assert counts(inc.refresh_incremental(spark, logs, warehouse)) == {"stg_products": 2, "stg_product_details": 1, "dim_products": 1, "fct_products": 3}
    # A run that arrives late changes nothing that is newer.
    land(spark, root, sellers=[seller("20231201_000000", 5, "old"), seller("20231201_000000", 8, "eight")])
    assert counts(inc.refresh_incremental(spark, logs, warehouse)) == {"stg_seller_info": 1, "dim_sellers": 1}
    same_as_full(spark, root, warehouse, tmp_path)
    for table in inc.Warehouse(spark, warehouse).tables.values():
        before = table.read().collect()
        table.compact()
        assert sorted(map(str, table.read().collect())) == sorted(map(str, before)) and len(table.state()["live"]) == 1
    # Change sets outlive the compaction.
    land(spark, root, sellers=[seller("20240104_000000", 6, "SIX")])
    assert counts(inc.refresh_incremental(spark, logs, warehouse)) == {"stg_seller_info": 1, "dim_sellers": 1, "fct_reviews": 1, "fct_products": 2}
    same_as_full(spark, root, warehouse, tmp_path / "again")


def test_rejects_of_all_runs_stay(spark, tmp_path):
    root, where = str(tmp_path / "raw"), str(tmp_path / "w")
    logs, warehouse = inc.logs_below(root), inc.Warehouse(spark, where)
    land(spark, root, **first_run())
    inc.refresh_incremental(spark, logs, where)

    def kept(model):
        return sorted((r["reason"], r["run_id"]) for r in spark.read.parquet(warehouse.rejects(model)).collect())

    run = RUNS[0]
    assert kept("stg_products") == [("another id of the same key", run), ("key is no number", run), ("no key", run)]
    assert kept("stg_seller_info") == [("document cannot be read", run), ("no key", run)]
    assert kept("stg_reviews") == [("document cannot be read", run), ("no key", run), ("no key", run)]
    assert kept("stg_categories") == [("key is no number", run)]
    land(spark, root, products=listing(RUNS[1], (None, "5")))
    done = inc.refresh_incremental(spark, logs, where)
    assert [o[6] for o in done.outcomes if o[0] == "stg_products"] == [1]
    assert len(kept("stg_products")) == 4
    # The same runs consumed again replace their own rejects and change no row.
    ledger = spark.read.parquet(warehouse.ledger)
    ledger.where("model <> 'stg_products'").write.parquet(f"{where}/ledger2")
    moved = inc.Warehouse(spark, where)
    type(moved).ledger = property(lambda self: f"{where}/ledger2")
    try:
        assert inc.unconsumed_runs(moved, "stg_products", logs["products"]) == [f"dt=2024-01-0{d}/run_id=2024010{d}_000000" for d in (1, 2)]
        assert inc.feed(moved, inc.FEEDS[0], logs["products"]) == (0, 4)
    finally:
        type(moved).ledger = property(lambda self: f"{self.root.rstrip('/')}/ledger")
    assert len(kept("stg_products")) == 4


def test_failing_model_keeps_its_runs(spark, tmp_path):
    root, where = str(tmp_path / "raw"), str(tmp_path / "w")
    logs = inc.logs_below(root)
    land(spark, root, **first_run())
    import dataclasses

    def broken(df):
        return df.withColumn("review_id", F.raise_error(F.lit("not yet")).cast("bigint")).withColumn("extracted_at_ts", F.lit(1))

    feeds = [dataclasses.replace(f, build=broken) if f.name == "stg_reviews" else f for f in inc.FEEDS]
    result = inc.refresh_incremental(spark, logs, where, feeds=feeds)
    failed = {o[0] for o in result.outcomes if o[2] == "failed"}
    assert failed == {"stg_reviews", "fct_reviews"}
    assert inc.unconsumed_runs(inc.Warehouse(spark, where), "stg_products", logs["products"]) == []
    assert counts(inc.refresh_incremental(spark, logs, where)) == {"stg_reviews": 2, "fct_reviews": 2}
    same_as_full(spark, root, where, tmp_path)


def test_keyed_table_looks_up_few_files(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", buckets=16)
    base = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert table.put(base) == 20_000 and table.put(base.where("k < 9")) == 0
    assert table.put(base.where("k IN (5, 7)").withColumn("v", F.lit(-1).cast("long"))) == 2
    few = spark.createDataFrame([(5,), (6,), (None,), (99_999,)], "k long")
    found = table.lookup(few)
    assert sorted(map(tuple, found.collect())) == [(5, -1), (6, 12)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "bucket" in filters and filters.count(",") <= 6
    assert table.read().count() == 20_000 and sorted(r["k"] for r in table.changed_since(1).collect()) == [5, 7]
    assert table.state()["batch"] == 2


def test_pointer_and_counts(spark, tmp_path):
    pointer = Pointer(spark, str(tmp_path / "deep er" / "p.json"))
    assert pointer.read() is None
    for document in ({"a": [1, "é"]}, {"a": []}):
        pointer.write(document)
        assert pointer.read() == document
    written = counted(spark.range(1000).repartition(7), lambda df: df.write.parquet(str(tmp_path / "o")))
    assert written == 1000 == spark.read.parquet(str(tmp_path / "o")).count()
    assert counted(spark.range(0), lambda df: df.write.parquet(str(tmp_path / "e"))) == 0


def test_nothing_landed_at_all(spark, tmp_path):
    result = inc.refresh_incremental(spark, inc.logs_below(str(tmp_path / "raw")), str(tmp_path / "w"))
    assert counts(result) == {}
    assert inc.Warehouse(spark, str(tmp_path / "w")).tables["fct_products"].read().count() == 0


def test_all_failing_is_an_error(spark, tmp_path):
    land(spark, str(tmp_path / "raw"), products=listing(RUNS[0], ("1", "5")))
    import dataclasses

    def broken(df):
        raise ValueError("no")

    with pytest.raises(RuntimeError):
        inc.refresh_incremental(spark, inc.logs_below(str(tmp_path / "raw")), str(tmp_path / "w"), feeds=[dataclasses.replace(f, build=broken) for f in inc.FEEDS])


def test_drifting_types_blanks_and_colons(spark, tmp_path):
    from stallweave.sources.parquet import agreeing, folders_with_files, read_drifting

    root = str(tmp_path / "raw logs")
    kinds = ["long", "long", "string", "string", "double", "double", "double", "long"]
    for i, kind in enumerate(kinds):
        df = spark.range(i, i + 1).select(F.col("id").cast(kind).alias("id"), F.lit(f"v{i}").alias("v"))
        df = df.drop("v") if i == 1 else df
        df.write.parquet(f"{root}/dt=2024-01-01 0{i}%3A00/run_id={i}")
    # One folder that disagrees in itself.
    spark.range(50, 51).select(F.col("id").cast("string").alias("id")).write.mode("append").parquet(f"{root}/dt=2024-01-01 00%3A00/run_id=0")
    spark.range(0).write.parquet(f"{root}/dt=x/run_id=9")
    folders = folders_with_files(spark, root)
    assert len(folders) == 9 and all("raw logs" in f and "%3A" in f for f in folders[:8])
    got = sorted((r["id"], r["v"]) for r in read_drifting(spark, root, ["id", "v", "none"]).collect() if True for r in [r.asDict() | {"v": r["v"] or ""}])
    assert got == sorted([("0", "v0"), ("1", ""), ("2", "v2"), ("3", "v3"), ("4.0", "v4"), ("5.0", "v5"), ("6.0", "v6"), ("7", "v7"), ("50", "")])
    assert 4 <= len(agreeing(spark, folders)) <= 9
    nothing = read_drifting(spark, str(tmp_path / "none"), ["a"])
    assert nothing.columns == ["a"] and nothing.count() == 0


def test_parked_batches_are_added_once(spark, tmp_path):
    from stallweave.sinks.tables import VersionedTable
    from stallweave.streaming.refresh import retry_parked

    schema = spark.createDataFrame([(1, "1", "a")], "k bigint, t string, v string").schema
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    table = VersionedTable(spark, str(tmp_path / "t"), schema, ["k"], ["t"])
    table.add(make((1, "5", "new"), (2, "1", "b")), 7)
    parked = str(tmp_path / "parked")
    assert retry_parked(spark, table, lambda df: df, parked, schema) == 0
    make((1, "2", "late"), (3, "1", "c"), (2, "2", "B")).write.parquet(f"{parked}/batch=3")
    folders = table.state()[1]
    assert retry_parked(spark, table, lambda df: df, parked, schema) == 1
    assert sorted(map(tuple, table.read().collect())) == [(1, "5", "new"), (2, "2", "B"), (3, "1", "c")]
    assert table.version() == 7 and table.state()[1][:-1] == folders
    assert retry_parked(spark, table, lambda df: df, parked, schema) == 0
    make((4, "1", "d")).write.parquet(f"{parked}/batch=5")
    assert retry_parked(spark, table, lambda df: df, parked, schema) == 1 and table.read().count() == 4


def test_profile_counts_values(spark):
    from stallweave.operators import ranking

    df = spark.createDataFrame([(1, None), (1, "x"), (None, "y")], "a int, b string")
    rows = {r["column_name"]: (r["row_count"], r["null_count"], r["distinct_estimate"]) for r in ranking.profile({"t": df}, values=True).collect()}
    assert rows == {"a": (3, 1, 1), "b": (3, 1, 2)}
    big = spark.range(40_000).select(F.lit("g").alias("g"), (F.col("id") % 30_011).alias("v"), (F.col("id") % 3).alias("run"))
    merged = ranking.merged_sketches(ranking.distinct_sketches(big, ["run", "g"], "v"), ["g"], "n").first()["n"]
    assert abs(merged - 30_011) < 0.03 * 30_011


def test_clean_log_is_not_shuffled_for_its_rejects(spark):
    """a log whose ids are all written like their numbers is read for its rejects and not moved."""
    from stallweave.plans import staging

    rejects = staging.keyless(rows(spark, schemas.BRONZE_PRODUCTS, *listing(RUNS[0], ("1", "5"), (None, "5"), ("2", "6"))))
    assert [r["reason"] for r in rejects.collect()] == ["no key"]
    assert "hashpartitioning" not in rejects._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_seller_pages_are_parsed_once_before_the_cut(spark):
    """the key is read once from each page; pages without a seller, and none, give no row."""
    from stallweave.plans import staging

    pages = [seller(RUNS[0], 5, "a"), seller(RUNS[1], 5, "b"), {**seller(RUNS[1], 6, "c"), "data": None}, {**seller(RUNS[1], 7, "d"), "data": "{"}]
    latest = staging.stg_seller_info(rows(spark, schemas.BRONZE_SELLERS, *pages))
    assert [(r["seller_id"], r["seller_name"]) for r in latest.collect()] == [(5, "b")]
    before = latest._jdf.queryExecution().optimizedPlan().toString().split("WindowGroupLimit")[-1]
    assert before.count("get_json_object") == 2 and "Filter" not in before


def test_order_lines_are_landed_narrow(spark):
    """lines are dealt to their months as they are, and land as the whole log."""
    from stallweave.catalogue import control, shapes

    sf = "/root/testdata/sf0.001"
    landed = control._Landed(spark, sf)
    assert not {"name", "thumbnail_url", "data"} & {c for log in ("products", "sellers") for c in landed.shapes[log][0].columns}
    for which in ("month < 199801", "NOT (month < 199801)"):
        landed.add(which)
    for name, log in (("products", shapes.listing(spark, sf)), ("sellers", shapes.sellers(spark, sf)), ("reviews", shapes.review_pages(spark, sf))):
        found = bronze.read_runs(spark, landed.logs[name].root, landed.logs[name].schema, bronze.run_folders(spark, landed.logs[name].root, ("month",)), ("month",))
        assert found.where("month <> substring(run_id, 1, 6)").count() == 0
        # Elements of a page have no order of their own.
        columns = [c for c in log.columns if (name, c) != ("reviews", "data")]
        assert found.select(*columns).exceptAll(log.select(*columns)).count() == 0 and found.count() == log.count()


def test_models_of_a_layer_are_built_side_by_side(spark, tmp_path, monkeypatch):
    """five feeds wait for each other at a barrier, which feeds in turn never pass; all ledgers and outcomes are there, in order."""
    import threading

    root, where = str(tmp_path / "raw"), str(tmp_path / "w")
    land(spark, root, **first_run())
    together, feed = threading.Barrier(len(inc.FEEDS), timeout=30), inc.feed
    monkeypatch.setattr(inc, "feed", lambda *args: together.wait() is not None and feed(*args))
    result = inc.refresh_incremental(spark, inc.logs_below(root), where)
    assert counts(result)["fct_products"] == 3
    assert [o[0] for o in result.outcomes] == [m.name for m in (*inc.FEEDS, *inc.MARTS)]
    ledger = spark.read.parquet(inc.Warehouse(spark, where).ledger)
    assert {r["model"] for r in ledger.collect()} == {f.name for f in inc.FEEDS}


def test_first_rows_of_a_mart_need_no_list_of_keys(spark, tmp_path, monkeypatch):
    """an empty mart takes its inputs as they are; only later ones look for touched keys."""
    written, materialise = [], inc.materialise
    monkeypatch.setattr(inc, "materialise", lambda df, label: written.append(label) or materialise(df, label))
    root, where = str(tmp_path / "raw"), str(tmp_path / "w")
    logs = inc.logs_below(root)
    land(spark, root, **first_run())
    inc.refresh_incremental(spark, logs, where)
    assert not written
    land(spark, root, sellers=[seller(RUNS[1], 5, "FIVE")])
    assert counts(inc.refresh_incremental(spark, logs, where)) == {"stg_seller_info": 1, "dim_sellers": 1, "fct_reviews": 1, "fct_products": 2}
    assert set(written) == {"touched", "touched-reviews"}
    same_as_full(spark, root, where, tmp_path)


def test_seller_pages_are_the_json_of_their_members(spark):
    """pages are joined from texts made once a seller; escapes, NULL members and numbers that are none stay as a JSON writer has them."""
    from stallweave.catalogue import shapes

    sales = spark.createDataFrame(
        [(1, 'a"\\\n\té#', "A", 3.0, 0.06, 0.02, 10.7), (2, None, None, None, None, None, None), (3, "", "N", 1.0, 0.0, float("nan"), 1e12)],
        "seller_id long, s_name string, l_returnflag string, l_quantity double, l_discount double, l_tax double, amount double",
    ).selectExpr("*", "timestamp_ntz '2024-01-01 00:00:00' AS l_shipdate", *[f"1 AS {c}" for c in shapes.SELLER_TIES if c != "amount"])
    slug = F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("-")))
    member = F.struct(
        F.col("seller_id").alias("id"), F.col("s_name").alias("name"), slug.alias("slug"), F.concat(F.lit("https://img.example/s"), "seller_id", F.lit(".png")).alias("logo"),
        F.when(F.col("l_returnflag") == "A", "OFFICIAL_STORE").otherwise("NONE").alias("store_level"), (F.col("l_quantity").cast("int") * 10).alias("review_count"),
        F.round(F.col("l_tax") * 40 + 1, 2).alias("avg_rating_point"), F.floor("amount").alias("total_follower"), (F.col("l_discount") >= 0.05).alias("is_official"), slug.alias("url_key"),
    )
    made = sales.withColumns({"want": F.to_json(F.struct(member.alias("seller"))), "name_json": shapes._json_text(F.col("s_name")), "slug_json": shapes._json_text(slug)})
    got = shapes.seller_fields(made, "want").collect()
    assert [r["data"] for r in got] == [r["want"] for r in got]


def test_landed_logs_have_files_of_few_rows(spark, monkeypatch):
    """pages of a month are small on disk; files bounded by rows let readers share them."""
    from stallweave.catalogue import control

    monkeypatch.setattr(control, "_LOG_FILE_ROWS", 100, raising=False)
    landed = control._Landed(spark, "/root/testdata/sf0.001")
    landed.add("true")
    rows = spark.read.parquet(landed.logs["reviews"].root).groupBy(F.col("_metadata.file_path")).count().collect()
    assert max(r["count"] for r in rows) <= 100 and len(rows) > 3


def _shuffle_blocks(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in blocks.mkString("\n").split("\n") if b.startswith("shuffle_")}


def test_shuffle_files_go_with_their_execution(spark, tmp_path):
    """what a refresh has shuffled is off the disks when it ends, whatever garbage the driver keeps; the setting is as before."""
    root, where, name = str(tmp_path / "raw"), str(tmp_path / "w"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    land(spark, root, **first_run())
    before, setting = _shuffle_blocks(spark), spark.conf.get(name)
    assert counts(inc.refresh_incremental(spark, inc.logs_below(root), where))["fct_products"] == 3
    assert not _shuffle_blocks(spark) - before and spark.conf.get(name) == setting
    # Tables read after it shuffle for themselves.
    table = inc.Warehouse(spark, where).tables["fct_products"].read()
    assert table.groupBy("seller_id").count().count() == table.select("seller_id").distinct().count() == 2


def test_landing_deals_no_order_lines(spark, monkeypatch):
    """lines land from the tasks that read them, in files of a codec that keeps their texts small."""
    import pyarrow.parquet as pq

    from stallweave.catalogue import control

    plans, append = {}, bronze.append_partitioned
    monkeypatch.setattr(
        control.bronze, "append_partitioned",
        lambda df, root, *args, **more: plans.update({root.split("/")[-1]: df._jdf.queryExecution().optimizedPlan().toString()}) or append(df, root, *args, **more),
    )
    landed = control._Landed(spark, "/root/testdata/sf0.001")
    landed.add("true")
    assert len(plans) == 5 and not [n for n in ("products", "sellers") if "Rebalance" in plans[n] or "Repartition" in plans[n]]
    for log in landed.logs.values():
        file = spark.read.parquet(log.root).inputFiles()[0].removeprefix("file:").removeprefix("//")
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_newest_rows_are_all_that_share_the_latest_stamp(spark, tmp_path):
    """key, stamp and place of a row find the rows to keep, over files, blocks of a bitmap, ties, NULL keys and NULL stamps."""
    root = str(tmp_path / "log")
    # 40,000 keys seen three times at most, in four runs; files longer than a bitmap, and one run in many small files.
    key = F.when(F.col("id") % 1000 == 7, F.lit(None)).otherwise((F.col("id") * 7919 % 40_000).cast("string"))
    stamp = F.when(F.col("id") % 501 == 3, F.lit(None)).otherwise(F.concat(F.lit("2024010"), (F.xxhash64("id") % 3 + 5).cast("string")))
    made = spark.range(120_000).select(key.alias("id"), stamp.alias("extracted_at"), F.col("id").cast("string").alias("text"), F.pmod(F.hash("id"), F.lit(3)).cast("string").alias("run_id"))
    made.coalesce(1).write.partitionBy("run_id").parquet(root)
    spark.range(30).selectExpr("CAST(id AS STRING) AS id", "'20240109' AS extracted_at", "'late' AS text", "'9' AS run_id").repartition(10).write.mode("append").partitionBy("run_id").parquet(root)
    log = bronze.read_runs(spark, root, made.schema, bronze.run_folders(spark, root, ("run_id",)), ("run_id",), places=True)
    assert log.groupBy(bronze.PLACE).count().where("count > 1").isEmpty()
    assert log.select(F.max(F.col(bronze.PLACE) % (1 << 40))).first()[0] > 32_768
    kept = bronze.newest_rows(log, log["id"], "extracted_at")
    assert kept.columns == made.columns
    latest = log.drop(bronze.PLACE).groupBy("id").agg(F.max("extracted_at").alias("seen"))
    want = log.drop(bronze.PLACE).join(latest, "id").where(F.col("extracted_at").eqNullSafe(F.col("seen"))).select(made.columns)
    keyed = kept.where("id IS NOT NULL")
    assert keyed.exceptAll(want).isEmpty() and want.exceptAll(keyed).isEmpty() and 30 < want.count() < 100_000
    assert kept.where("id IS NULL").count() == 1
    text = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in text and "strategy=broadcast" in text


def test_logs_too_long_for_bitmaps_stay_whole(spark, tmp_path, monkeypatch):
    """bitmaps are sent to every task, so a log that has too many of them is built from as it is."""
    from stallweave.plans import staging

    root = str(tmp_path / "raw")
    for run, name in zip(RUNS, "abc"):
        land(spark, root, sellers=[seller(run, 5, name), {"data": "{}", "extracted_at": run}, {"data": None, "extracted_at": run}])
    log = inc.logs_below(root)["sellers"]
    runs = bronze.run_folders(spark, log.root)
    read = bronze.read_runs(spark, log.root, log.schema, runs, places=True)
    key = staging.page_seller(read)
    kept = bronze.newest_rows(read, key, "extracted_at").select("data").collect()
    assert sum("\"c\"" in (r["data"] or "") for r in kept) == 1 and not [r for r in kept if "\"a\"" in (r["data"] or "")]
    monkeypatch.setattr(bronze, "_MOST_BITMAPS", 0)
    assert bronze.newest_rows(read, key, "extracted_at").count() == 9


def test_several_runs_are_fed_by_their_newest_rows(spark, tmp_path):
    """of three runs only the newest rows of a product, its details and its seller reach the cut; rejects and tables stay as in a full build."""
    import dataclasses

    root, where, given = str(tmp_path / "raw"), str(tmp_path / "w"), {}
    land(spark, root, **first_run())
    for run in RUNS[1:]:
        land(
            spark, root, products=listing(run, ("1", "6"), ("2", "6"), ("2.0", "6"), (None, "5")), sellers=[seller(run, 5, run), {"data": "{cut", "extracted_at": run}],
            details=[detail(run, "1", 300)],
        )

    def watched(feed):
        def build(log):
            given[feed.name] = log.count()
            return feed.build(log)

        return dataclasses.replace(feed, build=build)

    inc.refresh_incremental(spark, inc.logs_below(root), where, feeds=[watched(f) for f in inc.FEEDS])
    # Ids 1, 2, 2.0, 3, x and one row without; details 1 and 2; sellers 5 and 6 and one page without.
    assert (given["stg_products"], given["stg_product_details"], given["stg_seller_info"]) == (6, 2, 3)
    rejected = spark.read.parquet(inc.Warehouse(spark, where).rejects("stg_products")).groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in rejected} == {"another id of the same key": 3, "key is no number": 1, "no key": 3}
    same_as_full(spark, root, where, tmp_path)
