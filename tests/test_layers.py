"""Deduplication, staging, marts, trees, hierarchy, integrity on small made-up rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from stallweave import schemas
from stallweave.operators import dedupe, joins, predicates, ranking
from stallweave.operators.tree import flatten_tree
from stallweave.plans import bi, marts, reports, staging


def bronze(spark, schema, rows):
    """Rows given as dicts; columns not named are NULL."""
    names = schema.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def listing(spark, *rows):
    return bronze(spark, schemas.BRONZE_PRODUCTS, rows)


def test_latest_per_key_ignores_order_and_partitioning(spark):
    rows = [(k, t, v) for k in range(5) for t in ("1", "2") for v in ("a", "b")]
    want = None
    for parts in (1, 3, 7):
        for data in (rows, rows[::-1]):
            df = spark.createDataFrame(data, "k int, t string, v string").repartition(parts)
            got = sorted(map(tuple, dedupe.latest_per_key(df, ["k"], ["t"]).collect()))
            want = want or got
            assert got == want and len(got) == 5 and all(r[1] == "2" for r in got)


def test_nulls_sort_last_both_ways(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 2, "y"), (1, 1, "z")], "k int, level int, v string")
    assert dedupe.canonical_per_key(df.withColumn("t", F.lit(1)), ["k"], "level", "t").first()["v"] == "z"
    assert dedupe.latest_per_key(df, ["k"], ["level"]).first()["v"] == "y"


def test_stg_products_quirks(spark):
    df = listing(
        spark,
        {"id": "1", "name": "old", "extracted_at": "20240101_000000", "price": "10"},
        {"id": "1", "name": "new", "extracted_at": "20240102_000000", "price": "12.5", "quantity_sold": '{"value": 7}'},
        {"id": None, "name": "no key", "extracted_at": "20240102_000000"},
        {"id": "x", "name": "bad key", "extracted_at": "20240102_000000", "discount_rate": "4.7"},
    )
    rows = {r["product_name"]: r for r in staging.stg_products(df).collect()}
    assert set(rows) == {"new", "bad key"}
    assert rows["new"]["price"] == 13 and rows["new"]["quantity_sold"] == 7 and rows["new"]["product_id"] == 1
    assert rows["bad key"]["product_id"] is None


def test_stg_details_flattens_objects(spark):
    df = bronze(spark, schemas.BRONZE_DETAILS, [{
        "id": "5", "extracted_at": "20240101_000000", "current_seller": '{"id": 9, "name": "S"}',
        "brand": '{"id": "3", "name": "B"}', "categories": '{"id": 8322, "name": "Sách"}', "quantity_sold": "null",
    }])
    r = staging.stg_product_details(df).first()
    assert (r["seller_id"], r["seller_name"], r["brand_id"], r["brand_name"], r["category_id"], r["category_name"], r["quantity_sold"]) == (
        9, "S", 3, "B", 8322, "Sách", None)
    assert marts.dim_products(staging.stg_product_details(df)).columns == schemas.DIM_PRODUCTS.names


def test_stg_sellers_keeps_newest_and_drops_keyless(spark):
    doc = lambda i, n: json.dumps({"seller": {"id": i, "name": n, "is_official": True, "avg_rating_point": 4.7}})
    df = bronze(spark, schemas.BRONZE_SELLERS, [
        {"data": doc(1, "a"), "extracted_at": "20240101_000000"},
        {"data": doc(1, "b"), "extracted_at": "20240301_000000"},
        {"data": doc(None, "c"), "extracted_at": "20240301_000000"},
        {"data": None, "extracted_at": "20240301_000000"},
        {"data": "{}", "extracted_at": "20240301_000000"},
    ])
    rows = staging.stg_seller_info(df).collect()
    assert [(r["seller_id"], r["seller_name"], r["is_official"]) for r in rows] == [(1, "b", True)]


def test_stg_reviews_survives_odd_arrays(spark):
    page = lambda data, at: {"product_id": "1", "seller_id": "2", "page": "1", "data": data, "extracted_at": at}
    df = bronze(spark, schemas.BRONZE_REVIEWS, [
        page('[{"id": 1, "rating": 5, "created_by": {"full_name": "An"}, "created_at": 1700000000}, null, 7, "x", {"rating": 1}]', "20240101_000000"),
        page('[{"id": 1, "rating": 4}]', "20240102_000000"),
        page("[]", "20240102_000000"),
        page('{"id": 3}', "20240102_000000"),
        page(None, "20240102_000000"),
    ])
    rows = staging.stg_reviews(df).collect()
    assert [(r["review_id"], r["rating"], r["product_id"]) for r in rows] == [(1, 4, 1)]


def test_stg_categories_prefers_the_shallowest_of_a_run(spark):
    row = lambda level, name, at="20240101_000000": {
        "category_id": "7", "category_name": name, "level": level, "is_leaf": "true", "extracted_at": at}
    df = bronze(spark, schemas.BRONZE_CATEGORIES, [row("3", "deep"), row("1", "top"), row("1", "older", "20230101_000000"), {"category_id": None}])
    staged = staging.stg_categories(df)
    assert [(r["category_name"], r["category_level"], r["is_leaf"]) for r in staged.collect()] == [("top", 1, True)]
    assert staged.columns == schemas.STG_CATEGORIES.names
    assert marts.dim_categories(staged).first()["category_name"] == "top"


def test_facts_keep_unmatched_rows_and_row_count(spark):
    products = staging.stg_products(listing(
        spark, {"id": "1", "seller_id": "5", "extracted_at": "20240101_000000"}, {"id": "2", "extracted_at": "20240101_000000"}))
    sellers = staging.stg_seller_info(bronze(spark, schemas.BRONZE_SELLERS, [
        {"data": '{"seller": {"id": 5, "name": "S"}}', "extracted_at": "20240101_000000"}]))
    details = staging.stg_product_details(bronze(spark, schemas.BRONZE_DETAILS, [
        {"id": "2", "categories": '{"id": 4}', "extracted_at": "20240101_000000"}]))
    rows = {r["product_id"]: (r["seller_name"], r["category_id"]) for r in marts.fct_products(products, sellers, details).collect()}
    assert rows == {1: ("S", None), 2: (None, 4)}


def payload(spark, *docs):
    return spark.createDataFrame([(json.dumps(d) if not isinstance(d, str) else d,) for d in docs], "payload string")


def test_tree_alternative_keys_and_levels(spark):
    doc = {"menu": [
        {"code": "a", "title": "A", "url": "/c1", "sub_menu": [
            {"key": 0, "label": "B", "href": "/x/c2?y", "items": [{"name": "C", "children": [{"text": "D", "link": "/c4/"}]}]},
            {"children": []}, "junk", None,
        ]},
        {"id": 9, "name": "E", "children": {"not": "a list"}},
    ]}
    rows = {r["category_name"]: r for r in flatten_tree(payload(spark, doc)).collect()}
    assert set(rows) == {"A", "B", "C", "D", "E"}
    assert rows["D"]["path"] == "A > B > C > D" and rows["D"]["level"] == 4 and rows["D"]["is_leaf"]
    assert rows["D"]["parent_category_id"] is None and rows["C"]["parent_category_id"] == 2
    assert rows["B"]["menu_id"] is None and rows["B"]["category_id"] == 2 and rows["B"]["parent_menu_id"] == "a"
    assert not rows["A"]["is_leaf"] and rows["E"]["is_leaf"]
    assert json.loads(rows["D"]["raw_node"]) == {"text": "D", "link": "/c4/"}


@pytest.mark.parametrize("doc", [
    {"menu_block": {"items": [{"name": "X"}]}, "menu": [{"name": "no"}]}, {"menu": [], "items": [{"name": "X"}]},
    {"data": [{"name": "X"}]}, {"v": 1, "l": [1], "other": [{"name": "X"}], "later": [{"name": "no"}]},
])
def test_tree_roots(spark, doc):
    assert [r["category_name"] for r in flatten_tree(payload(spark, doc)).collect()] == ["X"]


def test_tree_of_nothing(spark):
    assert flatten_tree(payload(spark, {}, "[]", "broken {", {"menu": []})).count() == 0


def test_hierarchy(spark):
    dim = spark.createDataFrame(
        [(1, "A", None, 1), (2, "B", 1, 2), (3, "C", 2, 3), (4, "D", 99, 2)],
        "category_id bigint, category_name string, parent_category_id bigint, category_level int")
    parents = {r["category_id"]: r["parent_name"] for r in joins.with_parent(dim).collect()}
    assert parents == {1: None, 2: "A", 3: "B", 4: None}
    assert sorted(map(tuple, joins.ancestors(dim).collect())) == [(2, 1, 1), (3, 1, 2), (3, 2, 1)]
    loop = dim.where("category_id = 1").withColumn("parent_category_id", F.lit(1).cast("bigint"))
    with pytest.raises(ValueError):
        joins.ancestors(loop)


def test_key_checks(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk bigint")
    parent = spark.createDataFrame([(2,), (3,), (3,)], "id bigint")
    assert [tuple(r) for r in joins.check_fk(child, "fk", parent, "id", "r").collect()] == [("r", 1, 2)]
    assert [tuple(r) for r in joins.check_pk(parent, "id", "p").collect()] == [("p", "3", 2)]
    with pytest.raises(ValueError):
        joins.require_unique(parent, "id")


def test_bi_views(spark):
    dim = spark.createDataFrame([(1, "A > B", 2, None)], "category_id bigint, path string, category_level int, parent_category_id bigint")
    assert bi.bi_categories(dim).first()["root_category_name"] == "A"
    products = spark.createDataFrame([tuple([None] * len(schemas.DIM_PRODUCTS))], schemas.DIM_PRODUCTS)
    shaped = bi.bi_products(products, dim)
    assert "category_name" not in shaped.columns and shaped.columns[19:22] == ["category_level", "parent_category_id", "category_path"]
    assert shaped.count() == 1


def test_reports(spark):
    facts = spark.createDataFrame([("x" * 50, 5), ("x" * 50, 9), ("y", 7), ("z", None)], "product_name string, quantity_sold int")
    rows = reports.top_products(facts, 2).collect()
    assert [(r["quantity_sold"], r["short_name"]) for r in rows] == [(9, "x" * 45 + "..."), (7, "y")]
    sellers = spark.createDataFrame(
        [(1, "a", 5.0, 0, 50), (2, "b", 4.0, 1234, 60), (3, "c", 5.0, 9999, 49), (4, "d", None, 9, 99)],
        "seller_id bigint, seller_name string, avg_rating_point double, total_follower int, seller_review_count int")
    rows = reports.top_sellers(sellers).collect()
    assert [(r["seller_name"], r["label"]) for r in rows] == [("b", "1,234  ★4.00"), ("a", "0  ★5.00")]


def test_filters(spark):
    df = spark.createDataFrame([(1, 100.0, 4.0, "Sách Hay"), (2, 300.0, None, "ĐỒ chơi"), (3, None, 5.0, None)],
                               "id int, price double, rating_average double, category_name string")
    ids = lambda c: sorted(r["id"] for r in df.where(c).collect())
    assert ids(predicates.build_filter()) == [1, 2, 3]
    assert ids(predicates.build_filter(min_price=100, max_price=300)) == [1, 2]
    assert ids(predicates.build_filter(min_rating=4)) == [1, 3]
    assert ids(predicates.build_filter(category_keyword="đồ CH")) == [2]
    assert ids(predicates.build_filter(category_keyword="s%h h_y")) == [1]
    assert ids(predicates.ilike_contains(F.col("category_name"), F.lit("HAY"))) == [1]


def test_small_aggregates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert [tuple(r) for r in ranking.coverage(df, "k", 1).collect()] == [("a", 2)]
    assert ranking.has_rows(df) and not ranking.has_rows(df.where("v > 9"))
    rows = ranking.profile({"t": df}).collect()
    assert [(r["column_name"], r["type"], r["row_count"], r["column_count"]) for r in rows] == [("k", "string", 3, 2), ("v", "int", 3, 2)]
    assert json.loads(ranking.sample_rows({"t": df.limit(1)}).first()["sample"]) == {"k": "a", "v": 1}


def test_failed_overwrite_leaves_the_former_mart(spark, tmp_path):
    from stallweave.sinks import tables

    root = str(tmp_path / "with a blank")
    path = tables.write_model(spark.range(5), root, "marts", "m")
    broken = spark.range(3).withColumn("x", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        tables.write_model(broken, root, "marts", "m")
    former = tables.read_model(spark, root, "marts", "m")
    assert former.count() == 5
    assert tables.replace_table(former.where("id > 2"), path) == 2
    # A reader that began before the replacement still finds its rows.
    assert former.count() == 5 and tables.read_model(spark, root, "marts", "m").count() == 2
    with pytest.raises(FileNotFoundError):
        tables.read_model(spark, root, "marts", "other")


def test_texts_that_look_absent_are_values(spark):
    from stallweave.operators.tree import flatten_tree

    payload = '{"data": [{"id": "0", "name": "false", "children": [{"id": 0, "code": "c", "text": "", "name": "kid", "items": "none"}]}, {"id": null, "key": "k", "title": "t", "children": []}]}'
    rows = flatten_tree(spark.createDataFrame([(payload,)], "payload string")).collect()
    assert sorted((r["menu_id"], r["category_name"], r["parent_menu_id"], r["level"]) for r in rows) == [("0", "false", None, 1), ("c", "kid", "0", 2), ("k", "t", None, 1)]


def test_cut_sorts_no_column_that_can_be_derived_after_it(spark):
    """every observation is sorted, so the columns of the log that the choice does not need come from the winners."""
    from stallweave.catalogue import layers
    from stallweave.catalogue import shapes as s
    from conftest import SF_DIR

    for staged, log, build in (
        (layers.staged_products, s.listing, lambda df: staging.stg_products(df, s.LISTING_TIES)),
        (layers.staged_sellers, s.sellers, lambda df: staging.stg_seller_info(df, s.SELLER_TIES)),
    ):
        cut = staged(spark, SF_DIR)
        assert sorted(map(str, cut.collect())) == sorted(map(str, build(log(spark, SF_DIR)).collect()))
        plan = cut._jdf.queryExecution().optimizedPlan().toString()
        assert "https://img.example/" not in plan[plan.index("Window ["):], "derived before the sort"


def test_ancestors_of_some_make_no_pairs_of_others(spark, monkeypatch):
    """a chain of 64 levels has 2016 pairs; those of one category are 63, whatever else is asked on the way."""
    chain = spark.range(64).select(F.col("id").alias("category_id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_category_id"))
    made = []
    monkeypatch.setattr(joins, "materialise", lambda df, label: made.append(df.localCheckpoint()) or made[-1])
    got = sorted(map(tuple, joins.ancestors(chain, "category_id = 63").collect()))
    assert got == sorted((63, a, 63 - a) for a in range(63))
    assert max(df.count() for df in made) <= 63
    assert joins.ancestors(chain).count() == 2016


def test_ancestors_find_a_cycle_beside_what_is_asked(spark):
    loop = spark.createDataFrame([(1, 3), (2, 1), (3, 2), (4, 1), (5, 4)], "category_id long, parent_category_id long")
    with pytest.raises(ValueError, match="own ancestor"):
        joins.ancestors(loop, "category_id = 5")
