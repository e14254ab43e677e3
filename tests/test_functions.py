"""Casts, JSON, text, vectors: the edge values of every helper."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
from urllib.parse import urlencode

import pytest
from pyspark.sql import functions as F

from stallweave.functions import casts, clock, jsonx, text, vectors


@pytest.mark.parametrize(
    "value,want",
    [("12.0", 12), ("3.7", 4), ("2.5", 3), ("-2.5", -3), ("1e3", 1000), (" 5 ", 5), ("abc", None), ("", None),
     ("3000000000", None), ("2.49999999999", 2), (None, None), ("-0.5", -1), (".5", 1), ("5.", 5), ("+7", 7)],
)
def test_text_to_int(one, value, want):
    assert one(lambda c: casts.text_to(c.cast("string"), "int"), v=value) == want


def test_text_to_bigint_keeps_every_digit(one):
    assert one(lambda c: casts.text_to(c, "bigint"), v="9223372036854775807") == 9223372036854775807
    assert one(lambda c: casts.text_to(c, "bigint"), v="9223372036854775808") is None


@pytest.mark.parametrize("value,want", [("2.5", 2), ("3.5", 4), ("nan", None), ("-2.5", -2), ("1e20", None)])
def test_double_to_int_rounds_to_even(one, value, want):
    assert one(lambda c: casts.double_to_integral(c.cast("double"), "int"), v=value) == want


@pytest.mark.parametrize("value,want", [("1d", None), ("2.0f", None), ("4.5", 4.5), ("inf", math.inf), ("x", None)])
def test_text_to_float(one, value, want):
    assert one(lambda c: casts.text_to(c, "float"), v=value) == want


@pytest.mark.parametrize("value,want", [("yes", True), ("t", True), ("1", True), ("TRUE", True), ("y", True), ("no", False), ("", None)])
def test_text_to_boolean(one, value, want):
    assert one(lambda c: casts.text_to(c, "boolean"), v=value) is want


def test_try_cast_cols_follows_the_source_type(spark):
    df = spark.createDataFrame([("3.7", 2.5, 7), ("x", float("nan"), 8)], "a string, b double, c int")
    rows = casts.try_cast_cols(df, {"a": "int", "b": "int", "c": "bigint"}).collect()
    assert [tuple(r) for r in rows] == [(4, 2, 7), (None, None, 8)]


@pytest.mark.parametrize("value,want", [("3", 3), ("3.7", 3), ("x", 0), (None, 0), ("", 0)])
def test_int_or_zero(one, value, want):
    assert one(lambda c: casts.int_or_zero(c.cast("string")), v=value) == want


def test_json_text_forms(one):
    doc = '{"a": {"b": "x"}, "n": null, "f": 1.50, "t": true}'
    assert one(lambda c: jsonx.json_text(c, "$.a.b"), v=doc) == "x"
    assert one(lambda c: jsonx.json_text(c, "$.n"), v=doc) is None
    assert one(lambda c: jsonx.json_text(c, "$.missing"), v=doc) is None
    assert float(one(lambda c: jsonx.json_text(c, "$.f"), v=doc)) == 1.5
    assert one(lambda c: jsonx.json_text(c, "$.t"), v=doc) == "true"
    assert one(lambda c: jsonx.json_text(c, "$.a"), v="not json") is None


@pytest.mark.parametrize("value,want", [('{"a": 1}', True), ("[1]", True), ('{"a"', False), ("{'a': 1}x", False), (None, False)])
def test_is_json(one, value, want):
    assert one(lambda c: jsonx.is_json(c.cast("string")), v=value) is want


@pytest.mark.parametrize(
    "value,want", [("[]", []), ('[1, {"a": 2}, null]', ["1", '{"a":2}', None]), ('{"a": 1}', None), ("[1,", None), (None, None)]
)
def test_json_items(one, value, want):
    assert one(lambda c: jsonx.json_items(c.cast("string")), v=value) == want


def test_first_truthy_skips_empty_forms(one):
    pick = lambda *cs: jsonx.first_truthy(*cs)
    assert one(pick, a="", b="0", c="x") == "x"
    assert one(pick, a="[]", b="false", c="{}") is None


def test_nested_to_text_keeps_nulls_and_unicode(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', CAST(NULL AS STRING), 'c', 'Sản') s, array(1, 2) l, 'x' t")
    assert tuple(jsonx.nested_to_text(df).first()) == ('{"a":1,"b":null,"c":"Sản"}', "[1,2]", "x")


@pytest.mark.parametrize(
    "link,want",
    [("/c8322", 8322), ("/x/c8322?src=1", 8322), ("/c12/", 12), ("/c12#top", 12), ("/c12abc", None), (None, None), ("", None),
     ("/c99999999999999999999", None)],
)
def test_link_category_id(one, link, want):
    assert one(lambda c: text.link_category_id(c.cast("string")), v=link) == want


def test_paths_and_labels(one):
    assert one(lambda p, n: text.child_path(p.cast("string"), n.cast("string")), p=None, n=None) is None
    assert one(lambda p, n: text.child_path(p, n.cast("string")), p="A", n=None) == "A"
    assert one(lambda p, n: text.child_path(p, n), p="A", n="B") == "A > B"
    assert one(lambda p: text.root_segment(p), p="A > B > C") == "A"
    assert one(lambda p: text.root_segment(p, "/"), p="A > B") == "A > B"
    assert one(lambda p: text.short_label(p), p="x" * 45) == "x" * 45
    assert one(lambda p: text.short_label(p), p="ư" * 46) == "ư" * 45 + "..."
    assert one(lambda p: text.content_hash(p), p="Sản phẩm") == hashlib.sha256("Sản phẩm".encode()).hexdigest()


@pytest.mark.parametrize("value,digits", [(2.5, 0), (1234567.5, 0), (4.25, 1), (4.35, 1), (0.0, 2), (1e9, 0)])
def test_grouped_number_matches_python(one, value, digits):
    assert one(lambda c: text.grouped_number(c, digits), v=value) == f"{value:,.{digits}f}"


def test_request_key_matches_urlencode(spark):
    params = {"q": "a b&c=é~*", "limit": "20", "sort": "score|desc,id|desc"}
    row = spark.createDataFrame([("https://h/x", params), ("https://h/y", {}), ("https://h/z", None)], "u string, p map<string,string>")
    got = [r[0] for r in row.select(text.request_key(F.col("u"), F.col("p"))).collect()]
    assert got == ["https://h/x?" + urlencode(sorted(params.items())), "https://h/y", "https://h/z"]


def test_csv_ids(one):
    assert one(lambda c: text.csv_ids(c), v="8322, 316") == [8322, 316]
    assert one(lambda c: text.csv_ids(c), v="8322,x") is None
    assert text.parse_csv_ids(" 1 ,2") == [1, 2]
    with pytest.raises(ValueError):
        text.parse_csv_ids("1,")


def test_partition_values_from_paths(one):
    path = "s3://b/products/dt=2024-01-01/run_id=20240101_000000/f.parquet"
    assert one(lambda c: text.partition_value(c, "dt"), v=path) == "2024-01-01"
    assert one(lambda c: text.partition_value(c, "run_id"), v="/x/f.parquet") is None
    archived = one(lambda c: text.archive_path(c, "products"), v=path)
    assert archived == path.replace("products/", "products/_processed/")
    assert one(lambda c: text.archive_path(c, "products"), v=archived) == archived


def test_clocks(one):
    assert one(lambda c: clock.run_id_ts(c), v="20240131_235959") == dt.datetime(2024, 1, 31, 23, 59, 59)
    assert one(lambda c: clock.run_id_ts(c, strict=False), v="bad") is None
    with pytest.raises(Exception):
        one(lambda c: clock.run_id_ts(c), v="bad")
    assert one(lambda c: clock.run_id(c.cast("timestamp")), v="2024-01-31 23:59:59") == "20240131_235959"
    assert one(lambda c: clock.run_dt(c.cast("timestamp")), v="2024-01-31 23:59:59") == "2024-01-31"


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    rows = df.select(vectors.cosine_similarity(F.col("a"), F.col("b")), vectors.l2_normalise(F.col("a"))).collect()
    assert rows[0][0] == 0.96 and [round(x, 6) for x in rows[0][1]] == [0.6, 0.8]
    assert math.isnan(rows[1][0]) and rows[1][1] == [0.0, 0.0]


def test_named_request_key_matches_request_key(spark):
    """names known beforehand give the same key; no map, sort or lambda is left in the plan."""
    values = [("a b&c", None), ("", "ü~*"), ("%2F", "1|2")]
    rows = spark.createDataFrame(values, "p string, q string")
    fixed = {"sort": "score|desc,id", "b": "~ *", "B": "x", "a": "1"}
    known = text.named_request_key(F.lit("u"), {**fixed, "z y": F.col("p"), "Q": F.col("q")})
    entries = [F.lit(x) for pair in fixed.items() for x in pair]
    as_map = text.request_key(F.lit("u"), F.create_map(*entries, F.lit("z y"), F.col("p"), F.lit("Q"), F.col("q")))
    got = rows.select(known.alias("known"), as_map.alias("as_map"))
    assert [r["known"] for r in got.collect()] == [r["as_map"] for r in got.collect()]
    plan = rows.select(known)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "map" not in plan and text.named_request_key(F.lit("u"), {}) is not None
