"""Rotation, requests, documents, incremental index, search, context, prompts."""

from __future__ import annotations

import datetime as dt
import math
from urllib.parse import urlencode

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallweave import schemas
from stallweave.operators import cells, encode, search
from stallweave.operators.predicates import build_filter, normalise_filters, override_ids
from stallweave.plans import documents, indexing, retrieval, rotation

NOW = "2024-03-01 00:00:00"


def leaves(spark, *ids):
    return spark.createDataFrame([(i, True) for i in ids], "category_id bigint, is_leaf boolean")


def state(spark, **seen):
    rows = [(int(k[1:]), dt.datetime.fromisoformat(v)) for k, v in seen.items()]
    return spark.createDataFrame(rows, schemas.ROTATION_STATE)


def test_rotation_picks_never_seen_then_oldest(spark):
    seen = state(spark, c1="2024-01-03", c2="2024-01-01", c3="2024-01-01")
    pick = lambda n: [r["category_id"] for r in rotation.plan(leaves(spark, 1, 2, 3, 4), seen, n).collect()]
    assert pick(3) == [4, 2, 3] and pick(99) == [4, 2, 3, 1] and pick(0) == [] and pick(-1) == []
    bumped = rotation.bump(seen, leaves(spark, 4, 2), NOW)
    assert {r[0]: str(r[1]) for r in bumped.collect()} == {
        1: "2024-01-03 00:00:00", 3: "2024-01-01 00:00:00", 2: NOW, 4: NOW}
    assert [r[0] for r in rotation.plan(leaves(spark, 1, 2, 3, 4), bumped, 2).collect()] == [3, 1]


def test_leaf_sources_and_override(spark):
    none = leaves(spark, 1).limit(0)
    ids = rotation.leaf_ids([none, leaves(spark, 5, 5, 6)])
    assert sorted(r[0] for r in ids.collect()) == [5, 6]
    assert rotation.leaf_ids([none]).count() == 0
    assert [r[0] for r in override_ids(ids, [6, 7]).collect()] == [6]


def test_requests_follow_ids_and_counts(spark):
    rows = [("1", None, "7", None, "5"), ("1", None, "7", None, "5"), ("0", "2", "0", '{"id": 8}', "x"), ("3", None, None, None, "4"),
            ("4", None, "9", None, None), ("5", None, "", '{"id": 0}', "1")]
    df = spark.createDataFrame(rows, "id string, product_id string, seller_id string, seller string, review_count string")
    got = rotation.derive_requests(df, "https://h", max_review_pages=2).collect()
    by = lambda kind: sorted((r["product_id"], r["seller_id"], r["page"]) for r in got if r["kind"] == kind)
    assert [p for p, _, _ in by("detail")] == ["1", "2", "3", "4", "5"]
    assert [s for _, s, _ in by("seller")] == ["0", "7", "8", "9"]
    assert by("review") == [("1", "7", 1), ("1", "7", 2), ("5", "0", 1), ("5", "0", 2)]
    key = next(r["request_key"] for r in got if r["kind"] == "review" and r["product_id"] == "1" and r["page"] == 2)
    params = {"limit": 20, "include": rotation.REVIEW_INCLUDE, "sort": rotation.REVIEW_SORT, "page": 2, "product_id": "1", "seller_id": "7"}
    assert key == "https://h/reviews?" + urlencode(sorted(params.items()))


def test_ttl_boundary(spark):
    ts = lambda df: df.withColumn("t", F.col("t").cast("timestamp"))
    cache = ts(spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2023-01-01 00:00:00"), ("b", "2024-01-01 12:00:00")], "request_key string, t string"))
    req = ts(spark.createDataFrame([("a", "2024-01-02 00:00:00"), ("b", "2024-01-02 00:00:00"), ("c", "2024-01-02 00:00:00")], "request_key string, t string"))
    left = rotation.ttl_dedupe(req.withColumnRenamed("t", "requested_at"), cache.withColumnRenamed("t", "fetched_at"))
    assert sorted(r["request_key"] for r in left.collect()) == ["a", "c"]


PRODUCT = ("product_id bigint, product_name string, short_description string, description string, brand_name string, "
           "category_id bigint, category_name string, seller_id bigint, seller_name string, price int, rating_average float, review_count int")
REVIEW = "review_id bigint, product_id bigint, title string, review_content string, thank_count int, rating int"


def reference_document(name, brand, cat, price, rating, count, short, long, reviews):
    """The document format spelled out for one row."""
    lines = [f"Sản phẩm: {name or ''}", f"Thương hiệu: {brand or ''}", f"Danh mục: {cat or ''}", f"Giá: {price or ''}",
             f"Đánh giá trung bình: {rating or ''} ({count or 0} reviews)", f"Mô tả ngắn: {short or ''}", f"Mô tả: {(long or '')[:1500]}"]
    if reviews:
        lines.append("Đánh giá khách hàng:\n" + reviews[:2000])
    return "\n".join(lines)


def test_documents(spark):
    rating = float(np.float32(4.7))
    products = spark.createDataFrame([
        (1, "Áo", "ngắn", "ư" * 1600, "B", 5, "Thời trang", 2, "S", 12_500_000, 4.7, 3),
        (2, None, None, None, None, None, None, None, None, 0, 0.0, None),
        (None, "x", None, None, None, None, None, None, None, 1, 1.0, 1)], PRODUCT)
    reviews = spark.createDataFrame(
        [(i, 1, f"t{i}", "c" * 700, thanks, 5) for i, thanks in ((1, 1), (2, 9), (3, None), (4, 9), (5, 2), (6, 3))]
        + [(7, 1, "empty", "", 99, 5), (8, 1, None, None, 99, 5), (9, 3, "other", "x", 1, 1)], REVIEW)
    docs = {r["product_id"]: r["document"] for r in documents.product_documents(products, reviews).collect()}
    best = "\n".join(f"t{i} — " + "c" * 700 for i in (2, 4, 6, 5, 1))
    assert set(docs) == {1, 2}
    assert docs[1] == reference_document("Áo", "B", "Thời trang", 12_500_000, rating, 3, "ngắn", "ư" * 1600, best)
    assert docs[2] == reference_document(None, None, None, 0, 0.0, None, None, None, None)


def index_rows(spark, *docs):
    rows = spark.createDataFrame(list(docs), "product_id bigint, document string")
    known = {"product_id", "document", "content_hash", "embedding", "indexed_at"}
    return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PRODUCT_INDEX.fields if f.name not in known])


def test_incremental_index(spark, tmp_path):
    class SmallBatches(encode.HashingEncoder):
        def encode(self, texts):
            assert len(texts) <= 2
            return super().encode(texts)

    table = indexing.index_table(spark, str(tmp_path / "i"))
    run = lambda rows, clock, **kw: indexing.index_incremental(table, rows, lambda: SmallBatches(16), clock, batch_size=2, **kw)
    assert run(index_rows(spark, (1, "a b"), (2, "c"), (3, "d e f")), "2024-03-01 00:00:00") == {"documents": 3, "indexed": 3, "unchanged": 0}
    assert run(index_rows(spark, (1, "a b"), (2, "c"), (3, "d e f")), "2024-03-02 00:00:00") == {"documents": 3, "indexed": 0, "unchanged": 3}
    assert table.version() == 1
    assert run(index_rows(spark, (1, "a b"), (2, "changed")), "2024-03-03 00:00:00") == {"documents": 2, "indexed": 1, "unchanged": 1}
    rows = {r["product_id"]: r for r in table.read().collect()}
    assert set(rows) == {1, 2, 3} and str(rows[1]["indexed_at"]) == "2024-03-01 00:00:00" and str(rows[2]["indexed_at"]) == "2024-03-03 00:00:00"
    assert math.isclose(sum(x * x for x in rows[2]["embedding"]), 1.0, rel_tol=1e-6)
    run(index_rows(spark, (1, "a b")), "2024-03-04 00:00:00", prune=True)
    assert [r["product_id"] for r in table.read().collect()] == [1]


def test_hashing_encoder():
    enc = encode.HashingEncoder(8)
    a, b, empty = enc.encode(["x y\tx", "x x\ny", " "])
    assert np.array_equal(a, b) and not empty.any() and math.isclose(float(np.linalg.norm(a)), 1.0, rel_tol=1e-6)


def brute_force(items, queries, k):
    hits = {}
    for qid, q, f in queries:
        scored = []
        for row in items:
            if f.get("min_price") is not None and not (row["price"] is not None and row["price"] >= f["min_price"]):
                continue
            if f.get("max_price") is not None and not (row["price"] is not None and row["price"] <= f["max_price"]):
                continue
            if f.get("min_rating") is not None and not (row["rating_average"] is not None and row["rating_average"] >= f["min_rating"]):
                continue
            if f.get("category_keyword") and f["category_keyword"].lower() not in (row["category_name"] or "").lower():
                continue
            v = row["embedding"]
            length = np.linalg.norm(q) * np.linalg.norm(v)
            scored.append((-round(float(np.dot(q, v) / length), 9) if length else 2.0, row["item_id"]))
        hits[qid] = [i for _, i in sorted(scored)[:k]]
    return hits


@pytest.fixture(scope="module")
def fixture_vectors(spark):
    rng = np.random.default_rng(3)
    items = []
    for i in range(300):
        v = rng.normal(size=8).round(3)
        items.append({"item_id": i, "embedding": [float(np.float32(x)) for x in v], "price": None if i % 17 == 0 else float(i),
                      "rating_average": None if i % 13 == 0 else (i % 50) / 10, "category_name": [None, "Sách", "Đồ chơi", "sách cũ"][i % 4]})
    for i in (7, 8, 9):
        items[i]["embedding"] = items[6]["embedding"]
    items[20]["embedding"] = [0.0] * 8
    filters = [{}, {"min_price": 100.0}, {"max_price": 50.0, "min_rating": 2.0}, {"category_keyword": "SÁCH"}, {"category_keyword": "none"},
               {"min_price": 290.0, "max_price": 295.0}]
    queries = [(q, np.array([float(np.float32(x)) for x in rng.normal(size=8)]), filters[q % len(filters)]) for q in range(12)]
    queries.append((12, np.array(items[6]["embedding"]), {}))
    schema = "item_id bigint, embedding array<float>, price double, rating_average double, category_name string"
    corpus = spark.createDataFrame([tuple(r.values()) for r in items], schema).repartition(5)
    asked = spark.createDataFrame(
        [(q, v.tolist(), f.get("min_price"), f.get("max_price"), f.get("min_rating"), f.get("category_keyword")) for q, v, f in queries],
        "query_id bigint, embedding array<float>, min_price double, max_price double, min_rating double, category_keyword string")
    return items, queries, corpus, asked


@pytest.mark.parametrize("limits", [{}, {"chunk_bytes": 64}, {"chunk_bytes": 300}])
def test_nearest_equals_brute_force(spark, fixture_vectors, limits):
    items, queries, corpus, asked = fixture_vectors
    rows = search.nearest(corpus, asked, 8, 6, **limits).collect()
    got = {q: [r["item_id"] for r in sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])] for q, _, _ in queries}
    assert got == brute_force(items, queries, 6)
    assert got[12][:4] == [6, 7, 8, 9]


def test_k_beyond_corpus_keeps_zero_vectors_last(spark, fixture_vectors):
    items, queries, corpus, asked = fixture_vectors
    rows = search.nearest(corpus, asked.where("query_id = 0"), 8, 1000).orderBy("rank").collect()
    assert len(rows) == 300 and rows[-1]["item_id"] == 20 and math.isnan(rows[-1]["similarity"])
    assert search.nearest(corpus, asked.limit(0), 8, 5).count() == 0


def test_single_question_agrees(spark, fixture_vectors):
    items, queries, corpus, asked = fixture_vectors
    index = corpus.withColumnRenamed("item_id", "product_id")
    for q, vector, filters in queries[:6]:
        hits = search.retrieve_one(index, vector.tolist(), build_filter(**filters), 6).collect()
        assert [r["product_id"] for r in hits] == brute_force(items, [(q, vector, filters)], 6)[q]


def test_cells_recall(spark, fixture_vectors, tmp_path):
    items, queries, corpus, asked = fixture_vectors
    celled, centres = cells.build_cells(corpus, lists=8)
    cells.write_cells(celled, str(tmp_path / "cells"))
    stored = spark.read.parquet(str(tmp_path / "cells"))
    exact = search.nearest(corpus, asked, 8, 6)
    every = cells.search_cells(stored, asked, centres, 8, 6, probes=8)
    assert sorted(map(tuple, every.drop("similarity").collect())) == sorted(map(tuple, exact.drop("similarity").collect()))
    some = cells.search_cells(stored, asked, centres, 8, 6, probes=3)
    shares = [r["recall"] for r in cells.recall(exact, some).collect()]
    assert all(0 <= s <= 1 for s in shares) and sum(shares) / len(shares) > 0.4


def test_patterns():
    like = lambda p, v: search._like(f"%{p}%").fullmatch(v) is not None
    assert like("a_c", "xABCx") and like("a%z", "a\nz") and not like("a\\_c", "abc") and like("a\\_c", "a_c") and like("đồ", "ĐỒ CHƠI")


def test_filter_normalisation(spark):
    df = spark.createDataFrame([(0.0, 2_000_000.0, 0.0, "  "), (5.0, 1_999_999.0, 0.5, " x ")],
                               "min_price double, max_price double, min_rating double, category_keyword string")
    assert [tuple(r) for r in normalise_filters(df).collect()] == [(None, None, None, None), (5.0, 1_999_999.0, 0.5, "x")]


def test_context_text(spark):
    asked = spark.createDataFrame([(1,), (2,)], "query_id bigint")
    hits = spark.createDataFrame(
        [(1, 2, "B", None, "", None, None, None, None, "d" * 700), (1, 1, "A", "C", "S", "Br", 1234567.5, 4.25, 7, "doc")],
        "query_id bigint, rank int, product_name string, category_name string, seller_name string, brand_name string, price double, "
        "rating_average double, review_count int, document string")
    got = {r["query_id"]: r["context"] for r in retrieval.format_context(asked, hits).collect()}
    assert got[2] == "Sản phẩm liên quan: (không tìm thấy)"
    assert got[1] == "\n".join([
        "Sản phẩm liên quan:",
        "\n[#1] A\n  Thương hiệu: Br | Danh mục: C\n  Giá: 1,234,568đ | Đánh giá: 4.2★ (7 reviews)\n  Seller: S\n  Chi tiết: doc",
        "\n[#2] B\n  Thương hiệu: ? | Danh mục: ?\n  Giá: ? | Đánh giá: chưa có rating\n  Seller: ?\n  Chi tiết: " + "d" * 600])


def test_prompt_rows(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"), (1, 4, "assistant", "later"), (2, 0, "assistant", "x")],
        "conv_id bigint, turn bigint, role string, text string")
    contexts = spark.createDataFrame([(1, "CTX")], "conv_id bigint, context string")
    rows = retrieval.prompt_rows(turns, contexts, "SYS").orderBy("conv_id", "position").collect()
    assert [(r["role"], r["content"]) for r in rows] == [
        ("system", "SYS"), ("user", "q1"), ("assistant", "a1"), ("user", "CTX\n\nCâu hỏi của khách: q2")]


def test_k_bounds(spark, fixture_vectors):
    with pytest.raises(ValueError):
        retrieval.retrieve(None, None, 8, k=0)


def test_encoder_memory_is_bounded(monkeypatch):
    """a worker remembers a bounded number of words, and holds no batch as Python texts."""
    from pyspark.util import PythonEvalType

    monkeypatch.setattr(encode, "WORDS_KEPT", 10)
    enc, fresh = encode.HashingEncoder(8), encode.HashingEncoder(8)
    texts = [f"w{n} w{n + 1} x" for n in range(100)]
    assert np.array_equal(enc.encode(texts), np.vstack([fresh.encode([t]) for t in texts])) and len(enc._slots) <= 14
    assert encode.encoder_udf(lambda: enc).evalType == PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF


def test_missing_texts_are_encoded_as_empty(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "id int, t string").coalesce(1)
    got = {r["id"]: r["embedding"] for r in encode.with_embedding(rows, "t", lambda: encode.HashingEncoder(4)).collect()}
    assert sum(got[1]) == 1.0 and got[2] == got[3] == [0.0] * 4


def test_index_parts_are_read_once(spark, tmp_path, monkeypatch):
    """a part of a build reads its own folder, unique keys are not sorted again, and known hashes are read alone."""
    table, plans = indexing.index_table(spark, str(tmp_path / "i")), []
    add = table.add
    monkeypatch.setattr(table, "add", lambda df, version, **kw: plans.append(df._jdf.queryExecution().executedPlan().toString()) or add(df, version, **kw))
    run = lambda rows: indexing.index_incremental(table, rows, lambda: encode.HashingEncoder(4), NOW, commit_rows=2)
    assert run(index_rows(spark, *[(n, f"text {n}") for n in range(6)]))["indexed"] == 6
    assert len(plans) >= 2 and all("PartitionFilters: [isnotnull(_part" in plan for plan in plans)
    assert run(index_rows(spark, *[(n, "other") for n in range(6)], (7, "a"), (7, "b"))) == {"documents": 8, "indexed": 8, "unchanged": 0}
    assert table.read().count() == 7 and {r[0] for r in table.read().where("product_id < 6").select("document").collect()} == {"other"}
    known = table.read().select("product_id", "content_hash")._jdf.queryExecution().executedPlan().toString()
    assert "content_hash" in known and "embedding" not in known and "document:" not in known


def test_queries_in_chunks_make_the_corpus_once(spark):
    """F16: of several chunks of queries only the first reads the corpus as it was given."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<float>")
    def vector(n):
        made.add(1)
        return [1.0, float(n)]

    corpus = spark.range(10).select(F.col("id").alias("item_id"), vector.asNondeterministic()("id").alias("embedding"))
    queries = spark.range(6).select(F.col("id").alias("query_id"), F.array(F.lit(1.0), F.col("id").cast("double")).cast("array<float>").alias("embedding"))
    got = search.nearest(corpus, queries, 2, 1, chunk_bytes=32).collect()
    assert {(r["query_id"], r["item_id"]) for r in got} == {(n, n) for n in range(6)} and made.value == 10


def test_scores_closer_than_single_precision(monkeypatch):
    """pairs that single precision cannot tell apart are ranked in double; no filter is evaluated where none is asked for."""
    import pyarrow as pa

    def passes(*_):
        raise AssertionError("nothing to filter")

    monkeypatch.setattr(search, "_passes", passes)
    lists = lambda rows: pa.array(rows, pa.list_(pa.float64()))
    vectors = [[1.0, 1e-4 * (1 + 1e-4 * n)] for n in range(200)] + [None, [0.0, 0.0]]
    items = pa.table({"item_id": pa.array(range(202)), "embedding": lists(vectors)})
    best = search.Best(search.query_set(pa.table({"query_id": pa.array([0, 1]), "embedding": lists([[0.0, 1.0], [0.0, 0.0]])}), 2), 2, 3)
    for start in range(0, 202, 50):
        best.add(items.slice(start, 50))
    hits = best.table().to_pylist()
    exact = sorted(range(200), key=lambda n: (-round(vectors[n][1] / math.hypot(*vectors[n]), 9), n))[:3]
    assert [h["item_id"] for h in hits if h["query_id"] == 0] == exact
    assert [h["item_id"] for h in hits if h["query_id"] == 1] == [0, 1, 2] and all(math.isnan(h["similarity"]) for h in hits if h["query_id"] == 1)
