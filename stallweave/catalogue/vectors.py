"""Vector arithmetic, filtered retrieval, cells, context text."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from stallweave.catalogue import shapes as s
from stallweave.catalogue.registry import query
from stallweave.functions.vectors import l2_normalise, norm
from stallweave.operators.cells import build_cells, recall, search_cells, write_cells
from stallweave.operators.predicates import build_filter
from stallweave.operators.search import nearest, retrieve_one
from stallweave.plans import retrieval
from stallweave.session import scratch_path

DIM = 64
CELLS = 16


def centroids(spark, sf_dir):
    """One query per label: the mean of all its vectors, averaged with partial sums."""
    vectors = s.load(spark, sf_dir, "embeddings").select("label", array_to_vector("embedding").alias("v"))
    return vectors.groupBy("label").agg(Summarizer.mean(F.col("v")).alias("m")).select(
        F.col("label").cast("bigint").alias("query_id"), vector_to_array("m").cast("array<float>").alias("embedding")
    )


def requests(spark, sf_dir):
    """Centroid queries with filters as a user might leave them."""
    q = F.col("query_id")
    return centroids(spark, sf_dir).select(
        "query_id",
        "embedding",
        F.when(q < 3, 0.0).otherwise(900.0 + q).alias("min_price"),
        F.when(q < 5, 2_000_000.0).otherwise(945.0).alias("max_price"),
        (q / 4.0).alias("min_rating"),
        F.when(q == 2, "  ").when(q == 4, "ECON_M").when(q == 6, "d%d").when(q == 9, "nothing here").otherwise(None).alias("category_keyword"),
    )


def index(spark, sf_dir):
    """Vectors with the attributes of the part of the same id and the text of the document of the same id."""
    part, docs = s.load(spark, sf_dir, "part"), s.load(spark, sf_dir, "documents")
    rows = s.load(spark, sf_dir, "embeddings").join(part, F.col("vec_id") == F.col("p_partkey"), "left").join(
        docs.select("doc_id", "text"), F.col("vec_id") == F.col("doc_id"), "left"
    )
    return rows.select(
        F.col("vec_id").alias("product_id"), F.concat("p_name", F.lit(" "), "p_brand").alias("product_name"),
        F.col("p_type").alias("category_name"), F.when(F.col("p_size") > 10, F.concat(F.lit("Shop "), "p_size")).alias("seller_name"),
        F.col("p_brand").alias("brand_name"), F.col("p_retailprice").alias("price"),
        F.when(F.col("p_size") > 5, F.col("p_size") / 10.0).alias("rating_average"),
        (F.col("p_size") * 3).alias("review_count"), F.col("text").alias("document"), "embedding",
    )


_CENTROIDS_SQL = """
parts AS (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS pos FROM embeddings),
means AS (SELECT label, pos, CAST(CAST(avg(CAST(x AS DOUBLE)) AS FLOAT) AS DOUBLE) AS x FROM parts GROUP BY ALL),
centroids AS (SELECT CAST(label AS BIGINT) AS query_id, list(x ORDER BY pos) AS q FROM means GROUP BY label),
corpus AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"""

_SCORE = "round(list_dot_product(q, e) / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(e, e))), 9)"

_EXACT_SQL = f"""{_CENTROIDS_SQL},
exact AS (
  SELECT query_id, item_id, similarity, CAST(rank AS INTEGER) AS rank FROM (
    SELECT query_id, item_id, {_SCORE} AS similarity,
      row_number() OVER (PARTITION BY query_id ORDER BY {_SCORE} DESC, item_id) AS rank
    FROM centroids, corpus) WHERE rank <= 5)"""

_HYBRID_SQL = f"""{_CENTROIDS_SQL},
items AS (
  SELECT item_id, e, p_name || ' ' || p_brand AS product_name, p_type AS category_name,
    CASE WHEN p_size > 10 THEN 'Shop ' || p_size END AS seller_name, p_brand AS brand_name, p_retailprice AS price,
    CASE WHEN p_size > 5 THEN p_size / 10.0::DOUBLE END AS rating_average, p_size * 3 AS review_count, text AS document
  FROM corpus LEFT JOIN part ON item_id = p_partkey LEFT JOIN documents ON item_id = doc_id),
hits AS (
  SELECT *, CAST(n AS INTEGER) AS rank FROM (
    SELECT *, {_SCORE} AS similarity, row_number() OVER (PARTITION BY query_id ORDER BY {_SCORE} DESC, item_id) AS n
    FROM centroids JOIN items ON (query_id < 3 OR price >= 900 + query_id) AND (query_id < 5 OR price <= 945)
      AND (query_id = 0 OR rating_average >= query_id / 4.0::DOUBLE)
      AND CASE query_id WHEN 4 THEN category_name ILIKE '%ECON_M%' WHEN 6 THEN category_name ILIKE '%d%d%'
            WHEN 9 THEN category_name ILIKE '%nothing here%' ELSE TRUE END)
  WHERE n <= 5)"""


@query(f"""WITH {_HYBRID_SQL}
SELECT query_id, rank, round(similarity, 6) AS similarity, item_id AS product_id, product_name, category_name, seller_name,
  brand_name, price, rating_average, review_count, document FROM hits""")
def hybrid_topk(spark, sf_dir):
    """D18, J6, P8-P10, F22, L4."""
    hits = retrieval.retrieve(index(spark, sf_dir), requests(spark, sf_dir), DIM, 5)
    return hits.withColumn("similarity", F.round("similarity", 6))


@query(f"WITH {_EXACT_SQL} SELECT query_id, item_id, round(similarity, 6) AS similarity, rank FROM exact")
def exact_topk_blocks(spark, sf_dir):
    """D18 in chunks: queries that do not travel all at once, on all rows."""
    corpus = s.load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    hits = nearest(corpus, centroids(spark, sf_dir), DIM, 5, chunk_bytes=4 * DIM * 8)
    return hits.withColumn("similarity", F.round("similarity", 6))


@query(f"""WITH {_CENTROIDS_SQL}
SELECT item_id AS product_id, round({_SCORE}, 6) AS similarity FROM corpus JOIN part ON item_id = p_partkey, centroids
WHERE query_id = 0 AND p_retailprice >= 920 AND p_type ILIKE '%m%' ORDER BY {_SCORE} DESC, item_id LIMIT 5""")
def single_question_topk(spark, sf_dir):
    """D18 for one question, by the plan for many."""
    question = centroids(spark, sf_dir).where("query_id = 0").first()["embedding"]
    hits = retrieve_one(index(spark, sf_dir), question, build_filter(min_price=920, category_keyword="M"), 5)
    return hits.select("product_id", F.round("similarity", 6).alias("similarity"))


@query(f"WITH {_EXACT_SQL} SELECT query_id, item_id, round(similarity, 6) AS similarity, rank FROM exact")
def ivf_all_cells(spark, sf_dir):
    """Probing every cell gives the exact result."""
    celled, centres, path = _cells(spark, sf_dir)
    hits = search_cells(spark.read.parquet(path), centroids(spark, sf_dir), centres, DIM, 5, probes=CELLS)
    return hits.withColumn("similarity", F.round("similarity", 6))


@query()
def ivf_topk_recall(spark, sf_dir):
    """Recall when a quarter of the cells is probed; depends on training, so rows only."""
    _, centres, path = _cells(spark, sf_dir)
    questions = centroids(spark, sf_dir)
    celled = spark.read.parquet(path)
    found = search_cells(celled, questions, centres, DIM, 5, probes=CELLS // 4)
    exact = nearest(celled.select("item_id", "embedding"), questions, DIM, 5)
    return recall(exact, found)


def _cells(spark, sf_dir):
    rows = s.load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    celled, centres = build_cells(rows, lists=CELLS)
    path = scratch_path(spark, "cells")
    write_cells(celled, path)
    return celled, centres, path


@query("""WITH parts AS (
  SELECT vec_id, pos, CAST(x AS DOUBLE) * (label + 1) AS x FROM (
    SELECT vec_id, label, unnest(range(len(embedding))) AS pos, unnest(embedding) AS x FROM embeddings)),
lengths AS (SELECT vec_id, sqrt(sum(x * x)) AS len FROM parts GROUP BY vec_id)
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(CAST(CAST(x / len AS FLOAT) AS DOUBLE), 5) AS x
FROM parts JOIN lengths USING (vec_id)""")
def normalise_vectors(spark, sf_dir):
    """stretched vectors back to length 1."""
    stretched = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1))
    return s.load(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(l2_normalise(stretched)).alias("pos", "x")).select(
        "vec_id", "pos", F.round(F.col("x").cast("double"), 5).alias("x")
    )


@query("""SELECT vec_id, round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS length FROM embeddings""")
def vector_lengths(spark, sf_dir):
    """F22."""
    return s.load(spark, sf_dir, "embeddings").select("vec_id", F.round(norm(F.col("embedding")), 6).alias("length"))


@query(f"""WITH {_HYBRID_SQL},
blocks AS (
  SELECT query_id, string_agg(chr(10) || '[#' || rank || '] ' || COALESCE(product_name, 'None') || chr(10)
    || '{retrieval.BRAND_LABEL}' || COALESCE(NULLIF(brand_name, ''), '?') || '{retrieval.CATEGORY_LABEL}'
    || COALESCE(NULLIF(category_name, ''), '?') || chr(10)
    || '{retrieval.PRICE_LABEL}' || COALESCE(format('{{:,.0f}}', price) || 'đ', '?') || '{retrieval.RATING_LABEL}'
    || COALESCE(format('{{:.1f}}', rating_average) || '★ (' || COALESCE(review_count, 0) || ' reviews)', '{retrieval.NO_RATING}') || chr(10)
    || '{retrieval.SELLER_LABEL}' || COALESCE(NULLIF(seller_name, ''), '?') || chr(10)
    || '{retrieval.DETAIL_LABEL}' || substr(COALESCE(document, ''), 1, 600), chr(10) ORDER BY rank) AS blocks
  FROM hits GROUP BY query_id)
SELECT query_id, COALESCE('{retrieval.CONTEXT_HEAD}' || chr(10) || blocks, '{retrieval.CONTEXT_NONE}') AS context
FROM centroids LEFT JOIN blocks USING (query_id)""")
def retrieval_context(spark, sf_dir):
    """Context of every request, also of one without hits."""
    asked = requests(spark, sf_dir)
    return retrieval.format_context(asked, retrieval.retrieve(index(spark, sf_dir), asked, DIM, 5))
