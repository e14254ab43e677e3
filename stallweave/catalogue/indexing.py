"""Documents, hashes, incremental index, encoder, prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallweave import schemas
from stallweave.catalogue import shapes as s
from stallweave.catalogue.layers import DIM_PRODUCTS_SQL, staged_details, staged_reviews
from stallweave.catalogue.registry import plain, query
from stallweave.operators.dedupe import concat_ranked
from stallweave.operators.encode import HashingEncoder, with_embedding
from stallweave.operators.search import nearest
from stallweave.plans import documents, indexing, marts, retrieval
from stallweave.session import materialise, scratch_path

DIM = 64
SYSTEM_TEXT = "Answer from the list below."

# Straight from the events: the five best of a product as a sorted list.
TOP_REVIEWS_SQL = """said AS (
  SELECT user_id, list_sort(list({
      'thanks': -(json_extract_string(props, '$.k')::INTEGER + (event_type = 'purchase')::INTEGER), 'stars': -(floor(value) % 5), 'id': event_id,
      'text': concat(event_type, ' — ', event_type, ' at ', value)}))[:5] AS best
  FROM events WHERE event_type <> 'error' GROUP BY user_id),
top_reviews AS (SELECT user_id AS product_id, unnest(range(1, len(best) + 1)) AS rn, unnest(best).id AS review_id, unnest(best).text AS review_text FROM said)"""

_LABELS = {key: value.rstrip("\n") for key, value in documents.LABELS.items()}
DOCUMENTS_SQL = f"""{DIM_PRODUCTS_SQL},{TOP_REVIEWS_SQL},
documents_built AS (
  SELECT product_id, concat_ws(chr(10), '{_LABELS["name"]}' || product_name, '{_LABELS["brand"]}' || brand_name, '{_LABELS["category"]}' || category_name,
      '{_LABELS["price"]}' || ifnull(nullif(price, 0)::VARCHAR, ''),
      '{_LABELS["rating"]}' || ifnull(nullif(rating_average, 0)::VARCHAR, '') || format(' ({{}} reviews)', review_count),
      '{_LABELS["short"]}' || short_description, '{_LABELS["long"]}' || description[:1500],
      '{_LABELS["reviews"]}' || chr(10) || array_to_string(list_transform(best, lambda b: b.text), chr(10))[:2000]) AS document
  FROM dim_products LEFT JOIN said ON user_id = product_id)"""


def built_documents(spark, sf_dir):
    return documents.product_documents(marts.dim_products(staged_details(spark, sf_dir)), staged_reviews(spark, sf_dir))


@query(f"WITH {TOP_REVIEWS_SQL} SELECT product_id, CAST(rn AS INTEGER) AS rn, review_id, review_text FROM top_reviews")
def top_reviews_per_product(spark, sf_dir):
    """W5, F7, F9, F24, P7."""
    return documents.top_reviews(staged_reviews(spark, sf_dir)).select("product_id", "rn", "review_id", "review_text")


@query(f"""WITH {TOP_REVIEWS_SQL}
SELECT product_id, string_agg(review_text, chr(10) ORDER BY rn) AS reviews_concat FROM top_reviews GROUP BY product_id""")
def reviews_concat(spark, sf_dir):
    """A3."""
    return concat_ranked(documents.top_reviews(staged_reviews(spark, sf_dir)), "product_id", "review_text", "rn", "\\n", "reviews_concat")


@query(f"WITH {DOCUMENTS_SQL} SELECT product_id, document, sha256(document) AS content_hash FROM documents_built")
def product_documents(spark, sf_dir):
    """D16, F8, F13, J3."""
    return documents.with_hash(built_documents(spark, sf_dir)).select("product_id", "document", "content_hash")


def _versions(spark, sf_dir):
    """The document table as it was at the last run and as it is now.

    Earlier, German texts were not collected yet and texts of one source read differently.
    """
    rows = s.load(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("product_id"), F.col("text").alias("document"), "lang", "source"
    )
    earlier = rows.where("lang <> 'de'").withColumn(
        "document", F.when(F.col("source") == "src1", F.concat("document", F.lit(" (draft)"))).otherwise(F.col("document"))
    )
    return earlier.select("product_id", "document"), rows.select("product_id", "document")


@query("SELECT doc_id AS product_id, sha256(text) AS content_hash FROM documents WHERE lang = 'de' OR source = 'src1'")
def changed_documents(spark, sf_dir):
    """J4, F13, S12."""
    earlier, now = _versions(spark, sf_dir)
    return indexing.changed_only(documents.with_hash(now), documents.with_hash(earlier)).select("product_id", "content_hash")


@query("""SELECT doc_id AS product_id, sha256(text) AS content_hash, CAST(64 AS INTEGER) AS dims,
  CASE WHEN lang = 'de' OR source = 'src1' THEN '2024-03-02 00:00:00' ELSE '2024-03-01 00:00:00' END AS indexed_at
FROM documents""")
def index_upsert(spark, sf_dir):
    """A second run touches only what changed."""
    earlier, now = _versions(spark, sf_dir)
    set_by_index = {"product_id", "document", "content_hash", "embedding", "indexed_at"}
    unknown = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PRODUCT_INDEX.fields if f.name not in set_by_index]
    table = indexing.index_table(spark, scratch_path(spark, "index"))
    for rows, clock in ((earlier, "2024-03-01 00:00:00"), (now, "2024-03-02 00:00:00")):
        indexing.index_incremental(table, rows.select("*", *unknown), lambda: HashingEncoder(DIM), clock)
    return plain(table.read().select("product_id", "content_hash", F.size("embedding").alias("dims"), "indexed_at"))


@query("SELECT doc_id AS product_id, sha256(text) AS content_hash FROM documents")
def index_same_clock(spark, sf_dir):
    """Of two refreshes with one clock the later commit wins, in parts of a few rows each."""
    earlier, now = _versions(spark, sf_dir)
    set_by_index = {"product_id", "document", "content_hash", "embedding", "indexed_at"}
    unknown = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PRODUCT_INDEX.fields if f.name not in set_by_index]
    table = indexing.index_table(spark, scratch_path(spark, "index"))
    for rows in (earlier, now):
        part = rows.count() // 2 + 1
        indexing.index_incremental(table, rows.select("*", *unknown), lambda: HashingEncoder(DIM), "2024-03-01 00:00:00", commit_rows=part)
    return table.read().select("product_id", "content_hash")


VECTORS_SQL = f"""
words AS (
  SELECT doc_id, unnest(string_split(translate(text, chr(9) || chr(10) || chr(13), '   '), ' ')) AS word FROM {{texts}}),
slots AS (
  SELECT doc_id, CAST(('0x' || substr(md5(word), 1, 8))::UBIGINT % {DIM} AS INTEGER) AS pos, count(*) AS n
  FROM words WHERE word <> '' GROUP BY ALL),
weights AS (
  SELECT doc_id, pos, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS FLOAT) AS DOUBLE) AS weight FROM slots)"""


@query(f"WITH {VECTORS_SQL.format(texts='documents')} SELECT doc_id, pos, round(weight, 6) AS weight FROM weights")
def document_vectors(spark, sf_dir):
    """Whole texts through the batch encoder, non-zero weights as rows."""
    encoded = with_embedding(s.load(spark, sf_dir, "documents"), "text", lambda: HashingEncoder(DIM))
    return encoded.select("doc_id", F.posexplode("embedding").alias("pos", "w")).where("w <> 0").select(
        "doc_id", "pos", F.round(F.col("w").cast("double"), 6).alias("weight")
    )


def _questions(spark, sf_dir):
    """Last user turn of every conversation."""
    turns = s.load(spark, sf_dir, "conversations").where("role = 'user'")
    return turns.groupBy("conv_id").agg(F.max_by("text", "turn").alias("question"))


_TOP_SQL = f"""questions AS (
  SELECT conv_id AS doc_id, max_by(text, turn) AS text FROM conversations WHERE role = 'user' GROUP BY conv_id),
{VECTORS_SQL.format(texts='documents').replace('words', 'dwords').replace('slots', 'dslots').replace('weights', 'dweights')},
{VECTORS_SQL.format(texts='questions').replace('words', 'qwords').replace('slots', 'qslots').replace('weights', 'qweights')},
lengths AS (SELECT doc_id, sqrt(sum(weight * weight)) AS len FROM dweights GROUP BY doc_id),
qlengths AS (SELECT doc_id, sqrt(sum(weight * weight)) AS len FROM qweights GROUP BY doc_id),
scored AS (
  SELECT q.doc_id AS query_id, d.doc_id AS item_id, sum(q.weight * d.weight) AS dot
  FROM qweights q JOIN dweights d USING (pos) GROUP BY ALL),
rated AS (
  SELECT query_id, item_id, round(dot / (l.len * ql.len), 9) AS similarity
  FROM scored JOIN lengths l ON item_id = l.doc_id JOIN qlengths ql ON query_id = ql.doc_id),
top AS (
  SELECT query_id, item_id, similarity, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, item_id) AS rank FROM rated)
  WHERE rank <= 3)"""


@query(f"WITH {_TOP_SQL} SELECT query_id, item_id, round(similarity, 6) AS similarity, rank FROM top")
def question_topk(spark, sf_dir):
    """Every conversation's last question against all documents."""
    corpus = with_embedding(
        s.load(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "text"), "text", lambda: HashingEncoder(DIM)
    )
    asked = with_embedding(_questions(spark, sf_dir), "question", lambda: HashingEncoder(DIM))
    hits = nearest(corpus, asked.select(F.col("conv_id").alias("query_id"), "embedding"), DIM, k=3)
    return hits.withColumn("similarity", F.round("similarity", 6))


@query(f"""WITH last AS (SELECT conv_id, max(turn) AS last_turn FROM conversations WHERE role = 'user' GROUP BY conv_id),
contexts AS (SELECT conv_id, '{retrieval.CONTEXT_HEAD} ' || max(text) AS context FROM conversations WHERE role = 'system' GROUP BY conv_id)
SELECT conv_id, CAST(-1 AS BIGINT) AS position, 'system' AS role, '{SYSTEM_TEXT}' AS content FROM last
UNION ALL
SELECT conv_id, turn + 1, role, CASE WHEN turn = last_turn
    THEN COALESCE(context, '{retrieval.CONTEXT_NONE}') || chr(10) || chr(10) || '{retrieval.QUESTION_LABEL}' || text ELSE text END
FROM conversations JOIN last USING (conv_id) LEFT JOIN contexts USING (conv_id)
WHERE role <> 'system' AND turn <= last_turn""")
def prompt_rows(spark, sf_dir):
    """Messages in order, the last question behind its context."""
    turns = s.load(spark, sf_dir, "conversations")
    contexts = turns.where("role = 'system'").groupBy("conv_id").agg(
        F.concat(F.lit(f"{retrieval.CONTEXT_HEAD} "), F.max("text")).alias("context")
    )
    return retrieval.prompt_rows(turns, contexts, SYSTEM_TEXT)


@query(f"""WITH {_TOP_SQL},
blocks AS (
  SELECT query_id AS conv_id, string_agg(chr(10) || '[#' || rank || '] Text ' || doc_id || chr(10)
    || '{retrieval.BRAND_LABEL}?{retrieval.CATEGORY_LABEL}' || lang || chr(10) || '{retrieval.PRICE_LABEL}' || format('{{:,}}', n_chars)
    || 'đ{retrieval.RATING_LABEL}{retrieval.NO_RATING}' || chr(10) || '{retrieval.SELLER_LABEL}' || source || chr(10)
    || '{retrieval.DETAIL_LABEL}' || documents.text, chr(10) ORDER BY rank) AS blocks
  FROM top JOIN documents ON item_id = doc_id GROUP BY query_id),
last AS (SELECT conv_id, max(turn) AS last_turn FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT conv_id, CAST(-1 AS BIGINT) AS position, 'system' AS role, '{SYSTEM_TEXT}' AS content FROM last
UNION ALL
SELECT conv_id, turn + 1, role, CASE WHEN turn = last_turn
    THEN COALESCE('{retrieval.CONTEXT_HEAD}' || chr(10) || blocks, '{retrieval.CONTEXT_NONE}') || chr(10) || chr(10) || '{retrieval.QUESTION_LABEL}' || text ELSE text END
FROM conversations JOIN last USING (conv_id) LEFT JOIN blocks USING (conv_id)
WHERE role <> 'system' AND turn <= last_turn""")
def rag_prompt_rows(spark, sf_dir):
    """D18, D20, D21 in one chain: last question, hits, context of whole texts, messages."""
    none = lambda kind: F.lit(None).cast(kind)
    texts = s.load(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("product_id"), F.concat(F.lit("Text "), "doc_id").alias("product_name"), F.col("lang").alias("category_name"),
        F.col("source").alias("seller_name"), none("string").alias("brand_name"), F.col("n_chars").cast("double").alias("price"),
        none("double").alias("rating_average"), none("int").alias("review_count"), F.col("text").alias("document"),
    )
    index = materialise(with_embedding(texts, "document", lambda: HashingEncoder(DIM)), "text-index")
    asked = with_embedding(_questions(spark, sf_dir), "question", lambda: HashingEncoder(DIM)).select(
        F.col("conv_id").alias("query_id"), "embedding", none("double").alias("min_price"), none("double").alias("max_price"),
        none("double").alias("min_rating"), none("string").alias("category_keyword"),
    )
    contexts = retrieval.format_context(asked, retrieval.retrieve(index, asked, DIM, 3), detail_width=None)
    return retrieval.prompt_rows(s.load(spark, sf_dir, "conversations"), contexts.withColumnRenamed("query_id", "conv_id"), SYSTEM_TEXT)


@query(f"""WITH {DOCUMENTS_SQL} SELECT count(*) AS documents, count(*) AS indexed, CAST(0 AS BIGINT) AS unchanged, 1 AS run FROM documents_built
UNION ALL SELECT count(*), 0, count(*), 2 FROM documents_built""")
def index_rerun(spark, sf_dir):
    """Indexing the product documents twice encodes them once."""
    table = indexing.index_table(spark, scratch_path(spark, "index"))
    rows = materialise(built_documents(spark, sf_dir), "documents")
    runs = [
        (*indexing.index_incremental(table, rows, lambda: HashingEncoder(DIM), clock).values(), run)
        for run, clock in ((1, "2024-03-01 00:00:00"), (2, "2024-03-02 00:00:00"))
    ]
    return spark.createDataFrame(runs, "documents BIGINT, indexed BIGINT, unchanged BIGINT, run INT")
