"""Questions to ranked hits, context text and message rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallweave.functions.text import clip, grouped_number
from stallweave.operators.joins import left_using
from stallweave.operators.predicates import normalise_filters
from stallweave.operators.search import nearest
from stallweave.session import materialise

#: Labels of the context format.
CONTEXT_HEAD = "Sản phẩm liên quan:"
CONTEXT_NONE = "Sản phẩm liên quan: (không tìm thấy)"
BRAND_LABEL = "  Thương hiệu: "
CATEGORY_LABEL = " | Danh mục: "
PRICE_LABEL = "  Giá: "
RATING_LABEL = " | Đánh giá: "
NO_RATING = "chưa có rating"
SELLER_LABEL = "  Seller: "
DETAIL_LABEL = "  Chi tiết: "
QUESTION_LABEL = "Câu hỏi của khách: "
DETAIL_WIDTH = 600

HIT_COLUMNS = (
    "product_id", "product_name", "category_name", "seller_name", "brand_name", "price", "rating_average",
    "review_count", "document",
)


def retrieve(index: DataFrame, requests: DataFrame, dim: int, k: int = 5, **limits: int) -> DataFrame:
    """Top ``k`` products for every request, filters applied before ranking.

    ``requests`` has ``query_id``, ``embedding`` and the filter columns as the user set them (P10).  Only ids,
    vectors and filter columns take part in the ranking.  The winners are written once; their size is then known
    when Spark plans the join to names and documents, so few winners meet the index scan in place.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    corpus = index.select(
        F.col("product_id").alias("item_id"), "embedding", "price", "rating_average", "category_name"
    )
    hits = materialise(nearest(corpus, normalise_filters(requests), dim, k, **limits), "hits")
    return hits.withColumnRenamed("item_id", "product_id").join(index.select(*HIT_COLUMNS), "product_id").select(
        "query_id", "rank", "similarity", *HIT_COLUMNS
    )


def _or_unknown(c: str) -> Column:
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("?"))


def hit_block(detail_width: int | None = DETAIL_WIDTH) -> Column:
    """Text block of one hit; ``detail_width`` characters of its document, ``None`` for all."""
    document = F.coalesce("document", F.lit(""))
    price = F.coalesce(F.concat(grouped_number(F.col("price"), 0), F.lit("đ")), F.lit("?"))
    reviews = F.coalesce("review_count", F.lit(0)).cast("string")
    rating = F.coalesce(
        F.concat(grouped_number(F.col("rating_average"), 1), F.lit("★ ("), reviews, F.lit(" reviews)")), F.lit(NO_RATING)
    )
    return F.concat(
        F.lit("\n[#"), F.col("rank").cast("string"), F.lit("] "), F.coalesce("product_name", F.lit("None")), F.lit("\n"),
        F.lit(BRAND_LABEL), _or_unknown("brand_name"), F.lit(CATEGORY_LABEL), _or_unknown("category_name"), F.lit("\n"),
        F.lit(PRICE_LABEL), price, F.lit(RATING_LABEL), rating, F.lit("\n"),
        F.lit(SELLER_LABEL), _or_unknown("seller_name"), F.lit("\n"),
        F.lit(DETAIL_LABEL), document if detail_width is None else clip(document, detail_width),
    )


def format_context(requests: DataFrame, hits: DataFrame, detail_width: int | None = DETAIL_WIDTH) -> DataFrame:
    """``(query_id, context)`` for every request, with the fixed text where nothing was found."""
    blocks = hits.withColumn("block", hit_block(detail_width)).groupBy("query_id").agg(
        F.expr("listagg(block, '\\n') WITHIN GROUP (ORDER BY rank)").alias("blocks")
    )
    context = F.coalesce(F.concat(F.lit(CONTEXT_HEAD + "\n"), F.col("blocks")), F.lit(CONTEXT_NONE))
    return left_using(requests.select("query_id"), blocks, "query_id").select("query_id", context.alias("context"))


def augmented_question(context: Column, question: Column) -> Column:
    """D21."""
    return F.concat(context, F.lit("\n\n" + QUESTION_LABEL), question)


def prompt_rows(turns: DataFrame, contexts: DataFrame, system_prompt: str) -> DataFrame:
    """Messages ``(conv_id, position, role, content)`` for the last user turn of every conversation.

    Order by position: the system text, the earlier turns as spoken, the question behind its context.  Messages
    stay rows, so a conversation may be longer than any task's memory.
    """
    last = turns.where("role = 'user'").groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    spoken = turns.where("role <> 'system'").join(last, "conv_id").where("turn <= last_turn")
    asked = F.col("turn") == F.col("last_turn")
    with_context = spoken.where(asked).join(contexts, "conv_id", "left").withColumn(
        "content", augmented_question(F.coalesce("context", F.lit(CONTEXT_NONE)), F.col("text"))
    )
    position = (F.col("turn") + 1).cast("bigint").alias("position")
    return (
        last.select("conv_id", F.lit(-1).cast("bigint").alias("position"), F.lit("system").alias("role"), F.lit(system_prompt).alias("content"))
        .unionByName(spoken.where(~asked).select("conv_id", position, "role", F.col("text").alias("content")))
        .unionByName(with_context.select("conv_id", position, "role", "content"))
    )
