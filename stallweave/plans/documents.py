"""One text document per product."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallweave.functions.text import clip, content_hash, non_blank, review_text
from stallweave.operators.dedupe import Order, concat_ranked, top_n_per_group
from stallweave.operators.joins import left_using
from stallweave.operators.predicates import require_key

#: Labels and lengths of the document format.
LABELS = {
    "name": "Sản phẩm: ",
    "brand": "Thương hiệu: ",
    "category": "Danh mục: ",
    "price": "Giá: ",
    "rating": "Đánh giá trung bình: ",
    "short": "Mô tả ngắn: ",
    "long": "Mô tả: ",
    "reviews": "Đánh giá khách hàng:\n",
}
REVIEWS_PER_PRODUCT = 5


@dataclass(frozen=True)
class Widths:
    """Characters kept of the long parts of a document; ``None`` keeps the whole text."""

    description: int | None = 1500
    reviews: int | None = 2000

PRODUCT_COLUMNS = (
    "product_id", "product_name", "short_description", "description", "brand_name", "category_id",
    "category_name", "seller_id", "seller_name", "price", "rating_average", "review_count",
)


def top_reviews(reviews: DataFrame, n: int = REVIEWS_PER_PRODUCT, tiebreak: list[Order] | None = None) -> DataFrame:
    """The most thanked, best rated reviews of every product as text with their rank."""
    texts = reviews.where(non_blank(F.col("review_content"))).select(
        "product_id",
        "review_id",
        F.coalesce("thank_count", F.lit(0)).alias("thanks"),
        F.coalesce("rating", F.lit(0)).alias("stars"),
        review_text(F.col("title"), F.col("review_content")).alias("review_text"),
    )
    ties = tiebreak or [F.asc_nulls_last("review_id")]
    return top_n_per_group(texts, ["product_id"], ["thanks", "stars"], n, "rn", ties)


def product_documents(
    products: DataFrame, reviews: DataFrame, n: int = REVIEWS_PER_PRODUCT, widths: Widths = Widths()
) -> DataFrame:
    """Product rows with their ``document``, of ``n`` reviews and the given ``widths``."""
    joined_reviews = concat_ranked(top_reviews(reviews, n), "product_id", "review_text", "rn", "\\n", "reviews_concat")
    rows = left_using(require_key(products, "product_id").select(*PRODUCT_COLUMNS), joined_reviews, "product_id")
    return rows.withColumn("document", document_text(widths)).drop("reviews_concat", "short_description", "description")


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _number(column: str) -> Column:
    """Numbers print as text, zero and NULL print as nothing (Q10)."""
    value = F.col(column)
    return F.when(value.isNull() | (value == 0), "").otherwise(value.cast("string"))


def _rating() -> Column:
    """Single-precision ratings print with the digits of their double value."""
    wide = F.col("rating_average").cast("double")
    return (
        F.when(wide.isNull() | (wide == 0), "").when(F.isnan(wide), "nan").otherwise(wide.cast("string"))
    )


def _cut(c: Column, width: int | None) -> Column:
    return c if width is None else clip(c, width)


def document_text(widths: Widths = Widths()) -> Column:
    """The document of a product row; the reviews block only where there are reviews."""
    label = {key: F.lit(value) for key, value in LABELS.items()}
    reviews = F.nullif(F.col("reviews_concat"), F.lit(""))
    return F.concat_ws(
        "\n",
        F.concat(label["name"], _text("product_name")),
        F.concat(label["brand"], _text("brand_name")),
        F.concat(label["category"], _text("category_name")),
        F.concat(label["price"], _number("price")),
        F.concat(
            label["rating"], _rating(), F.lit(" ("), F.coalesce("review_count", F.lit(0)).cast("string"), F.lit(" reviews)")
        ),
        F.concat(label["short"], _text("short_description")),
        F.concat(label["long"], _cut(_text("description"), widths.description)),
        F.concat(label["reviews"], _cut(reviews, widths.reviews)),
    )


def with_hash(documents: DataFrame) -> DataFrame:
    """F13."""
    return documents.withColumn("content_hash", content_hash(F.col("document")))
