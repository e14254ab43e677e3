"""Dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallweave.operators.dedupe import canonical_per_key, latest_per_key, ranked
from stallweave.operators.joins import left_using
from stallweave.operators.predicates import require_key
from stallweave.schemas import DIM_PRODUCTS, FCT_PRODUCTS, FCT_REVIEWS

_SELLER_COLUMNS = (
    "seller_id", "seller_name", "seller_slug", "seller_logo", "store_level", "seller_review_count",
    "avg_rating_point", "total_follower", "is_official", "url_key",
)


def dim_products(stg_details: DataFrame) -> DataFrame:
    """One row per product, NULL ids left out (``unkeyed`` has them)."""
    return one_per_key(stg_details, "product_id").withColumnRenamed("extracted_at_ts", "last_seen_at").select(DIM_PRODUCTS.names)


def dim_sellers(stg_sellers: DataFrame) -> DataFrame:
    """D7."""
    return one_per_key(stg_sellers, "seller_id").select(*_SELLER_COLUMNS, F.col("extracted_at_ts").alias("last_seen_at"), "dt")


def dim_categories(stg_categories: DataFrame) -> DataFrame:
    """One row per category, the shallowest occurrence."""
    rows = canonical_per_key(require_key(stg_categories, "category_id"), ["category_id"], "category_level", "extracted_at_ts")
    return rows.select(
        "category_id", "category_name", "parent_category_id", "category_level", "path", "is_leaf", "link",
        F.col("extracted_at_ts").alias("last_seen_at"), "dt",
    )


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """The latest row of every value of ``key``, NULL left out: a side that a left join cannot multiply.

    Raw ids that cast to one value (``1`` and ``1.0``) arrive here as several rows.
    """
    return latest_per_key(require_key(df, key), [key], ["extracted_at_ts"])


def unkeyed(df: DataFrame, key: str) -> DataFrame:
    """Rows that ``one_per_key`` does not keep: without a key, or older or equal to the row kept for theirs."""
    ordered = ranked(df, [key], ["extracted_at_ts"], "_rn")
    return ordered.where((F.col("_rn") > 1) | F.col(key).isNull()).drop("_rn")


def fct_reviews(stg_reviews: DataFrame, stg_products: DataFrame, stg_sellers: DataFrame) -> DataFrame:
    """Reviews with product and seller names; unmatched reviews stay, none is multiplied."""
    products = one_per_key(stg_products, "product_id").select("product_id", "product_name", "brand_name")
    sellers = one_per_key(stg_sellers, "seller_id").select("seller_id", "seller_name")
    return left_using(left_using(stg_reviews, products, "product_id"), sellers, "seller_id").select(*FCT_REVIEWS)


def fct_products(stg_products: DataFrame, stg_sellers: DataFrame, stg_details: DataFrame) -> DataFrame:
    """One row per listed product with seller attributes and the category key from the detail page."""
    sellers = one_per_key(stg_sellers, "seller_id").select("seller_id", "seller_name", "is_official", "store_level")
    categories = one_per_key(stg_details, "product_id").select("product_id", "category_id")
    products = one_per_key(stg_products, "product_id")
    return left_using(left_using(products, categories, "product_id"), sellers, "seller_id").select(*FCT_PRODUCTS)
