"""The three ranked reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallweave.functions.text import grouped_number, short_label
from stallweave.operators.predicates import min_support
from stallweave.operators.ranking import distinct_by_group, max_by_group, top_k


def top_products(fct_products: DataFrame, n: int = 10) -> DataFrame:
    """L1: best sellers by name, with their chart label."""
    sold = max_by_group(fct_products.where("quantity_sold IS NOT NULL"), "product_name", "quantity_sold")
    best = top_k(sold, n, F.col("quantity_sold").desc(), F.asc_nulls_last("product_name"))
    return best.select("product_name", "quantity_sold", short_label(F.col("product_name")).alias("short_name"))


def top_categories(dim_products: DataFrame, n: int = 10) -> DataFrame:
    """L2: categories with most products."""
    counted = distinct_by_group(
        dim_products.where("category_name IS NOT NULL"), "category_name", "product_id", "product_count"
    )
    return top_k(counted, n, F.col("product_count").desc(), F.col("category_name").asc())


def top_sellers(dim_sellers: DataFrame, n: int = 10, min_reviews: int = 50) -> DataFrame:
    """L3: sellers by rating weighted with the logarithm of their followers."""
    eligible = min_support(dim_sellers, "seller_review_count", min_reviews, "total_follower", "avg_rating_point")
    score = F.col("avg_rating_point") * F.ln(F.greatest("total_follower", F.lit(1)))
    best = top_k(eligible, n, score.desc(), F.col("seller_id").asc())
    label = F.concat(
        grouped_number(F.col("total_follower"), 0), F.lit("  ★"), grouped_number(F.col("avg_rating_point"), 2)
    )
    return best.select(
        "seller_name", "avg_rating_point", "total_follower", "seller_review_count", label.alias("label")
    )
