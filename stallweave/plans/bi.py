"""Views shaped for a BI model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallweave.functions.text import PATH_SEPARATOR, root_segment
from stallweave.operators.joins import foreign_keys, unmatched_keys, with_category
from stallweave.operators.predicates import with_exprs
from stallweave.schemas import DIM_PRODUCTS


def bi_categories(dim_categories: DataFrame, sep: str = PATH_SEPARATOR) -> DataFrame:
    """Categories plus the name of their root; ``sep='/'`` keeps whole paths (Q5)."""
    return with_exprs(dim_categories, root_category_name=root_segment(F.col("path"), sep))


def bi_products(dim_products: DataFrame, dim_categories: DataFrame) -> DataFrame:
    """Products with hierarchy columns instead of the denormalised category name."""
    joined = with_category(
        dim_products.drop("category_name"), dim_categories,
        category_level="category_level", parent_category_id="parent_category_id", category_path="path",
    )
    at = DIM_PRODUCTS.names.index("category_id") + 1
    plain = [c for c in DIM_PRODUCTS.names if c != "category_name"]
    return joined.select(*plain[:at], "category_level", "parent_category_id", "category_path", *plain[at:])


def bi_facts(fct_products: DataFrame, dim_categories: DataFrame) -> DataFrame:
    """Product facts with the category path."""
    joined = with_category(fct_products, dim_categories, category_path="path")
    return joined.select(*fct_products.columns, "category_path")


def integrity(
    dim_products: DataFrame, dim_categories: DataFrame, dim_sellers: DataFrame, fct_products: DataFrame,
    fct_reviews: DataFrame,
) -> DataFrame:
    """J8 over the declared many-to-one relationships of the model, every table read once."""
    used = [
        foreign_keys(dim_products, "dim_products", {"category_id": "dim_categories"}),
        foreign_keys(fct_products, "fct_products", {"category_id": "dim_categories", "product_id": "dim_products", "seller_id": "dim_sellers"}),
        foreign_keys(fct_reviews, "fct_reviews", {"product_id": "dim_products"}),
        foreign_keys(dim_categories, "dim_categories", {"parent_category_id": "dim_categories"}),
    ]
    parents = {
        "dim_categories": dim_categories.select("category_id"), "dim_products": dim_products.select("product_id"),
        "dim_sellers": dim_sellers.select("seller_id"),
    }
    return unmatched_keys(used, parents)
