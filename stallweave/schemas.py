"""Declared layer schemas.  Raw JSON-ish columns stay STRING; typing happens in the silver step."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "FLOAT": T.FloatType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "DECIMAL(18,4)": T.DecimalType(18, 4),
    "ARRAY<FLOAT>": T.ArrayType(T.FloatType()),
}

_STAMP = "extracted_at STRING, dt DATE, run_id STRING"


def _schema(columns: str) -> T.StructType:
    """Schema from ``name TYPE, …`` without needing a session at import time."""
    pairs = [column.split(" ", 1) for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BRONZE_PRODUCTS = _schema(
    "id STRING, name STRING, author_name STRING, brand_name STRING, inventory_status STRING, "
    "thumbnail_url STRING, price STRING, original_price STRING, discount STRING, discount_rate STRING, "
    "rating_average STRING, review_count STRING, quantity_sold STRING, seller_id STRING, "
    "crawl_category_id BIGINT, " + _STAMP
)

BRONZE_DETAILS = _schema(
    "id STRING, master_id STRING, sku STRING, name STRING, short_description STRING, description STRING, "
    "type STRING, inventory_status STRING, url_key STRING, url_path STRING, price STRING, list_price STRING, "
    "original_price STRING, discount STRING, discount_rate STRING, rating_average STRING, review_count STRING, "
    "all_time_quantity_sold STRING, quantity_sold STRING, current_seller STRING, brand STRING, "
    "categories STRING, breadcrumbs STRING, specifications STRING, images STRING, " + _STAMP
)

BRONZE_SELLERS = _schema("data STRING, " + _STAMP)

BRONZE_REVIEWS = _schema("product_id STRING, seller_id STRING, page STRING, data STRING, " + _STAMP)

BRONZE_CATEGORIES = _schema(
    "menu_id STRING, category_id STRING, category_name STRING, link STRING, parent_menu_id STRING, "
    "parent_category_id STRING, level STRING, path STRING, is_leaf STRING, raw_node STRING, " + _STAMP
)

SELLER_JSON = (
    "seller STRUCT<id: STRING, name: STRING, slug: STRING, logo: STRING, icon: STRING, store_level: STRING, "
    "review_count: STRING, avg_rating_point: STRING, total_follower: STRING, is_official: STRING, "
    "url_key: STRING>"
)

REVIEW_JSON = (
    "id STRING, rating STRING, title STRING, content STRING, thank_count STRING, score STRING, "
    "customer_id STRING, created_by STRUCT<full_name: STRING>, purchased_at STRING, created_at STRING"
)

STG_CATEGORIES = _schema(
    "menu_id STRING, category_id BIGINT, category_name STRING, link STRING, parent_menu_id STRING, "
    "parent_category_id BIGINT, category_level INT, path STRING, is_leaf BOOLEAN, "
    "extracted_at_ts TIMESTAMP_NTZ, dt DATE, run_id STRING"
)

DIM_PRODUCTS = _schema(
    "product_id BIGINT, sku STRING, product_name STRING, short_description STRING, description STRING, "
    "price INT, list_price INT, original_price INT, discount INT, discount_rate FLOAT, rating_average FLOAT, "
    "review_count INT, all_time_quantity_sold INT, quantity_sold INT, seller_id BIGINT, seller_name STRING, "
    "brand_id BIGINT, brand_name STRING, category_id BIGINT, category_name STRING, type STRING, "
    "inventory_status STRING, url_key STRING, url_path STRING, last_seen_at TIMESTAMP_NTZ, dt DATE"
)

FCT_REVIEWS = _schema(
    "review_id BIGINT, product_id BIGINT, product_name STRING, brand_name STRING, seller_id BIGINT, "
    "seller_name STRING, rating INT, score FLOAT, title STRING, review_content STRING, thank_count INT, "
    "customer_id BIGINT, customer_name STRING, created_at TIMESTAMP, purchased_at STRING, "
    "extracted_at_ts TIMESTAMP_NTZ, dt DATE"
)

PRODUCT_INDEX = _schema(
    "product_id BIGINT, product_name STRING, category_id BIGINT, category_name STRING, seller_id BIGINT, "
    "seller_name STRING, brand_name STRING, price DECIMAL(18,4), rating_average DECIMAL(18,4), "
    "review_count INT, document STRING, content_hash STRING, embedding ARRAY<FLOAT>, indexed_at TIMESTAMP"
)

ROTATION_STATE = _schema("category_id BIGINT, last_crawled_at TIMESTAMP")

LEDGER = _schema("entity STRING, dt STRING, run_id STRING, consumed_at TIMESTAMP")

#: Runs that a model has consumed, as folders of its log.
RUN_LEDGER = _schema("model STRING, run STRING, consumed_at TIMESTAMP")

MANIFEST = _schema("dt STRING, run_id STRING, entity STRING, row_count BIGINT, completed_at TIMESTAMP")

#: Columns of the fact tables, in order.
FCT_REVIEWS = (
    "review_id", "product_id", "product_name", "brand_name", "seller_id", "seller_name", "rating", "score", "title",
    "review_content", "thank_count", "customer_id", "customer_name", "created_at", "purchased_at", "extracted_at_ts", "dt",
)
FCT_PRODUCTS = (
    "product_id", "product_name", "author_name", "brand_name", "price", "original_price", "discount", "discount_rate",
    "rating_average", "review_count", "inventory_status", "quantity_sold", "seller_id", "seller_name", "is_official",
    "store_level", "category_id", "thumbnail_url", "extracted_at_ts", "dt",
)
