"""Staging, marts, hierarchy, integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from stallweave import schemas
from stallweave.catalogue import shapes as s
from stallweave.catalogue.registry import as_text, plain, query
from stallweave.functions.casts import double_to_integral, text_to
from stallweave.functions.jsonx import json_text, nested_to_text
from stallweave.operators.dedupe import latest_per_key, merge_latest
from stallweave.operators.joins import ancestors, check_pk, with_parent
from stallweave.operators.tree import flatten_tree
from stallweave.plans import bi, marts, staging
from stallweave.session import materialise


def staged_products(spark, sf_dir):
    return staging.stg_products(s.listing_lines(spark, sf_dir), s.LISTING_TIES, s.listing_fields)


def staged_details(spark, sf_dir):
    return staging.stg_product_details(s.details(spark, sf_dir))


def staged_sellers(spark, sf_dir):
    return staging.stg_seller_info(s.seller_sales(spark, sf_dir), s.SELLER_TIES, s.seller_fields)


def staged_reviews(spark, sf_dir):
    return staging.stg_reviews(s.review_pages(spark, sf_dir))


def staged_categories(spark, sf_dir):
    return staging.stg_categories(s.category_log(spark, sf_dir))


def category_dimension(spark, sf_dir):
    return marts.dim_categories(staged_categories(spark, sf_dir))


def product_facts(spark, sf_dir):
    return marts.fct_products(staged_products(spark, sf_dir), seen_sellers(spark, sf_dir), seen_details(spark, sf_dir))


def review_facts(spark, sf_dir):
    return marts.fct_reviews(staged_reviews(spark, sf_dir), staged_products(spark, sf_dir), seen_sellers(spark, sf_dir))


def seen_sellers(spark, sf_dir):
    return staged_sellers(spark, sf_dir).where(f"NOT ({NO_SELLER})")


def seen_details(spark, sf_dir):
    return staged_details(spark, sf_dir).where(f"NOT ({NO_DETAILS})")


#: Pages that were not collected, so that facts meet keys without a dimension row.
NO_SELLER, NO_DETAILS = "seller_review_count > 400", "discount > 45"

_SPARSE_SQL = f"""
seen_sellers AS (FROM stg_sellers WHERE NOT {NO_SELLER}),"""

#: What a seen seller's newest order line says of it; seen are those whose line is of 40 pieces or fewer.
_SHOP = """(SELECT {'name': s_name, 'official': l.l_discount >= 0.05, 'level': if(l.l_returnflag = 'A', 'OFFICIAL_STORE', 'NONE')}
  FROM newest_sale, supplier WHERE s_suppkey = l_suppkey AND l_suppkey = seller_id AND l.l_quantity <= 40)"""

FCT_PRODUCTS_SQL = f"""{s.STG_PRODUCTS_SQL},{s.STG_SELLERS_SQL},{s.STG_DETAILS_SQL},{_SPARSE_SQL}
seen_details AS (FROM stg_details WHERE NOT {NO_DETAILS}),
fct_products AS (
  SELECT product_id, product_name, author_name, brand_name, price, original_price, discount, discount_rate::DOUBLE AS discount_rate,
    rating_average::DOUBLE AS rating_average, review_count, inventory_status, quantity_sold, seller_id, shop.name AS seller_name,
    shop.official AS is_official, shop.level AS store_level, category_id, thumbnail_url, extracted_at_ts, dt
  FROM (SELECT *, {_SHOP} AS shop, (SELECT 1000 + p_size % 25 FROM part WHERE p_partkey = product_id AND p_size <= 45)::BIGINT AS category_id FROM stg_products))"""

FCT_REVIEWS_SQL = f"""{s.STG_REVIEWS_SQL},{s.STG_PRODUCTS_SQL},{s.STG_SELLERS_SQL},{_SPARSE_SQL}
fct_reviews AS (
  SELECT review_id, product_id, listed.name AS product_name, listed.brand AS brand_name, seller_id, shop.name AS seller_name, rating, score, title,
    review_content, thank_count, customer_id, customer_name, created_at, purchased_at, extracted_at_ts, dt
  FROM (SELECT *, {_SHOP} AS shop, (SELECT {{'name': format('Product {{}} grade {{}}', l_partkey, l.l_returnflag), 'brand': 'Brand ' || l.l_linestatus}}
                                    FROM newest_line WHERE l_partkey = product_id) AS listed FROM stg_reviews))"""

DIM_PRODUCTS_SQL = f"""{s.STG_DETAILS_SQL},
dim_products AS (
  SELECT product_id, sku, product_name, short_description, description, price, list_price, original_price, discount,
    CAST(discount_rate AS DOUBLE) AS discount_rate, CAST(rating_average AS DOUBLE) AS rating_average, review_count,
    all_time_quantity_sold, quantity_sold, seller_id, seller_name, brand_id, brand_name, category_id, category_name,
    type, inventory_status, url_key, url_path, extracted_at_ts AS last_seen_at, dt
  FROM stg_details)"""

_STG_LISTING = f"""WITH {s.STG_PRODUCTS_SQL}
SELECT * REPLACE (CAST(discount_rate AS DOUBLE) AS discount_rate, CAST(rating_average AS DOUBLE) AS rating_average)
FROM stg_products"""


@query(_STG_LISTING)
def stg_listing_latest(spark, sf_dir):
    """D2, P1-P3, C1, F1, F17, W1."""
    return plain(staged_products(spark, sf_dir))


@query(_STG_LISTING)
def cumulative_merge(spark, sf_dir):
    """The state up to 1998 merged with later observations equals the state over everything."""
    log = s.listing(spark, sf_dir)
    order = ["extracted_at", *s.LISTING_TIES]
    before = latest_per_key(log.where("dt < DATE'1998-01-01'"), ["id"], order)
    state = merge_latest(before, log.where("dt >= DATE'1998-01-01'"), ["id"], order)
    return plain(staging.stg_products(state, s.LISTING_TIES))


@query(f"""WITH {s.STG_DETAILS_SQL}
SELECT * REPLACE (CAST(discount_rate AS DOUBLE) AS discount_rate, CAST(rating_average AS DOUBLE) AS rating_average)
FROM stg_details""")
def stg_details_flatten(spark, sf_dir):
    """D3, F1, F4, C1; JSON columns passed through unread are left out of the comparison."""
    return plain(staged_details(spark, sf_dir).drop("categories", "breadcrumbs", "specifications", "images"))


@query(f"""WITH {s.STG_SELLERS_SQL}
SELECT * REPLACE (CAST(avg_rating_point AS DOUBLE) AS avg_rating_point) FROM stg_sellers""")
def stg_seller_distinct_on(spark, sf_dir):
    """D4, A7, F1."""
    return plain(staged_sellers(spark, sf_dir))


@query(f"WITH {s.STG_REVIEWS_SQL} SELECT * FROM stg_reviews")
def stg_reviews_explode(spark, sf_dir):
    """D5, F2, F3, W3, F18, P4."""
    return plain(staged_reviews(spark, sf_dir))


@query(f"WITH {DIM_PRODUCTS_SQL} SELECT * FROM dim_products")
def dim_products(spark, sf_dir):
    """D7."""
    return plain(marts.dim_products(staged_details(spark, sf_dir)))


@query(f"""WITH {s.STG_SELLERS_SQL}
SELECT seller_id, seller_name, seller_slug, seller_logo, store_level, seller_review_count,
  CAST(avg_rating_point AS DOUBLE) AS avg_rating_point, total_follower, is_official, url_key,
  extracted_at_ts AS last_seen_at, dt
FROM stg_sellers""")
def dim_sellers(spark, sf_dir):
    """D7."""
    return plain(marts.dim_sellers(staged_sellers(spark, sf_dir)))


@query(f"WITH {s.DIM_CATEGORIES_SQL} SELECT {as_text('parent_category_id')} FROM dim_categories")
def dim_category_canonical(spark, sf_dir):
    """D8, W4, D6, W2."""
    return plain(category_dimension(spark, sf_dir), "parent_category_id")


@query(f"WITH {FCT_REVIEWS_SQL} SELECT * FROM fct_reviews")
def fct_reviews_enriched(spark, sf_dir):
    """D9, J1, J3."""
    return plain(review_facts(spark, sf_dir))


@query("""WITH pages AS (
  SELECT event_id, user_id, event_id // 40 AS page, '20240101_000000' AS run_id FROM events
  UNION ALL SELECT event_id, user_id, event_id // 40, '20240201_000000' FROM events WHERE event_type = 'purchase'),
cut AS (SELECT *, user_id < page AS broken FROM pages)
SELECT DISTINCT 'rejected' AS outcome, user_id AS id, CAST(page AS VARCHAR) AS page, run_id FROM cut WHERE broken
UNION ALL SELECT 'kept', event_id, CAST(any_value(page) AS VARCHAR), max(run_id) FROM cut WHERE NOT broken GROUP BY event_id""")
def stg_reviews_rejects(spark, sf_dir):
    """Every page is either read or set aside; some are cut off in their last review."""
    raw = s.review_pages(spark, sf_dir)
    short = F.col("product_id").cast("bigint") < F.col("page").cast("bigint")
    pages = raw.withColumn("data", F.when(short, F.expr("substr(data, 1, length(data) - 9)")).otherwise(F.col("data")))
    kept = staging.stg_reviews(pages).select(F.lit("kept").alias("outcome"), F.col("review_id").alias("id"), F.col("page").cast("string"), "run_id")
    rejected = staging.unreadable(pages).select(F.lit("rejected").alias("outcome"), F.col("product_id").cast("bigint").alias("id"), "page", "run_id")
    return kept.unionByName(rejected)


@query(f"""WITH {s.STG_REVIEWS_SQL},{s.STG_PRODUCTS_SQL}
SELECT review_id, p.product_name FROM stg_reviews r LEFT JOIN stg_products p ON r.product_id = p.product_id""")
def fct_reviews_dirty_ids(spark, sf_dir):
    """Raw ids ``7``, ``7.0`` and ``abc``; no review is multiplied, none is lost."""
    listing = s.listing_lines(spark, sf_dir)
    dirty = listing.unionByName(listing.withColumn("id", F.concat("id", F.lit(".0")))).unionByName(listing.withColumn("id", F.lit("abc")))
    facts = marts.fct_reviews(staged_reviews(spark, sf_dir), staging.stg_products(dirty, s.LISTING_TIES, s.listing_fields), seen_sellers(spark, sf_dir))
    return facts.select("review_id", "product_name")


@query(f"WITH {FCT_PRODUCTS_SQL} SELECT {as_text('category_id')} FROM fct_products")
def fct_products_enriched(spark, sf_dir):
    """D10, J2."""
    return plain(product_facts(spark, sf_dir), "category_id")


@query(f"""WITH {s.DIM_CATEGORIES_SQL}
SELECT {as_text('parent_category_id')}, split_part(path, ' > ', 1) AS root_category_name, split_part(path, '/', 1) AS slash_root FROM dim_categories""")
def bi_category_root(spark, sf_dir):
    """Both separators."""
    dim = category_dimension(spark, sf_dir)
    both = bi.bi_categories(bi.bi_categories(dim, "/").withColumnRenamed("root_category_name", "slash_root"))
    return plain(both, "parent_category_id")


@query(f"""WITH {DIM_PRODUCTS_SQL},{s.DIM_CATEGORIES_SQL}
SELECT p.* EXCLUDE (category_name), CAST(c.category_level AS VARCHAR) AS category_level,
  CAST(c.parent_category_id AS VARCHAR) AS parent_category_id, c.path AS category_path
FROM dim_products p LEFT JOIN dim_categories c USING (category_id)""")
def bi_product_hierarchy(spark, sf_dir):
    """D11, J3, J7."""
    products = marts.dim_products(staged_details(spark, sf_dir))
    return plain(bi.bi_products(products, category_dimension(spark, sf_dir)), "category_level", "parent_category_id")


@query(f"""WITH {FCT_PRODUCTS_SQL},{s.DIM_CATEGORIES_SQL}
SELECT f.* REPLACE (CAST(f.category_id AS VARCHAR) AS category_id), c.path AS category_path FROM fct_products f LEFT JOIN dim_categories c USING (category_id)""")
def bi_fact_path(spark, sf_dir):
    """D11, J3, J7."""
    return plain(bi.bi_facts(product_facts(spark, sf_dir), category_dimension(spark, sf_dir)), "category_id")


@query(f"WITH {s.TREE_SQL} SELECT {as_text('category_id', 'parent_category_id')} FROM tree")
def tree_flatten(spark, sf_dir):
    """Every node of every payload."""
    flat = flatten_tree(s.tree_payloads(spark, sf_dir)).drop("raw_node")
    return plain(flat, "category_id", "parent_category_id")


@query(f"""WITH {s.DIM_CATEGORIES_SQL}
SELECT c.* REPLACE (CAST(c.parent_category_id AS VARCHAR) AS parent_category_id), p.category_name AS parent_name,
  CAST(p.category_level AS VARCHAR) AS parent_level
FROM dim_categories c LEFT JOIN dim_categories p ON c.parent_category_id = p.category_id""")
def hierarchy_parent(spark, sf_dir):
    """J9."""
    return plain(with_parent(category_dimension(spark, sf_dir)), "parent_category_id", "parent_level")


@query(f"""WITH RECURSIVE {s.DIM_CATEGORIES_SQL},
up AS (
  SELECT c.category_id, p.category_id AS ancestor_id, 1 AS distance
  FROM dim_categories c JOIN dim_categories p ON c.parent_category_id = p.category_id
  UNION ALL
  SELECT up.category_id, p.category_id, distance + 1
  FROM up JOIN dim_categories c ON up.ancestor_id = c.category_id
    JOIN dim_categories p ON c.parent_category_id = p.category_id)
SELECT * FROM up""")
def hierarchy_ancestors(spark, sf_dir):
    """All ancestors with their distance."""
    return ancestors(category_dimension(spark, sf_dir))


@query("""WITH chain AS (SELECT c_custkey // 1000 AS line, c_custkey % 1000 AS depth, c_custkey FROM customer)
SELECT a.c_custkey AS category_id, b.c_custkey AS ancestor_id, CAST(a.depth - b.depth AS INTEGER) AS distance
FROM chain a JOIN chain b ON a.line = b.line AND a.depth > b.depth AND a.depth % 100 = 99""")
def deep_ancestors(spark, sf_dir):
    """Chains of 1,000 levels, one for every 1,000 customers; the ancestors of each hundredth level."""
    key = F.col("c_custkey")
    chain = s.load(spark, sf_dir, "customer").select(key.alias("category_id"), F.when(key % 1000 > 0, key - 1).alias("parent_category_id"))
    return ancestors(chain, "category_id % 100 = 99")


@query(f"""WITH {FCT_PRODUCTS_SQL},{s.STG_REVIEWS_SQL},{s.DIM_CATEGORIES_SQL},
used AS (
  SELECT 'dim_products.category_id' AS relation, category_id AS missing_key FROM seen_details
    WHERE category_id NOT IN (SELECT category_id FROM dim_categories)
  UNION ALL SELECT 'fct_products.category_id', category_id FROM fct_products
    WHERE category_id NOT IN (SELECT category_id FROM dim_categories)
  UNION ALL SELECT 'fct_products.product_id', product_id FROM fct_products
    WHERE product_id NOT IN (SELECT product_id FROM seen_details)
  UNION ALL SELECT 'fct_products.seller_id', seller_id FROM fct_products
    WHERE seller_id NOT IN (SELECT seller_id FROM seen_sellers)
  UNION ALL SELECT 'fct_reviews.product_id', product_id FROM stg_reviews
    WHERE product_id NOT IN (SELECT product_id FROM seen_details)
  UNION ALL SELECT 'dim_categories.parent_category_id', parent_category_id FROM dim_categories
    WHERE parent_category_id NOT IN (SELECT category_id FROM dim_categories))
SELECT relation, missing_key, count(*) AS row_count FROM used GROUP BY ALL""")
def fk_violations(spark, sf_dir):
    """J8 over all declared relationships, of written tables."""
    details, sellers = materialise(seen_details(spark, sf_dir), "details"), materialise(seen_sellers(spark, sf_dir), "sellers")
    products, reviews = materialise(staged_products(spark, sf_dir), "products"), staged_reviews(spark, sf_dir)
    tables = (
        marts.dim_products(details), category_dimension(spark, sf_dir), marts.dim_sellers(sellers),
        marts.fct_products(products, sellers, details), marts.fct_reviews(reviews, products, sellers),
    )
    return bi.integrity(*[materialise(t, f"checked-{i}") for i, t in enumerate(tables)])


@query("""SELECT 'order_line' AS relation, l_orderkey || '|' || l_linenumber AS duplicate_key, count(*) AS row_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), count(*) FROM customer GROUP BY c_custkey HAVING count(*) > 1""")
def pk_duplicates(spark, sf_dir):
    """A key with duplicates and one without."""
    lines, customers = s.load(spark, sf_dir, "lineitem"), s.load(spark, sf_dir, "customer")
    return check_pk(lines, ["l_orderkey", "l_linenumber"], "order_line").unionByName(
        check_pk(customers, "c_custkey", "customer")
    )


@query(f"""SELECT {as_text('words', 'overflow')} FROM (SELECT o_orderkey,
  TRY_CAST(CAST(o_totalprice AS VARCHAR) AS INTEGER) AS decimal_text,
  TRY_CAST('  ' || o_totalprice || ' ' AS INTEGER) AS padded_text,
  TRY_CAST(o_orderpriority AS INTEGER) AS words,
  TRY_CAST(o_orderkey || 'e1' AS BIGINT) AS exponent,
  TRY_CAST(o_totalprice / 2 AS INTEGER) AS from_double,
  TRY_CAST('-' || CAST(floor(o_totalprice) AS BIGINT) || '.5' AS INTEGER) AS negative_half,
  TRY_CAST(CAST(o_orderkey * 1000000 AS VARCHAR) AS INTEGER) AS overflow,
  TRY_CAST(CAST(o_orderkey * 1000000 AS VARCHAR) AS BIGINT) AS wide,
  CAST(TRY_CAST(CAST(o_totalprice AS VARCHAR) AS FLOAT) AS DOUBLE) AS single,
  CAST(TRY_CAST(o_orderpriority AS FLOAT) AS DOUBLE) AS no_number,
  TRY_CAST(lower(o_orderstatus) AS BOOLEAN) AS flag
FROM orders)""")
def try_cast_matrix(spark, sf_dir):
    """Text and double forms of numbers, words, overflow."""
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    text = price.cast("string")
    forms = s.load(spark, sf_dir, "orders").select(
        key,
        text_to(text, "int").alias("decimal_text"),
        text_to(F.concat(F.lit("  "), text, F.lit(" ")), "int").alias("padded_text"),
        text_to(F.col("o_orderpriority"), "int").alias("words"),
        text_to(F.concat(key.cast("string"), F.lit("e1")), "bigint").alias("exponent"),
        double_to_integral(price / 2, "int").alias("from_double"),
        text_to(F.concat(F.lit("-"), F.floor(price).cast("string"), F.lit(".5")), "int").alias("negative_half"),
        text_to((key * 1000000).cast("string"), "int").alias("overflow"),
        text_to((key * 1000000).cast("string"), "bigint").alias("wide"),
        text_to(text, "float").cast("double").alias("single"),
        text_to(F.col("o_orderpriority"), "float").cast("double").alias("no_number"),
        text_to(F.lower("o_orderstatus"), "boolean").alias("flag"),
    )
    return plain(forms, "words", "overflow")


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing,
  json_extract_string(json_object('a', json_object('b', json(props))), '$.a.b.k') AS nested FROM events""")
def json_paths(spark, sf_dir):
    """present, missing and nested paths."""
    wrapped = F.concat(F.lit('{"a":{"b":'), F.col("props"), F.lit("}}"))
    return s.load(spark, sf_dir, "events").select(
        "event_id", json_text(F.col("props"), "$.k").alias("k"), json_text(F.col("props"), "$.missing").alias("missing"),
        json_text(wrapped, "$.a.b.k").alias("nested"),
    )


@query("""SELECT o_orderkey, CAST(json_object('status', o_orderstatus, 'customer', o_custkey, 'note', NULL) AS VARCHAR) AS body,
  CAST(json_array(o_orderkey, o_custkey) AS VARCHAR) AS keys FROM orders""")
def nested_as_text(spark, sf_dir):
    """nested columns to JSON text, null members kept."""
    body = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer"), F.lit(None).cast("string").alias("note"))
    return nested_to_text(
        s.load(spark, sf_dir, "orders").select("o_orderkey", body.alias("body"), F.array("o_orderkey", "o_custkey").alias("keys"))
    )
