"""Sample tables shaped like landed retail data, in Spark and as the same SQL.

Every shape holds all rows of its table; the fact and integrity queries leave dimension rows out on purpose, so that
left joins meet unmatched rows.  Groups that are
packed into one JSON text are bounded by a block of a unique key (at most 40 events, 20 suppliers).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallweave.operators.tree import flatten_tree

FIRST_RUN, SECOND_RUN = "20240101_000000", "20240201_000000"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- listing log: one observation of a product per order line ------------------------------------------

LISTING_TIES = ["order_no", "line_no", "supp_no", "amount"]

LISTING_SQL = """
listing AS (
  SELECT CAST(l_partkey AS VARCHAR) AS id,
    'Product ' || l_partkey || ' grade ' || l_returnflag AS name,
    CASE WHEN l_returnflag <> 'N' THEN 'Author ' || l_suppkey END AS author_name,
    'Brand ' || l_linestatus AS brand_name, l_linestatus AS inventory_status,
    'https://img.example/' || l_partkey || '.jpg' AS thumbnail_url,
    CAST(l_extendedprice AS VARCHAR) AS price, CAST(l_extendedprice * 1.25 AS VARCHAR) AS original_price,
    CAST(l_discount * 100 AS VARCHAR) AS discount, CAST(l_discount AS VARCHAR) AS discount_rate,
    CAST(round(l_tax * 50, 2) AS VARCHAR) AS rating_average,
    CAST((l_linenumber - 1) * 10 AS VARCHAR) AS review_count,
    '{"value": ' || CAST(floor(l_extendedprice) AS BIGINT) || '}' AS quantity_sold,
    CAST(l_suppkey AS VARCHAR) AS seller_id,
    strftime(l_shipdate, '%Y%m%d_%H%M%S') AS extracted_at,
    strftime(l_shipdate, '%Y-%m-%d') AS dt, strftime(l_shipdate, '%Y%m%d_%H%M%S') AS run_id,
    l_orderkey AS order_no, l_linenumber AS line_no, l_suppkey AS supp_no, l_extendedprice AS amount
  FROM lineitem)"""

# What staging must give, straight from the order lines: one row per part, the line shipped last.
STG_PRODUCTS_SQL = """
newest_line AS (
  SELECT l_partkey, arg_max(l, (l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS l
  FROM lineitem l GROUP BY l_partkey),
stg_products AS (
  SELECT l_partkey AS product_id, format('Product {} grade {}', l_partkey, l.l_returnflag) AS product_name,
    if(l.l_returnflag = 'N', NULL, 'Author ' || l.l_suppkey) AS author_name, 'Brand ' || l.l_linestatus AS brand_name,
    l.l_linestatus AS inventory_status, round(l.l_extendedprice)::INTEGER AS price,
    round(l.l_extendedprice * 1.25)::INTEGER AS original_price, round(l.l_discount * 100)::INTEGER AS discount,
    l.l_discount::FLOAT AS discount_rate, round(l.l_tax * 50, 2)::FLOAT AS rating_average,
    (l.l_linenumber * 10 - 10)::INTEGER AS review_count, floor(l.l_extendedprice)::INTEGER AS quantity_sold,
    l.l_suppkey AS seller_id, format('https://img.example/{}.jpg', l_partkey) AS thumbnail_url,
    strftime(l.l_shipdate, '%Y-%m-%d 00:00:00') AS extracted_at_ts, strftime(l.l_shipdate, '%Y-%m-%d') AS dt,
    strftime(l.l_shipdate, '%Y%m%d_000000') AS run_id
  FROM newest_line)"""


def listing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the latest line is chosen by, the stamp as a time, and the columns of the line that ``listing_fields`` derives the others from."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("id"),
        F.col("l_shipdate").alias("extracted_at"),
        F.col("l_orderkey").alias("order_no"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("supp_no"),
        F.col("l_extendedprice").alias("amount"),
        "l_partkey", "l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_shipdate",
    )


def listing_fields(lines: DataFrame, *more: str) -> DataFrame:
    """The columns of the log, and ``more`` columns of the lines as they are."""
    stamp = F.date_format("l_shipdate", "yyyyMMdd_HHmmss")
    return lines.select(
        "id",
        F.concat(F.lit("Product "), F.col("l_partkey"), F.lit(" grade "), F.col("l_returnflag")).alias("name"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("Author "), F.col("supp_no"))).alias("author_name"),
        F.concat(F.lit("Brand "), F.col("l_linestatus")).alias("brand_name"),
        F.col("l_linestatus").alias("inventory_status"),
        F.concat(F.lit("https://img.example/"), F.col("l_partkey"), F.lit(".jpg")).alias("thumbnail_url"),
        F.col("amount").cast("string").alias("price"),
        (F.col("amount") * 1.25).cast("string").alias("original_price"),
        (F.col("l_discount") * 100).cast("string").alias("discount"),
        F.col("l_discount").cast("string").alias("discount_rate"),
        F.round(F.col("l_tax") * 50, 2).cast("string").alias("rating_average"),
        ((F.col("line_no") - 1) * 10).cast("string").alias("review_count"),
        F.concat(F.lit('{"value": '), F.floor("amount").cast("string"), F.lit("}")).alias("quantity_sold"),
        F.col("supp_no").cast("string").alias("seller_id"),
        stamp.alias("extracted_at"),
        F.to_date("l_shipdate").alias("dt"),
        stamp.alias("run_id"),
        *LISTING_TIES,
        *more,
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_fields(listing_lines(spark, sf_dir))


# --- detail pages: parts, seen in a first run and, above size 25, in a second ---------------------------

# What staging must give, straight from the parts: parts above size 25 as their second run had them.
STG_DETAILS_SQL = """
stg_details AS (
  SELECT p_partkey AS product_id, 'M' || p_partkey AS master_id, 'SKU-' || p_partkey AS sku,
    concat(p_name, ' ', p_brand) AS product_name, p_type AS short_description,
    format('{} made as {} by {}', p_name, p_type, p_brand) AS description,
    round(p_retailprice * if(p_size > 25, 1.1::DOUBLE, 1))::INTEGER AS price, round(p_retailprice * 2)::INTEGER AS list_price,
    round(p_retailprice * 1.5)::INTEGER AS original_price, p_size::INTEGER AS discount, (p_size / 2)::FLOAT AS discount_rate,
    (p_size / 10)::FLOAT AS rating_average, (p_size * 3)::INTEGER AS review_count,
    (p_size * 100)::INTEGER AS all_time_quantity_sold, (p_size * 10)::INTEGER AS quantity_sold, p_size::BIGINT AS seller_id,
    'Shop ' || p_size AS seller_name, regexp_extract(p_brand, '[0-9]+')::BIGINT AS brand_id, p_brand AS brand_name,
    (1000 + p_size % 25)::BIGINT AS category_id, p_type AS category_name, 'simple' AS type,
    if(p_size > 40, 'out_of_stock', 'available') AS inventory_status, translate(p_name, ' ', '-') AS url_key,
    format('{}-p{}.html', translate(p_name, ' ', '-'), p_partkey) AS url_path,
    if(p_size > 25, '2024-02-01', '2024-01-01') || ' 00:00:00' AS extracted_at_ts,
    if(p_size > 25, '2024-02-01', '2024-01-01') AS dt, if(p_size > 25, '20240201', '20240101') || '_000000' AS run_id
  FROM part)"""


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")

    def observed(run: str, factor: float, above: int) -> DataFrame:
        url_key = F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))
        obj = lambda **kw: F.to_json(F.struct(*[c.alias(k) for k, c in kw.items()]))
        return part.where(F.col("p_size") > above).select(
            F.col("p_partkey").cast("string").alias("id"),
            F.concat(F.lit("M"), "p_partkey").alias("master_id"),
            F.concat(F.lit("SKU-"), "p_partkey").alias("sku"),
            F.concat("p_name", F.lit(" "), "p_brand").alias("name"),
            F.col("p_type").alias("short_description"),
            F.concat("p_name", F.lit(" made as "), "p_type", F.lit(" by "), "p_brand").alias("description"),
            F.lit("simple").alias("type"),
            F.when(F.col("p_size") > 40, "out_of_stock").otherwise("available").alias("inventory_status"),
            url_key.alias("url_key"),
            F.concat(url_key, F.lit("-p"), "p_partkey", F.lit(".html")).alias("url_path"),
            (F.col("p_retailprice") * factor).cast("string").alias("price"),
            (F.col("p_retailprice") * 2).cast("string").alias("list_price"),
            (F.col("p_retailprice") * 1.5).cast("string").alias("original_price"),
            F.col("p_size").cast("string").alias("discount"),
            (F.col("p_size") / 2.0).cast("string").alias("discount_rate"),
            (F.col("p_size") / 10.0).cast("string").alias("rating_average"),
            (F.col("p_size") * 3).cast("string").alias("review_count"),
            (F.col("p_size") * 100).cast("string").alias("all_time_quantity_sold"),
            obj(value=F.col("p_size") * 10, text=F.lit("sold")).alias("quantity_sold"),
            obj(id=F.col("p_size"), name=F.concat(F.lit("Shop "), "p_size")).alias("current_seller"),
            obj(id=F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int"), name=F.col("p_brand")).alias("brand"),
            obj(id=1000 + F.col("p_size") % 25, name=F.col("p_type")).alias("categories"),
            F.lit(None).cast("string").alias("breadcrumbs"),
            F.lit(None).cast("string").alias("specifications"),
            F.lit(None).cast("string").alias("images"),
            F.lit(run).alias("extracted_at"),
            F.to_date(F.lit(run[:8]), "yyyyMMdd").alias("dt"),
            F.lit(run).alias("run_id"),
        )

    return observed(FIRST_RUN, 1.0, 0).unionByName(observed(SECOND_RUN, 1.1, 25))


# --- seller pages: seen whenever an order line names the seller ----------------------------------------

SELLER_TIES = ["order_no", "line_no", "part_no", "amount"]

# What staging must give, straight from the order lines: one row per supplier, the line shipped last.
STG_SELLERS_SQL = """
newest_sale AS (
  SELECT l_suppkey, arg_max(l, (l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS l
  FROM lineitem l GROUP BY l_suppkey),
stg_sellers AS (
  SELECT s_suppkey AS seller_id, s_name AS seller_name, translate(lower(s_name), '#', '-') AS seller_slug,
    format('https://img.example/s{}.png', s_suppkey) AS seller_logo, CAST(NULL AS VARCHAR) AS seller_icon,
    if(l.l_returnflag = 'A', 'OFFICIAL_STORE', 'NONE') AS store_level, l.l_quantity::INTEGER * 10 AS seller_review_count,
    round(l.l_tax * 40 + 1, 2)::FLOAT AS avg_rating_point, floor(l.l_extendedprice)::INTEGER AS total_follower,
    l.l_discount >= 0.05 AS is_official, translate(lower(s_name), '#', '-') AS url_key,
    strftime(l.l_shipdate, '%Y-%m-%d 00:00:00') AS extracted_at_ts, strftime(l.l_shipdate, '%Y-%m-%d') AS dt,
    strftime(l.l_shipdate, '%Y%m%d_000000') AS run_id
  FROM newest_sale JOIN supplier ON l_suppkey = s_suppkey)"""


#: Suppliers that tasks carry along, some 100 bytes each; with more of them the order lines are shuffled to meet them.
_CARRIED = 500_000


def seller_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the latest page is chosen by, the stamp as a time, and the columns that ``seller_fields`` makes the pages of.

    Names come as JSON texts, which are made once a supplier and not once an order line."""
    lines, suppliers = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "supplier")
    slug = F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("-")))
    known = suppliers.select("s_suppkey", _json_text(F.col("s_name")).alias("name_json"), _json_text(slug).alias("slug_json"))
    known = F.broadcast(known) if suppliers.count() <= _CARRIED else known
    return lines.join(known, lines["l_suppkey"] == known["s_suppkey"]).select(
        F.col("s_suppkey").alias("seller_id"), F.col("l_shipdate").alias("extracted_at"),
        F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_no"), F.col("l_extendedprice").alias("amount"),
        "name_json", "slug_json", "l_returnflag", "l_quantity", "l_discount", "l_tax", "l_shipdate",
    )


def _json_text(c: Column) -> Column:
    """A text as JSON writes it, in quotes and escaped; NULL stays NULL."""
    listed = F.to_json(F.array(c))
    return F.when(c.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))


def _json_number(c: Column) -> Column:
    """A double as JSON writes it: what is no number goes in quotes."""
    text = c.cast("string")
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text)


def seller_fields(sales: DataFrame, *more: str) -> DataFrame:
    """Pages as ``to_json`` writes them, members that are NULL left out.  Every order line has one, and joining its few members
    costs a third of a writer for each."""
    stamp = F.date_format("l_shipdate", "yyyyMMdd_HHmmss")
    members = {
        "name": F.col("name_json"), "slug": F.col("slug_json"),
        "logo": F.concat(F.lit('"https://img.example/s'), F.col("seller_id").cast("string"), F.lit('.png"')),
        "store_level": F.when(F.col("l_returnflag") == "A", '"OFFICIAL_STORE"').otherwise('"NONE"'),
        "review_count": (F.col("l_quantity").cast("int") * 10).cast("string"),
        "avg_rating_point": _json_number(F.round(F.col("l_tax") * 40 + 1, 2)),
        "total_follower": F.floor("amount").cast("string"),
        "is_official": (F.col("l_discount") >= 0.05).cast("string"), "url_key": F.col("slug_json"),
    }
    page = F.concat(
        F.lit('{"seller":{"id":'), F.col("seller_id").cast("string"),
        *[F.coalesce(F.concat(F.lit(f',"{name}":'), text), F.lit("")) for name, text in members.items()], F.lit("}}"),
    )
    return sales.select(
        "seller_id", page.alias("data"),
        stamp.alias("extracted_at"), F.to_date("l_shipdate").alias("dt"), stamp.alias("run_id"), *SELLER_TIES, *more,
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seller_fields(seller_sales(spark, sf_dir)).drop("seller_id")


# --- review pages: events of a user packed into JSON arrays; purchases are seen again in a second run ----

STG_REVIEWS_SQL = """
stg_reviews AS (
  SELECT event_id AS review_id, user_id AS product_id, user_id AS seller_id, CAST(event_id // 40 AS INTEGER) AS page,
    CAST(1 + floor(value) % 5 AS INTEGER) AS rating, event_type AS title,
    CASE WHEN event_type = 'error' THEN '' ELSE event_type || ' at ' || value END AS review_content,
    CAST(json_extract_string(props, '$.k') AS INTEGER) + CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS thank_count,
    CAST(CAST(value AS FLOAT) AS DOUBLE) AS score, user_id AS customer_id, 'User ' || user_id AS customer_name,
    CASE WHEN event_type = 'purchase' THEN strftime(ts, '%Y-%m-%d') END AS purchased_at,
    CASE WHEN event_type = 'purchase' THEN '2024-02-01 00:00:00' ELSE '2024-01-01 00:00:00' END AS extracted_at_ts,
    CASE WHEN event_type = 'purchase' THEN '2024-02-01' ELSE '2024-01-01' END AS dt,
    CASE WHEN event_type = 'purchase' THEN '20240201_000000' ELSE '20240101_000000' END AS run_id,
    strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS created_at
  FROM events)"""


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")

    def observed(rows: DataFrame, run: str, thanks: int) -> DataFrame:
        review = F.struct(
            F.col("event_id").alias("id"),
            (1 + F.floor("value") % 5).alias("rating"),
            F.col("event_type").alias("title"),
            F.when(F.col("event_type") == "error", "").otherwise(
                F.concat("event_type", F.lit(" at "), F.col("value").cast("string"))
            ).alias("content"),
            (F.get_json_object("props", "$.k").cast("int") + thanks).alias("thank_count"),
            F.col("value").alias("score"),
            F.col("user_id").alias("customer_id"),
            F.struct(F.concat(F.lit("User "), "user_id").alias("full_name")).alias("created_by"),
            F.when(F.col("event_type") == "purchase", F.date_format("ts", "yyyy-MM-dd")).alias("purchased_at"),
            F.unix_timestamp(F.col("ts").cast("timestamp")).alias("created_at"),
        )
        # Events move as they are; most pages hold one, so packing before they move would only make them wider.
        narrow = rows.select("event_id", "ts", "user_id", "event_type", "value", "props", F.expr("event_id DIV 40").alias("page"))
        return (
            narrow.repartition("user_id", "page").groupBy("user_id", "page")
            .agg(F.to_json(F.collect_list(review)).alias("data"))
            .select(
                F.col("user_id").cast("string").alias("product_id"), F.col("user_id").cast("string").alias("seller_id"),
                F.col("page").cast("string").alias("page"), "data", F.lit(run).alias("extracted_at"),
                F.to_date(F.lit(run[:8]), "yyyyMMdd").alias("dt"), F.lit(run).alias("run_id"),
            )
        )

    again = events.where("event_type = 'purchase'")
    return observed(events, FIRST_RUN, 0).unionByName(observed(again, SECOND_RUN, 1))


# --- category trees: region > nation > suppliers, one payload per 20 suppliers --------------------------

TREE_SQL = """
tree AS (
  SELECT s_nationkey AS nation, s_suppkey // 20 AS block, 'S' || s_suppkey AS menu_id,
    CASE WHEN s_acctbal > 0 THEN 10000 + s_suppkey END AS category_id, s_name AS category_name,
    CASE WHEN s_acctbal > 0 THEN '/c' || (10000 + s_suppkey) || '/' END AS link,
    'N' || n_nationkey AS parent_menu_id, CAST(1000 + n_nationkey AS BIGINT) AS parent_category_id, 3 AS level,
    r_name || ' > ' || n_name || ' > ' || s_name AS path, TRUE AS is_leaf
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT DISTINCT s_nationkey, s_suppkey // 20, 'N' || n_nationkey, CAST(1000 + n_nationkey AS BIGINT), n_name,
    '/x/c' || (1000 + n_nationkey) || '?src=menu', 'R' || r_regionkey, CAST(100 + r_regionkey AS BIGINT), 2,
    r_name || ' > ' || n_name, FALSE
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT DISTINCT s_nationkey, s_suppkey // 20, 'R' || r_regionkey, CAST(100 + r_regionkey AS BIGINT), r_name,
    '/c' || (100 + r_regionkey), NULL, NULL, 1, r_name, FALSE
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

DIM_CATEGORIES_SQL = TREE_SQL + """,
dim_categories AS (
  SELECT DISTINCT category_id, category_name, parent_category_id, level AS category_level, path, is_leaf, link,
    '2024-01-01 00:00:00' AS last_seen_at, '2024-01-01' AS dt
  FROM tree WHERE category_id IS NOT NULL)"""


def tree_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menu payloads ``(nation, block, payload)``; every region keeps its tree under another key."""
    region, nation = load(spark, sf_dir, "region"), load(spark, sf_dir, "nation")
    rows = load(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    leaf = F.struct(
        F.concat(F.lit("S"), "s_suppkey").alias("key"),
        F.col("s_name").alias("label"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("/c"), 10000 + F.col("s_suppkey"), F.lit("/"))).alias("href"),
    )
    packed = rows.groupBy(
        F.col("n_nationkey").alias("nation"), F.expr("s_suppkey DIV 20").alias("block"), "n_name", "r_regionkey", "r_name"
    ).agg(F.collect_list(leaf).alias("leaves"))
    nation_node = F.struct(
        F.concat(F.lit("N"), "nation").alias("code"), F.col("n_name").alias("title"),
        F.concat(F.lit("/x/c"), 1000 + F.col("nation"), F.lit("?src=menu")).alias("url"),
        F.col("leaves").alias("sub_menu"),
    )
    root = F.to_json(
        F.array(
            F.struct(
                F.concat(F.lit("R"), "r_regionkey").alias("id"), F.col("r_name").alias("name"),
                F.concat(F.lit("/c"), 100 + F.col("r_regionkey")).alias("link"), F.array(nation_node).alias("children"),
            )
        )
    )
    wrap = lambda head, tail="}": F.concat(F.lit(head), root, F.lit(tail))
    payload = (
        F.when(F.col("r_regionkey") == 0, wrap('{"menu_block": {"items": ', "}}"))
        .when(F.col("r_regionkey") == 1, wrap('{"menu": '))
        .when(F.col("r_regionkey") == 2, wrap('{"menu": [], "items": '))
        .when(F.col("r_regionkey") == 3, wrap('{"data": '))
        .otherwise(wrap('{"version": 1, "blocks": '))
    )
    return packed.select("nation", "block", payload.alias("payload"))


def category_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened menu rows as they land."""
    flat = flatten_tree(tree_payloads(spark, sf_dir))
    return flat.select(
        "menu_id", F.col("category_id").cast("string").alias("category_id"), "category_name", "link", "parent_menu_id",
        F.col("parent_category_id").cast("string").alias("parent_category_id"), F.col("level").cast("string").alias("level"),
        "path", F.col("is_leaf").cast("string").alias("is_leaf"), "raw_node",
        F.lit(FIRST_RUN).alias("extracted_at"), F.to_date(F.lit(FIRST_RUN[:8]), "yyyyMMdd").alias("dt"),
        F.lit(FIRST_RUN).alias("run_id"),
    )
