"""Ranked reports, coverage, profiles, text functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallweave.catalogue import shapes as s
from stallweave.catalogue.layers import DIM_PRODUCTS_SQL, FCT_PRODUCTS_SQL, product_facts, staged_details, staged_sellers
from stallweave.catalogue.registry import plain, query
from stallweave.functions.text import csv_ids, grouped_number, link_category_id
from stallweave.operators.predicates import build_filter, normalise_filters
from stallweave.operators.ranking import coverage, distinct_sketches, merged_sketches, profile, row_count, sample_rows, top_k
from stallweave.plans import marts, reports
from stallweave.session import scratch_path
from stallweave.sinks import bronze
from stallweave.sources.listing import inventory, list_files

#: Columns of the sample tables, for the SQL side of the profile.
TABLE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


@query(f"""WITH {FCT_PRODUCTS_SQL}
SELECT product_name, max(quantity_sold) AS quantity_sold,
  CASE WHEN length(product_name) > 45 THEN product_name[1:45] || '...' ELSE product_name END AS short_name
FROM fct_products WHERE quantity_sold IS NOT NULL GROUP BY product_name
ORDER BY quantity_sold DESC, product_name LIMIT 10""")
def top_products(spark, sf_dir):
    """D12, A1, L1, F10."""
    return reports.top_products(product_facts(spark, sf_dir))


@query(f"""WITH {DIM_PRODUCTS_SQL}
SELECT category_name, count(DISTINCT product_id) AS product_count FROM dim_products
WHERE category_name IS NOT NULL GROUP BY category_name ORDER BY product_count DESC, category_name LIMIT 10""")
def top_categories(spark, sf_dir):
    """D12, A2, L2."""
    return reports.top_categories(marts.dim_products(staged_details(spark, sf_dir)))


@query(f"""WITH {s.STG_SELLERS_SQL}
SELECT seller_name, CAST(avg_rating_point AS DOUBLE) AS avg_rating_point, total_follower, seller_review_count,
  format('{{:,}}', total_follower) || '  ★' || format('{{:.2f}}', CAST(avg_rating_point AS DOUBLE)) AS label
FROM stg_sellers
WHERE total_follower IS NOT NULL AND avg_rating_point IS NOT NULL AND seller_review_count >= 50
ORDER BY avg_rating_point * ln(greatest(total_follower, 1)) DESC, seller_id LIMIT 10""")
def top_sellers(spark, sf_dir):
    """D12, L3, P6, F21, F14."""
    return plain(reports.top_sellers(marts.dim_sellers(staged_sellers(spark, sf_dir))))


@query(f"""WITH {DIM_PRODUCTS_SQL}
SELECT category_name, count(*) AS n FROM dim_products GROUP BY category_name ORDER BY n DESC, category_name LIMIT 10""")
def coverage_by_category(spark, sf_dir):
    """A4."""
    return coverage(marts.dim_products(staged_details(spark, sf_dir)), "category_name", 10)


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, {len(c.split())} AS column_count, "
    f"unnest(range(1, {len(c.split()) + 1})) AS position, unnest({c.split()}) AS column_name"
    for t, c in TABLE_COLUMNS.items()
))
def table_profile(spark, sf_dir):
    """Rows, columns, names; type names differ between engines and are left out."""
    return profile({t: s.load(spark, sf_dir, t) for t in TABLE_COLUMNS}).drop("type").withColumn(
        "position", F.col("position").cast("bigint")
    )


_PROFILED = ("orders", "supplier", "nation")


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, (SELECT count(*) FROM {t} WHERE {c} IS NULL) AS null_count, "
    f"(SELECT count(*) FROM {t} WHERE {c} IS NOT NULL) > 0 AS has_values, TRUE AS near FROM (SELECT 1)"
    for t in _PROFILED for c in TABLE_COLUMNS[t].split()
))
def column_values(spark, sf_dir):
    """Nulls of every column, exactly; its distinct values within 3 % of the exact count."""
    tables = {t: s.load(spark, sf_dir, t) for t in _PROFILED}
    exact = None
    for name, df in tables.items():
        counts = df.agg(*[F.countDistinct(c).alias(c) for c in df.columns])
        rows = counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("exact")) for c in df.columns])))
        exact = rows if exact is None else exact.unionByName(rows)
    near = F.abs(F.col("distinct_estimate") - F.col("exact")) <= F.greatest(F.col("exact") * 0.03, F.lit(0.5))
    found = profile(tables, values=True).join(exact, ["table_name", "column_name"])
    return found.select("table_name", "column_name", "null_count", (F.col("distinct_estimate") > 0).alias("has_values"), near.alias("near"))


@query("""SELECT event_type, count(DISTINCT user_id) AS users, TRUE AS near, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS stored
FROM events GROUP BY event_type""")
def distinct_by_run(spark, sf_dir):
    """A2: users per type from one stored sketch per run (day) and type, merged; within 3 % of the exact count beside them."""
    path = scratch_path(spark, "sketches")
    events = s.load(spark, sf_dir, "events").withColumn("run", F.date_format("ts", "yyyy-MM-dd"))
    distinct_sketches(events, ["run", "event_type"], "user_id").write.parquet(path)
    stored = spark.read.parquet(path)
    merged = merged_sketches(stored, ["event_type"], "estimate").join(stored.groupBy("event_type").agg(F.count("*").alias("stored")), "event_type")
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    near = F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.col("users") * 0.03, F.lit(0.5))
    return merged.join(exact, "event_type").select("event_type", "users", near.alias("near"), "stored")


@query("""SELECT 'orders' AS table_name, (SELECT min(o_orderkey) FROM orders) AS first_key
UNION ALL SELECT 'part', (SELECT min(p_partkey) FROM part) UNION ALL SELECT 'events', (SELECT min(event_id) FROM events)""")
def ordered_samples(spark, sf_dir):
    """The first row of each table by its key."""
    keys = {"orders": "o_orderkey", "part": "p_partkey", "events": "event_id"}
    firsts = [top_k(s.load(spark, sf_dir, t), 1, F.col(k).asc()).select(F.lit(t).alias("table_name"), F.col(k).alias("first_key")) for t, k in keys.items()]
    return reduce(DataFrame.unionByName, firsts)


@query("SELECT strftime(o_orderdate, '%Y') AS prefix, TRUE AS has_objects, TRUE AS has_bytes FROM orders GROUP BY ALL")
def landed_inventory(spark, sf_dir):
    """Every landed partition has objects, and these have bytes."""
    root = scratch_path(spark, "inventory")
    orders = s.load(spark, sf_dir, "orders")
    bronze.append_partitioned(orders.withColumn("year", F.date_format("o_orderdate", "yyyy")), root, ("year",))
    found = inventory(list_files(spark, root, ".parquet"), F.regexp_extract("path", "/year=([0-9]+)/", 1))
    return found.select("prefix", (F.col("objects") > 0).alias("has_objects"), (F.col("bytes") > 0).alias("has_bytes"))


@query()
def table_samples(spark, sf_dir):
    """Any one row per table; which row is open, so rows only."""
    return sample_rows({t: s.load(spark, sf_dir, t) for t in TABLE_COLUMNS})


@query("SELECT 'lineitem' AS table_name, count(*) AS row_count FROM lineitem")
def table_row_count(spark, sf_dir):
    """A5."""
    return row_count(s.load(spark, sf_dir, "lineitem"), "lineitem")


@query()
def file_inventory(spark, sf_dir):
    """Objects and bytes per table; file sizes are not visible to SQL, so rows only."""
    return inventory(list_files(spark, sf_dir, ".parquet"), F.regexp_extract("path", r"/([^/]+)\.parquet$", 1))


@query(r"""WITH links AS (SELECT page_id, url, regexp_replace(url, '/([0-9]+)', '/c\1') AS link FROM pages)
SELECT * REPLACE (CAST(plain_id AS VARCHAR) AS plain_id, CAST(category_id AS VARCHAR) AS category_id, CAST(before_junk AS VARCHAR) AS before_junk) FROM (
SELECT page_id, TRY_CAST(NULLIF(regexp_extract(url, '/c([0-9]+)(?:[/?#]|$)', 1), '') AS BIGINT) AS plain_id,
  TRY_CAST(NULLIF(regexp_extract(link, '/c([0-9]+)(?:[/?#]|$)', 1), '') AS BIGINT) AS category_id,
  TRY_CAST(NULLIF(regexp_extract(link || '/c12abc', '/c([0-9]+)(?:[/?#]|$)', 1), '') AS BIGINT) AS before_junk
FROM links)""")
def url_category_id(spark, sf_dir):
    """page addresses as they are (no category), with category ids, and with a false ending."""
    link = F.regexp_replace("url", r"/([0-9]+)", "/c$1")
    found = s.load(spark, sf_dir, "pages").select(
        "page_id", link_category_id(F.col("url")).alias("plain_id"), link_category_id(link).alias("category_id"),
        link_category_id(F.concat(link, F.lit("/c12abc"))).alias("before_junk"),
    )
    return plain(found, "plain_id", "category_id", "before_junk")


@query("""SELECT p_partkey, format('{:,.0f}', p_retailprice * 1000) || 'đ' AS price_label,
  format('{:.1f}', p_size / 10.0::DOUBLE) || '★' AS rating_label, format('{:,.2f}', p_retailprice * p_size) AS value_label
FROM part""")
def number_labels(spark, sf_dir):
    """F14."""
    return s.load(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(grouped_number(F.col("p_retailprice") * 1000, 0), F.lit("đ")).alias("price_label"),
        F.concat(grouped_number(F.col("p_size") / 10.0, 1), F.lit("★")).alias("rating_label"),
        grouped_number(F.col("p_retailprice") * F.col("p_size"), 2).alias("value_label"),
    )


@query("""SELECT p_partkey, CASE WHEN p_size >= 10 THEN CAST(p_size * 10 AS DOUBLE) END AS min_price,
  CASE WHEN p_size <= 40 THEN p_retailprice END AS max_price, CASE WHEN p_size > 5 THEN p_size / 10.0::DOUBLE END AS min_rating,
  CASE WHEN p_size > 20 THEN p_type END AS category_keyword FROM part""")
def sentinel_filters(spark, sf_dir):
    """P10: slider ends and blank keywords become "no filter"."""
    requests = s.load(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") < 10, 0.0).otherwise(F.col("p_size") * 10.0).alias("min_price"),
        F.when(F.col("p_size") > 40, 2_000_000.0).otherwise(F.col("p_retailprice")).alias("max_price"),
        F.when(F.col("p_size") > 5, F.col("p_size") / 10.0).otherwise(0.0).alias("min_rating"),
        F.when(F.col("p_size") > 20, F.concat(F.lit("  "), "p_type", F.lit(" "))).otherwise("   ").alias("category_keyword"),
    )
    return normalise_filters(requests)


@query(f"""WITH {DIM_PRODUCTS_SQL}
SELECT product_id, price, rating_average, category_name FROM dim_products
WHERE price >= 950 AND price <= 2000 AND rating_average >= 1.5 AND category_name ILIKE '%n_m%'""")
def filtered_products(spark, sf_dir):
    """Conjunction of the filters that are set; the wildcard in the keyword stays one."""
    products = marts.dim_products(staged_details(spark, sf_dir))
    return plain(
        products.where(build_filter(950, 2000, 1.5, "N_m")).select("product_id", "price", "rating_average", "category_name")
    )


@query("""SELECT o_orderkey, unnest([o_orderkey, o_custkey]) AS listed_id FROM orders""")
def csv_id_lists(spark, sf_dir):
    """F16: valid lists explode, invalid ones (the priority words) give nothing."""
    orders = s.load(spark, sf_dir, "orders")
    good = F.concat_ws(" , ", "o_orderkey", "o_custkey")
    return orders.select("o_orderkey", F.explode(csv_ids(good)).alias("listed_id")).unionByName(
        orders.select("o_orderkey", F.explode(csv_ids(F.col("o_orderpriority"))).alias("listed_id"))
    )
