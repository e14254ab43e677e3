"""Landing and reading back: partitions, drift, fallbacks, JSON pages, snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stallweave.catalogue import shapes as s
from stallweave.catalogue.layers import DIM_PRODUCTS_SQL, staged_details
from stallweave.catalogue.registry import as_text, plain, query
from stallweave.functions.clock import run_id_ts
from stallweave.functions.text import archive_path, partition_value
from stallweave.plans import marts, staging
from stallweave.session import scratch_path
from stallweave.sinks import bronze
from stallweave.sinks.tables import register_views, write_model
from stallweave.sources.landed import page_items, read_documents
from stallweave.sources.parquet import read_drifting, read_first_available, read_locations, read_partitioned


def _orders(spark, sf_dir):
    """Orders as a landed log: partition date = first of the year, run id = the year's run."""
    year = F.date_format("o_orderdate", "yyyy")
    return s.load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.concat(year, F.lit("-01-01")).alias("dt"),
        F.concat(year, F.lit("0101_000000")).alias("run_id"),
    )


@query("""SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 1997 THEN o_orderpriority END AS o_orderpriority,
  strftime(o_orderdate, '%Y') || '-01-01' AS dt, strftime(o_orderdate, '%Y') || '0101_000000' AS run_id FROM orders""")
def partition_merge_union(spark, sf_dir):
    """Live and archived partitions, the archived files lack a column."""
    root = scratch_path(spark, "orders")
    log = _orders(spark, sf_dir)
    bronze.append_partitioned(log.where("dt >= '1997-01-01'"), root)
    bronze.append_partitioned(log.where("dt < '1997-01-01'").drop("o_orderpriority"), f"{root}/_processed")
    schema = StructType.fromDDL("o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING, dt DATE, run_id STRING")
    both = read_locations(spark, [root, f"{root}/_processed", f"{root}/nowhere"], schema)
    return plain(both.select("o_orderkey", "o_orderpriority", "dt", "run_id"))


@query("""SELECT strftime(o_orderdate, '%Y') || '-01-01' AS dt, count(*) AS row_count, count(o_orderpriority) AS priorities
FROM orders GROUP BY 1""")
def merged_schema_scan(spark, sf_dir):
    """Partitions discovered and footers merged without a declared schema."""
    root = scratch_path(spark, "orders")
    bronze.append_partitioned(_orders(spark, sf_dir), root)
    return plain(
        read_partitioned(spark, root).groupBy("dt").agg(
            F.count("*").alias("row_count"), F.count("o_orderpriority").alias("priorities")
        )
    )


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer,
  CASE WHEN year(o_orderdate) >= 1997 THEN o_orderpriority END AS priority FROM orders""")
def drift_safe_read(spark, sf_dir):
    """S3: the id is a number in older files and text in newer ones, which also have one column more."""
    root = scratch_path(spark, "drift")
    rows = s.load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("priority"),
        F.year("o_orderdate").alias("y"), F.lit(1).alias("stray"),
    )
    old = rows.where("y < 1997").select("id", "customer", F.col("stray").cast("string").alias("stray"))
    new = rows.where("y >= 1997").select(F.col("id").cast("string").alias("id"), "customer", "priority", "stray")
    old.write.parquet(f"{root}/dt=1996-01-01/run_id=a")
    new.write.parquet(f"{root}/dt=1997-01-01/run_id=b")
    old.limit(0).write.mode("append").parquet(f"{root}/dt=1997-01-01/run_id=b")  # one folder with two shapes
    return read_drifting(spark, root, ["id", "customer", "priority"])


@query(f"WITH {DIM_PRODUCTS_SQL} SELECT * FROM dim_products")
def first_available_source(spark, sf_dir):
    """The missing and the empty candidate are passed over."""
    root = scratch_path(spark, "fallback")
    dim = marts.dim_products(staged_details(spark, sf_dir))
    dim.limit(0).write.parquet(f"{root}/empty")
    dim.write.parquet(f"{root}/legacy")
    return plain(read_first_available(spark, [f"{root}/new", f"{root}/empty", f"{root}/legacy"], require_rows=True))


@query("""SELECT event_id, event_type, value, user_id AS category, '20240301_000000' AS extracted_at, '2024-03-01' AS dt FROM events""")
def landed_json_pages(spark, sf_dir):
    """Pages ``{"data": […]}`` to stamped rows; pages without data give none."""
    path = scratch_path(spark, "pages")
    item = F.struct("event_id", "event_type", "value")
    pages = s.load(spark, sf_dir, "events").groupBy("user_id", F.expr("event_id DIV 40")).agg(
        F.to_json(F.struct(F.collect_list(item).alias("data"), F.col("user_id").alias("category"))).alias("value")
    )
    pages.select("value").unionByName(
        s.load(spark, sf_dir, "region").select(F.concat(F.lit('{"data": [], "category": '), "r_regionkey", F.lit("}")).alias("value"))
    ).write.text(path)
    documents = read_documents(spark, path, one_per_file=False)
    items = page_items(documents.withColumn("category", F.get_json_object("payload", "$.category").cast("bigint")))
    parsed = items.withColumn("r", F.from_json("item", "event_id BIGINT, event_type STRING, value DOUBLE"))
    return bronze.stamp(parsed.select("r.*", "category"), "2024-03-01 00:00:00").drop("run_id")


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y') || '-01-01' AS dt, strftime(o_orderdate, '%Y') || '0101_000000' AS run_id,
  strftime(o_orderdate, '%Y') || '-01-01 00:00:00' AS run_at, TRUE AS archived FROM orders""")
def bronze_roundtrip(spark, sf_dir):
    """Partition values read back from the file paths."""
    root = scratch_path(spark, "bronze") + "/orders"
    bronze.append_partitioned(_orders(spark, sf_dir), root)
    path = F.col("_metadata.file_path")
    found = spark.read.parquet(root).select("o_orderkey", path.alias("file")).select(
        "o_orderkey", partition_value(F.col("file"), "dt").alias("dt"), partition_value(F.col("file"), "run_id").alias("run_id"),
        archive_path(F.col("file"), "orders").contains("/orders/_processed/dt=").alias("archived"),
    )
    return plain(found.withColumn("run_at", run_id_ts(F.col("run_id"))))


@query(f"WITH {s.DIM_CATEGORIES_SQL} SELECT {as_text('parent_category_id')} FROM dim_categories")
def category_staging(spark, sf_dir):
    """A renamed older run in the archive, the current run live."""
    root = scratch_path(spark, "categories")
    current = s.category_log(spark, sf_dir)
    older = current.withColumns(
        {
            "category_name": F.concat("category_name", F.lit(" (old)")),
            "extracted_at": F.lit("20230101_000000"),
            "dt": F.lit("2023-01-01").cast("date"),
            "run_id": F.lit("20230101_000000"),
        }
    )
    bronze.append_partitioned(current, root)
    bronze.append_partitioned(older, f"{root}/_processed")
    staged = staging.stg_categories(staging.read_categories(spark, root, f"{root}/_processed"))
    return plain(marts.dim_categories(staged), "parent_category_id")


@query(f"""WITH {DIM_PRODUCTS_SQL}
SELECT category_name, count(*) AS products FROM dim_products GROUP BY category_name""")
def mart_snapshot(spark, sf_dir):
    """A mart written, registered and queried by name."""
    path = write_model(
        marts.dim_products(staged_details(spark, sf_dir)), scratch_path(spark, "warehouse"), "marts", "dim_products"
    )
    register_views(spark, {"v_dim_products": path})
    return spark.sql("SELECT category_name, count(*) AS products FROM v_dim_products GROUP BY category_name")


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 100")
def csv_preview_ordered(spark, sf_dir):
    """K6: a preview of the first rows by key."""
    path = scratch_path(spark, "preview")
    bronze.csv_preview(s.load(spark, sf_dir, "part").select("p_partkey", "p_name").orderBy("p_partkey"), path, rows=100)
    return spark.read.schema("p_partkey BIGINT, p_name STRING").csv(path, header=True)


@query()
def csv_preview(spark, sf_dir):
    """K6: any sample of the batch; which rows it holds is open, so rows only."""
    path = scratch_path(spark, "preview")
    bronze.csv_preview(s.load(spark, sf_dir, "part"), path, rows=100)
    return spark.read.csv(path, header=True)
