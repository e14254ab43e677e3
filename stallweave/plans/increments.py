"""Refreshes that read new runs only and carry changed keys from table to table.

Raw logs lie below one folder each, partitioned by run.  Every staging table has its own ledger of consumed runs, so one that
fails neither holds the others back nor is forgotten: its runs wait for it.  Staging tables take the rows that the new runs
change; marts take the rows that the changed keys of their inputs touch.  A mart's pointer names, together with its rows, how far
each input has been carried over.  Whatever step a driver is lost in, the next refresh does it again with the same result.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stallweave import schemas
from stallweave.plans import marts, staging
from stallweave.plans.refresh import Refresh
from stallweave.session import materialise, shuffles_dropped, side_by_side
from stallweave.sinks.bronze import PLACE, newest_rows, read_runs, run_folders, write_run_rejects
from stallweave.sinks.keyed import BUCKETS, KeyedTable
from stallweave.sinks.tables import layer_path, read_ledger

Tables = dict[str, KeyedTable]


@dataclass(frozen=True)
class Log:
    """A raw log: its folder, the columns it is read with, and the partition columns that make a run."""

    root: str
    schema: StructType
    partitions: Sequence[str] = ("dt", "run_id")


@dataclass(frozen=True)
class Feed:
    """A staging table, the log it is fed from, and the rows of the log that give it none.

    Where every run sees most keys again, ``seen`` is the key of a raw row by which ``build`` takes none but the latest ``extracted_at``.
    """

    name: str
    log: str
    key: str
    build: Callable[[DataFrame], DataFrame]
    rejects: Callable[..., DataFrame]
    seen: Callable[[DataFrame], Column] | None = None


@dataclass(frozen=True)
class Mart:
    """A mart: which keys of it changed keys of the inputs touch, and its rows for some keys or, without these, for all."""

    name: str
    key: str
    inputs: Sequence[str]
    touched: Callable[[KeyedTable, dict[str, DataFrame]], DataFrame]
    rows: Callable[[Tables, DataFrame | None], DataFrame]


def _own(source: str) -> Callable[[KeyedTable, dict[str, DataFrame]], DataFrame]:
    """A projection of one table: its changed keys are the touched ones."""
    return lambda table, changed: changed[source]


def _facts(source: str, key: str, others: dict[str, str], own: Sequence[str] = ()) -> Callable[[KeyedTable, dict[str, DataFrame]], DataFrame]:
    """Keys of a fact table: those changed in its source or in inputs of the same key, and those of rows that refer to
    a changed row of another input (``{input: column}``).  References are read from the facts themselves, two columns wide."""

    def touched(table: KeyedTable, changed: dict[str, DataFrame]) -> DataFrame:
        keys = changed[source]
        for name in own:
            keys = keys.unionByName(changed[name])
        present = table.state()["live"]
        for name, column in others.items():
            if present:
                refers = table.read().select(key, column).join(changed[name].select(F.col(changed[name].columns[0]).alias(column)), column, "left_semi")
                keys = keys.unionByName(refers.select(key))
        return keys.distinct()

    return touched


def _product_rows(tables: Tables, keys: DataFrame | None) -> DataFrame:
    products = tables["stg_products"].lookup(keys)
    sellers = tables["stg_seller_info"].lookup(keys if keys is None else products.select("seller_id"))
    return marts.fct_products(products, sellers, tables["stg_product_details"].lookup(keys))


def _review_rows(tables: Tables, keys: DataFrame | None) -> DataFrame:
    if keys is None:
        return marts.fct_reviews(*[tables[name].read() for name in ("stg_reviews", "stg_products", "stg_seller_info")])
    reviews = materialise(tables["stg_reviews"].lookup(keys), "touched-reviews")
    products = tables["stg_products"].lookup(reviews.select("product_id"))
    return marts.fct_reviews(reviews, products, tables["stg_seller_info"].lookup(reviews.select("seller_id")))


FEEDS: tuple[Feed, ...] = (
    Feed("stg_products", "products", "product_id", staging.stg_products, staging.keyless, lambda log: log["id"]),
    Feed("stg_product_details", "details", "product_id", staging.stg_product_details, staging.keyless, lambda log: log["id"]),
    Feed("stg_seller_info", "sellers", "seller_id", staging.stg_seller_info, staging.sellerless, staging.page_seller),
    Feed("stg_reviews", "reviews", "review_id", staging.stg_reviews, staging.reviewless),
    Feed("stg_categories", "categories", "category_id", staging.stg_categories, staging.categoryless),
)
MARTS: tuple[Mart, ...] = (
    Mart("dim_products", "product_id", ("stg_product_details",), _own("stg_product_details"), lambda t, k: marts.dim_products(t["stg_product_details"].lookup(k))),
    Mart("dim_sellers", "seller_id", ("stg_seller_info",), _own("stg_seller_info"), lambda t, k: marts.dim_sellers(t["stg_seller_info"].lookup(k))),
    Mart("dim_categories", "category_id", ("stg_categories",), _own("stg_categories"), lambda t, k: marts.dim_categories(t["stg_categories"].lookup(k))),
    Mart(
        "fct_reviews", "review_id", ("stg_reviews", "stg_products", "stg_seller_info"),
        _facts("stg_reviews", "review_id", {"stg_products": "product_id", "stg_seller_info": "seller_id"}), _review_rows,
    ),
    Mart(
        "fct_products", "product_id", ("stg_products", "stg_seller_info", "stg_product_details"),
        _facts("stg_products", "product_id", {"stg_seller_info": "seller_id"}, own=("stg_product_details",)), _product_rows,
    ),
)


@dataclass
class Warehouse:
    """Where the tables of an incremental warehouse lie."""

    spark: SparkSession
    root: str
    buckets: int = BUCKETS
    tables: Tables = field(default_factory=dict)
    #: All models append to one ledger, and two appends to one folder at a time would remove each other's files.
    appending: threading.Lock = field(default_factory=threading.Lock, repr=False, compare=False)

    def __post_init__(self):
        for layer, models in (("silver", FEEDS), ("marts", MARTS)):
            for model in models:
                self.tables[model.name] = KeyedTable(self.spark, layer_path(self.root, layer, model.name), model.key, self.buckets)

    @property
    def ledger(self) -> str:
        return f"{self.root.rstrip('/')}/ledger"

    def rejects(self, model: str) -> str:
        return f"{self.root.rstrip('/')}/rejects/{model}"


def unconsumed_runs(warehouse: Warehouse, model: str, log: Log) -> list[str]:
    """K8: runs of a log that the model's ledger does not name, from a listing of folders."""
    with warehouse.appending:
        ledger = read_ledger(warehouse.spark, warehouse.ledger, schemas.RUN_LEDGER)
        seen = {r["run"] for r in ledger.where(F.col("model") == model).select("run").distinct().collect()}
    return [run for run in run_folders(warehouse.spark, log.root, log.partitions) if run not in seen]


def feed(warehouse: Warehouse, model: Feed, log: Log) -> tuple[int, int]:
    """Merges the new runs of a log; returns the rows changed and the rows rejected.

    Rejects are kept by run, table rows next, and the ledger last.
    """
    runs = unconsumed_runs(warehouse, model.name, log)
    if not runs and warehouse.tables[model.name].state()["schema"]:
        return 0, 0
    # A single run has one stamp; of several the older rows of a key need not move.
    again = model.seen is not None and len(runs) > 1
    read = read_runs(warehouse.spark, log.root, log.schema, runs, log.partitions, places=again)
    raw = read.drop(PLACE)
    rejected = write_run_rejects(model.rejects(raw, tuple(log.partitions)), warehouse.rejects(model.name), log.partitions) if runs else 0
    latest = newest_rows(read, model.seen(read), "extracted_at") if again else raw
    payload = latest.select(*[c for c in raw.columns if c not in log.partitions or c in ("dt", "run_id")])
    changed = warehouse.tables[model.name].merge(model.build(payload), ["extracted_at_ts"])
    if runs:
        rows = warehouse.spark.createDataFrame([(model.name, run) for run in runs], "model STRING, run STRING")
        with warehouse.appending:
            rows.withColumn("consumed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(warehouse.ledger)
    return changed, rejected


def carry(warehouse: Warehouse, model: Mart) -> int:
    """Rebuilds the rows of a mart that its inputs' changes touch; returns how many of them differ from before."""
    table, inputs = warehouse.tables[model.name], {name: warehouse.tables[name] for name in model.inputs}
    missing = [name for name, source in inputs.items() if not source.state()["schema"]]
    if missing:
        raise ValueError(f"inputs not built yet: {missing}")
    known = table.state()["inputs"]
    reached = {name: source.state()["batch"] for name, source in inputs.items()}
    if known == reached:
        return 0
    if not table.state()["live"]:
        # A mart without rows takes all: a list of all keys would only meet the tables that it was read from.
        return table.put(model.rows(warehouse.tables, None), reached)
    changed = {name: source.changed_since(known.get(name, 0)) for name, source in inputs.items()}
    touched = materialise(model.touched(table, changed), "touched")
    return table.put(model.rows(warehouse.tables, touched), reached)


def refresh_incremental(spark: SparkSession, logs: dict[str, Log], root: str, buckets: int = BUCKETS, feeds: Sequence[Feed] = FEEDS) -> Refresh:
    """All models, staging first; one outcome each, with the rows changed by this refresh.

    Models of a layer do not read each other and are built side by side.  A failing model keeps what it had; its runs or changes are
    taken up by the next refresh.
    """
    warehouse, result = Warehouse(spark, root, buckets), Refresh()

    def attempt(name: str, layer: str, work: Callable[[], tuple[int, int | None]]) -> tuple:
        started = time.monotonic()
        try:
            (rows, rejected), status, error = work(), "ok", None
        except Exception as err:  # noqa: BLE001 - the outcome row carries the reason
            (rows, rejected), status, error = (None, None), "failed", f"{type(err).__name__}: {err}"
        return name, layer, status, rows, time.monotonic() - started, error, rejected

    silver = {m.name: lambda m=m: feed(warehouse, m, logs[m.log]) for m in feeds}
    gold = {m.name: lambda m=m: (carry(warehouse, m), None) for m in MARTS}
    with shuffles_dropped(spark):
        for layer, models in (("silver", silver), ("marts", gold)):
            result.outcomes += side_by_side(spark, [lambda name=name, work=work: attempt(name, layer, work) for name, work in models.items()])
    if not result.passed:
        raise RuntimeError(f"no model passed: {[o[5] for o in result.outcomes]}")
    return result


#: Columns of the raw logs, by name.
LOG_SCHEMAS = {
    "products": schemas.BRONZE_PRODUCTS, "details": schemas.BRONZE_DETAILS, "sellers": schemas.BRONZE_SELLERS,
    "reviews": schemas.BRONZE_REVIEWS, "categories": schemas.BRONZE_CATEGORIES,
}


def logs_below(root: str) -> dict[str, Log]:
    """The five logs below one folder, partitioned by ``dt`` and ``run_id``."""
    return {name: Log(f"{root.rstrip('/')}/{name}", schema) for name, schema in LOG_SCHEMAS.items()}
