"""Layered full refresh of all models, one outcome row per model.  ``increments.py`` refreshes by what is new."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from stallweave.plans import marts, staging
from stallweave.sinks.tables import layer_path, read_model, replace_table

SUMMARY = "model STRING, layer STRING, status STRING, row_count BIGINT, seconds DOUBLE, error STRING, rejected BIGINT"

@dataclass(frozen=True)
class Model:
    """A table of a layer: its inputs by name and the function that builds it from them."""

    name: str
    layer: str
    inputs: Sequence[str]
    build: Callable[..., DataFrame]
    #: Input rows that cannot become rows of the model; they are kept beside it and counted.
    rejects: Callable[..., DataFrame] | None = None


MODELS: tuple[Model, ...] = (
    Model("stg_products", "silver", ("products",), staging.stg_products, staging.keyless),
    Model("stg_product_details", "silver", ("details",), staging.stg_product_details, staging.keyless),
    Model("stg_seller_info", "silver", ("sellers",), staging.stg_seller_info, staging.sellerless),
    Model("stg_reviews", "silver", ("reviews",), staging.stg_reviews, staging.reviewless),
    Model("stg_categories", "silver", ("categories",), staging.stg_categories, staging.categoryless),
    Model("dim_products", "marts", ("stg_product_details",), marts.dim_products, lambda rows: marts.unkeyed(rows, "product_id")),
    Model("dim_sellers", "marts", ("stg_seller_info",), marts.dim_sellers),
    Model("dim_categories", "marts", ("stg_categories",), marts.dim_categories),
    Model("fct_reviews", "marts", ("stg_reviews", "stg_products", "stg_seller_info"), marts.fct_reviews),
    Model("fct_products", "marts", ("stg_products", "stg_seller_info", "stg_product_details"), marts.fct_products),
)


@dataclass
class Refresh:
    """Outcome of a refresh."""

    outcomes: list[tuple] = field(default_factory=list)

    @property
    def passed(self) -> int:
        return sum(1 for o in self.outcomes if o[2] == "ok")

    def summary(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.outcomes, SUMMARY)


def downstream(name: str) -> set[str]:
    """A model and everything built from it."""
    chosen = {name}
    for model in MODELS:
        if chosen & set(model.inputs):
            chosen.add(model.name)
    return chosen


def refresh(
    spark: SparkSession, bronze: dict[str, DataFrame], warehouse: str, only: set[str] | None = None, models: Sequence[Model] = MODELS
) -> Refresh:
    """Build the models in their fixed order, each from the written tables of the layer before.

    Rows are counted while they are written.  Rejected rows are replaced below ``<warehouse>/rejects/<model>``.  One failing
    model does not stop the others; when none passes, the refresh as a whole fails.  ``models`` may build some from narrower logs.
    """
    layers = {m.name: m.layer for m in models}
    result = Refresh()
    for model in models:
        if only is not None and model.name not in only:
            continue
        started, rejected = time.monotonic(), None
        try:
            inputs = [bronze[name] if name in bronze else read_model(spark, warehouse, layers[name], name) for name in model.inputs]
            rows, status, error = replace_table(model.build(*inputs), layer_path(warehouse, model.layer, model.name)), "ok", None
            if model.rejects is not None:
                rejected = replace_table(model.rejects(*inputs), f"{warehouse.rstrip('/')}/rejects/{model.name}")
        except Exception as err:  # noqa: BLE001 - the outcome row carries the reason
            rows, status, error = None, "failed", f"{type(err).__name__}: {err}"
        result.outcomes.append((model.name, model.layer, status, rows, time.monotonic() - started, error, rejected))
    if result.outcomes and not result.passed:
        raise RuntimeError(f"no model passed: {[o[5] for o in result.outcomes]}")
    return result
