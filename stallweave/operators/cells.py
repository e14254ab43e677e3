"""Approximate search by cells (inverted lists) with exact scoring inside the probed cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallweave.functions.vectors import l2_normalise
from stallweave.operators.search import HITS, Best, best_of, narrowed, query_columns, query_set

#: Rows of a cell that one task group scores; larger cells are split.
CELL_ROWS = 8192


def build_cells(
    index: DataFrame, lists: int | None = None, seed: int = 7, iterations: int = 10
) -> tuple[DataFrame, np.ndarray]:
    """Index rows with their ``cell`` and the cell centres.

    ``lists`` cells, by default the square root of the number of rows, so that a cell and the list of centres grow alike.
    Trained on the rows themselves, so it is rebuilt when the corpus has grown, not on an empty table.
    """
    lists = lists or max(2, round(index.count() ** 0.5))
    vectors = index.withColumn("_v", array_to_vector(l2_normalise(F.col("embedding"))))
    model = KMeans(k=lists, seed=seed, maxIter=iterations, featuresCol="_v", predictionCol="cell").fit(vectors)
    return model.transform(vectors).drop("_v"), np.array(model.clusterCenters())


def write_cells(celled: DataFrame, path: str) -> None:
    """Index laid out by cell, so a search reads only the probed folders.

    Rebalancing splits a cell that holds a large share of the rows over several files and tasks.
    """
    celled.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)


def probe(queries: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """Queries plus the ids of their ``probes`` nearest cells."""
    unit = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)

    @F.pandas_udf("array<int>")
    def cells(vectors):
        import pandas as pd

        scores = np.stack(vectors.to_list()).astype(np.float64) @ unit.T
        nearest_first = np.argsort(-scores, axis=1, kind="stable")[:, :probes]
        return pd.Series(list(nearest_first.astype(np.int32)))

    return queries.withColumn("cells", cells("embedding"))


def search_cells(
    celled: DataFrame, queries: DataFrame, centres: np.ndarray, dim: int, k: int = 5, probes: int = 10, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Top ``k`` among the probed cells; equals the exact result when every cell is probed.

    A query is sent to the cells it probes and to no other row; a cell of more than ``cell_rows`` rows is split, and its
    queries meet every part.
    """
    corpus = narrowed(celled)
    names = query_columns(queries)
    probed = probe(queries.withColumn("query_id", F.col("query_id").cast("bigint")), centres, probes)
    asked = probed.select(*names, F.explode("cells").alias("cell"))
    parts = celled.groupBy("cell").agg(F.ceil(F.count("*") / cell_rows).alias("parts"))
    rows = corpus.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("item_id"), F.col("parts")))
    sent = asked.join(parts, "cell").select(*names, "cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))

    def score(some: pa.Table, cell: pa.Table) -> pa.Table:
        best = Best(query_set(some, dim), dim, k)
        if some.num_rows and cell.num_rows:
            best.add(cell)
        return best.table()

    return best_of(sent.groupBy("cell", "part").cogroup(rows.groupBy("cell", "part")).applyInArrow(score, HITS), k)


def recall(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """Share of the exact hits that the approximate search found, per query."""
    found = approximate.select("query_id", "item_id", F.lit(1).alias("found"))
    return exact.join(found, ["query_id", "item_id"], "left").groupBy("query_id").agg(
        (F.count("found") / F.count("*")).alias("recall")
    )
