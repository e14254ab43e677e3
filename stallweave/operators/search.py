"""Exact and cell-limited nearest neighbours for a table of queries.

Scoring is a matrix product per Arrow batch inside the tasks; only the best ``k`` rows per query leave a
task, so no table of query-document pairs ever exists.  Vectors travel alone: names, texts and prices are
joined to the winners afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallweave.functions.vectors import SCORE_DIGITS
from stallweave.operators.dedupe import ranked
from stallweave.operators.ranking import top_k
from stallweave.session import materialise

#: Query vectors that travel to the tasks at a time; a setting of memory, it changes no result.
CHUNK_BYTES = 64 * 1024 * 1024
#: Queries multiplied with a batch at a time; bounds the score matrix held by a task.
SCORE_ROWS = 256
#: Pairs scored in double precision at a time, of those that single precision does not rule out.
SCORE_PAIRS = 65_536

HITS = "query_id BIGINT, item_id BIGINT, similarity DOUBLE"
_FILTERS = ("min_price", "max_price", "min_rating", "category_keyword")


def retrieve_one(index: DataFrame, query: list[float], condition: Column, k: int = 5) -> DataFrame:
    """D18 for a single question: filters reach the Parquet scan, then the common plan and a join to the winners."""
    spark, kept = index.sparkSession, index.where(condition)
    asked = spark.createDataFrame([(0, [float(x) for x in query])], "query_id bigint, embedding array<float>")
    corpus = kept.select(F.col("product_id").alias("item_id"), "embedding")
    hits = nearest(corpus, asked, len(query), k).select(F.col("item_id").alias("product_id"), "similarity", "rank")
    return top_k(kept.join(hits, "product_id"), k, F.col("rank").asc()).drop("rank")


def _like(pattern: str) -> re.Pattern:
    """Case-insensitive SQL pattern as a regular expression; backslash quotes the next character."""
    out, quoted = [], False
    for ch in pattern:
        if quoted or ch not in "%_\\":
            out.append(re.escape(ch))
            quoted = False
        elif ch == "\\":
            quoted = True
        else:
            out.append(".*" if ch == "%" else ".")
    return re.compile("".join(out), re.IGNORECASE | re.DOTALL)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix; a missing vector becomes NaN, one of another size is an error."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = np.full((len(column), dim), np.nan)
    there = np.asarray(column.is_valid())
    lengths = np.asarray(pc.list_value_length(column.drop_null()))
    if (lengths != dim).any():
        raise ValueError(f"vector of {lengths[lengths != dim][0]} components, expected {dim}")
    rows[there] = np.asarray(column.drop_null().flatten(), np.float64).reshape(-1, dim)
    return rows


def query_set(table: pa.Table, dim: int) -> dict:
    """A bounded set of queries as plain arrays: unit vectors and filters, an absent bound as infinity."""
    names, n = set(table.column_names), table.num_rows
    bound = lambda f, absent: (
        table[f].cast(pa.float64()).fill_null(absent).to_numpy() if f in names else np.full(n, absent)
    )
    words = table["category_keyword"].to_pylist() if "category_keyword" in names else [None] * n
    return {
        "ids": table["query_id"].to_numpy(),
        "vectors": _unit(_matrix(table["embedding"], dim)),
        "bounds": [("price", np.greater_equal, bound("min_price", -np.inf)), ("price", np.less_equal, bound("max_price", np.inf)),
                   ("rating_average", np.greater_equal, bound("min_rating", -np.inf))],
        "words": [w or None for w in words],
    }


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / lengths  # a zero vector turns into NaN, as its similarity must


def _passes(items: pa.Table, queries: dict, part: slice) -> np.ndarray:
    """Which items each query of ``part`` may return: P9 as a matrix.  An absent bound lets NULL pass."""
    keep = np.ones((len(queries["ids"][part]), items.num_rows), dtype=bool)
    for column, test, bounds in queries["bounds"]:
        asked = np.flatnonzero(np.isfinite(bounds[part]))
        if len(asked):
            values = items[column].cast(pa.float64()).to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore"):
                keep[asked] &= test(values[None, :], bounds[part][asked][:, None])
    words = queries["words"][part]
    wanted = sorted({w for w in words if w})
    if wanted:
        coded = items["category_name"].combine_chunks().dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        names = coded.dictionary.to_pylist()
        for word in wanted:
            pattern = _like(f"%{word}%")
            hit = np.array([pattern.fullmatch(v) is not None for v in names] + [False])
            keep[[i for i, w in enumerate(words) if w == word]] &= hit[codes]
    return keep


class Best:
    """The best ``k`` items met so far for each of a set of queries; ties go by item id."""

    def __init__(self, queries: dict, dim: int, k: int):
        self.queries, self.dim, self.k = queries, dim, k
        n = len(queries["ids"])
        self.query, self.item, self.rank, self.score = (np.empty(0, t) for t in (np.int64, np.int64, float, float))
        self.floor = np.full(n, -np.inf)

    def add(self, items: pa.Table) -> None:
        """Scores a batch against all queries and keeps what is at least as good as each query's k-th so far.

        All pairs are scored in single precision; those that may be as good, given its error, are scored again in double.
        """
        ids, vectors = items["item_id"].to_numpy(), _unit(_matrix(items["embedding"], self.dim))
        found = [(self.query, self.item, self.rank, self.score)]
        rough, unscored = vectors.T.astype(np.float32), np.isnan(vectors).any(axis=1)
        # What single precision may be wrong by for unit vectors, and the rounding of the scores.
        slack = (self.dim + 16) * 2.0**-23 + 10.0**-SCORE_DIGITS
        filtered = any(np.isfinite(bounds).any() for _, _, bounds in self.queries["bounds"]) or any(self.queries["words"])
        for start in range(0, len(self.floor), SCORE_ROWS):
            part = slice(start, start + SCORE_ROWS)
            asked, floor = self.queries["vectors"][part], self.floor[part]
            near = asked.astype(np.float32) @ rough
            if unscored.any():
                near[:, unscored] = -2.0
            near[np.isnan(asked).any(axis=1)] = -2.0
            if filtered:
                near[~_passes(items, self.queries, part)] = -np.inf
            open_ended = np.flatnonzero(np.isneginf(floor))
            if len(open_ended) and len(ids) > self.k:
                # Only queries that have no k-th item yet need the k-th of this batch.
                floor = floor.copy()
                floor[open_ended] = np.partition(near[open_ended], len(ids) - self.k, axis=1)[:, len(ids) - self.k] - slack
            q, i = np.nonzero((near >= (floor - slack)[:, None]) & (near > -np.inf))
            for some in range(0, len(q), SCORE_PAIRS):
                rows, places = q[some : some + SCORE_PAIRS], i[some : some + SCORE_PAIRS]
                score = np.round(np.einsum("nd,nd->n", asked[rows], vectors[places]), SCORE_DIGITS)
                rank = np.where(np.isnan(score), -2.0, score)
                kept = rank >= self.floor[part][rows]
                found.append((rows[kept] + start, ids[places[kept]], rank[kept], score[kept]))
        query, item, rank, score = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((item, -rank, query))
        query = query[order]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, np.int64)
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        kept = order[place < self.k]
        self.query, self.item, self.rank, self.score = query[place < self.k], item[kept], rank[kept], score[kept]
        last = place[place < self.k] == self.k - 1
        self.floor[self.query[last]] = self.rank[last]

    def table(self) -> pa.Table:
        ids = np.asarray(self.queries["ids"], np.int64)[self.query]
        return pa.table({"query_id": pa.array(ids, pa.int64()), "item_id": pa.array(self.item, pa.int64()), "similarity": pa.array(self.score)})


def query_columns(queries: DataFrame) -> list[str]:
    return [c for c in ("query_id", "embedding", *_FILTERS) if c in queries.columns]


def narrowed(corpus: DataFrame) -> DataFrame:
    """Ids, vectors and the columns that queries filter on; nothing else takes part in the ranking."""
    return corpus.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("embedding").cast("array<float>").alias("embedding"),
        *[F.col(c).cast("double").alias(c) for c in ("price", "rating_average") if c in corpus.columns],
        *[c for c in ("category_name", "cell") if c in corpus.columns],
    )


def best_of(hits: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of every query with their rank; undefined similarities come last."""
    order = [F.expr("IF(isnan(similarity), -2D, similarity)").desc()]
    return ranked(hits, ["query_id"], order, "rank", tiebreak=[F.col("item_id").asc()]).where(F.col("rank") <= k)


def nearest(corpus: DataFrame, queries: DataFrame, dim: int, k: int = 5, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Exact top ``k`` per query as ``(query_id, item_id, similarity, rank)``.

    ``corpus`` has ``item_id``, ``embedding`` and the columns its queries filter on (``price``, ``rating_average``,
    ``category_name``); ``queries`` has ``query_id``, ``embedding`` and any of the filter columns.  Queries go to the
    tasks in chunks of about ``chunk_bytes``; for each chunk the corpus is read where it lies (of several chunks, from a copy of its narrow
    columns, so that vectors are not made anew for each), without a shuffle, and a task sends its best ``k`` per query once.  A chunk's hits are written before the next one, so the driver holds one
    chunk.  A vector that has not ``dim`` components is an error, NULL has no similarity.
    """
    spark, corpus = corpus.sparkSession, narrowed(corpus)
    queries = queries.select(F.col("query_id").cast("bigint").alias("query_id"), *[c for c in query_columns(queries) if c != "query_id"])
    queries = materialise(queries, "queries")
    chunks = max(1, -(-queries.count() * dim * 8 // chunk_bytes))
    if chunks > 1:
        corpus = materialise(corpus, "corpus")
    hits = None
    for chunk in range(chunks):
        table = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(chunks)) == chunk).toArrow()
        shared = spark.sparkContext.broadcast(query_set(table, dim))

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = Best(shared.value, dim, k)
            for batch in batches:
                if batch.num_rows:
                    best.add(pa.Table.from_batches([batch]))
            yield from best.table().to_batches()

        found = materialise(best_of(corpus.mapInArrow(score, HITS), k), "hits")
        shared.unpersist()
        hits = found if hits is None else hits.unionByName(found)
    return hits
