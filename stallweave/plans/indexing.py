"""Incremental index of product documents."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallweave.functions.clock import as_clock
from stallweave.operators.encode import Encoder, spread_rows, with_embedding
from stallweave.plans.documents import with_hash
from stallweave.schemas import PRODUCT_INDEX
from stallweave.session import materialise
from stallweave.sinks.tables import VersionedTable


#: Refreshes between two rewrites of the whole index.
COMPACT_EVERY = 20


def index_table(spark: SparkSession, root: str) -> VersionedTable:
    """The index: one row per product, the row committed last wins, also between refreshes of one clock."""
    return VersionedTable(spark, root, PRODUCT_INDEX, ["product_id"], last_commit_wins=True)


def changed_only(documents: DataFrame, indexed: DataFrame, key: str = "product_id") -> DataFrame:
    """Documents whose hash is not the indexed one; of ``indexed`` only key and hash are read.

    An index holds a key once, so this is the anti join on (key, hash), written over the key alone: documents
    that come out of a join on the product are already placed by it and do not move again.
    """
    known = indexed.select(key, F.col("content_hash").alias("_indexed_hash"))
    changed = F.col("_indexed_hash").isNull() | (F.col("_indexed_hash") != F.col("content_hash"))
    return documents.join(known, key, "left").where(changed).drop("_indexed_hash")


def index_incremental(
    table: VersionedTable, documents: DataFrame, encoder: Callable[[], Encoder],
    now: dt.datetime | str | Column | None = None, prune: bool = False, batch_size: int = 32, commit_rows: int = 100_000,
) -> dict[str, int]:
    """Encode what changed, add those rows, count both kinds.

    Documents are built once and written to the shared folder; what changed is written by the parts it is committed in, of about
    ``commit_rows``, so that each is read once, and dealt out by rows to the encoder. Keys are counted by themselves first: where
    each comes once, documents and vectors are not sorted to find that out. A build is committed part by part, so a run that dies goes on where it stopped: what is committed counts as
    unchanged.  Without changes no version is written.  Products gone from the mart stay (Q11) unless ``prune``.
    """
    documents, known = materialise(with_hash(documents), "hashed-documents"), table.read()
    narrow = changed_only(documents.select("product_id", "content_hash"), known)
    total, (changed, keys) = documents.count(), narrow.agg(F.count("*"), F.count_distinct("product_id")).first()
    parts = -(-changed // commit_rows)
    part = F.pmod(F.xxhash64("product_id"), F.lit(max(1, parts))).alias("_part")
    pending = materialise(changed_only(documents, known).select("*", part), "pending", "_part") if changed else None
    for number in range(parts):
        rows = pending.where(F.col("_part") == number).drop("_part")
        encoded = with_embedding(spread_rows(rows, -(-changed // parts)), "document", encoder, batch_size=batch_size)
        version = table.version() + 1
        table.add(encoded.withColumn("indexed_at", as_clock(now)), version, unique=keys == changed)
        if version % COMPACT_EVERY == 0:
            table.compact()
    if prune:
        table.replace(table.read().join(documents.select("product_id"), "product_id", "left_semi"))
    return {"documents": total, "indexed": changed, "unchanged": total - changed}
