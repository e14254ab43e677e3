"""What to collect next."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallweave.functions.casts import int_or_zero
from stallweave.functions.clock import EPOCH, as_clock, iso_utc
from stallweave.functions.jsonx import json_text, truthy
from stallweave.functions.text import named_request_key
from stallweave.operators.dedupe import Order, latest_per_key
from stallweave.operators.joins import with_default
from stallweave.operators.predicates import leaves
from stallweave.operators.ranking import top_k
from stallweave.sinks.tables import upsert

#: Request templates of the collected interfaces, given as parameter lists.
REVIEW_INCLUDE = "comments,contribute_info,attribute_vote_summary"
REVIEW_SORT = "score|desc,id|desc,stars|all"
REVIEW_LIMIT = 20
TTL_SECONDS = 86_400


def leaf_ids(candidates: list[DataFrame]) -> DataFrame:
    """Distinct leaf ids of the first candidate table that has any."""
    for table in candidates:
        ids = leaves(table).select(F.col("category_id").try_cast("bigint").alias("category_id")).where(
            "category_id IS NOT NULL"
        ).distinct()
        if not ids.isEmpty():
            return ids
    return ids.limit(0)


def plan(leaf_table: DataFrame, state: DataFrame, budget: int) -> DataFrame:
    """The ``budget`` leaves seen longest ago, never seen first, ties by id."""
    seen = with_default(leaf_table.select("category_id"), state, "category_id", "last_crawled_at", F.lit(EPOCH).cast("timestamp"))
    return top_k(seen, max(budget, 0), F.col("last_crawled_at").asc(), F.col("category_id").asc())


def bump(state: DataFrame, chosen: DataFrame, now: dt.datetime | str | Column) -> DataFrame:
    """State after the chosen leaves were collected."""
    touched = chosen.select("category_id").distinct().withColumn("last_crawled_at", as_clock(now))
    return upsert(state.select("category_id", "last_crawled_at"), touched, "category_id")


def state_documents(state: DataFrame, now: dt.datetime | str | Column, per_document: int = 1000) -> DataFrame:
    """State as JSON documents of about ``per_document`` entries each, however many leaves there are."""
    documents = max(1, -(-state.count() // per_document))
    entry = F.struct(F.col("category_id").cast("string").alias("k"), iso_utc(F.col("last_crawled_at")).alias("v"))
    return (
        state.groupBy(F.pmod(F.xxhash64("category_id"), F.lit(documents)).alias("part"))
        .agg(F.map_from_entries(F.collect_list(entry)).alias("watermark"))
        .select(F.to_json(F.struct(iso_utc(as_clock(now)).alias("updated_at"), "watermark")).alias("value"))
    )


def write_state_documents(state: DataFrame, path: str, now: dt.datetime | str | Column, per_document: int = 1000) -> None:
    """One document per line; ``read_state(…, one_per_file=False)`` reads them back."""
    state_documents(state, now, per_document).write.mode("overwrite").text(path)


def _pair_ids(listing: DataFrame) -> DataFrame:
    """Product and seller ids of a listing row, with their fallbacks.

    A zero id falls through to the second place; a zero found there is kept, as text.
    """
    columns = set(listing.columns)
    product = truthy(F.col("id").cast("string"))
    if "product_id" in columns:
        product = F.coalesce(product, F.col("product_id").cast("string"))
    seller = truthy(F.col("seller_id").cast("string"))
    if "seller" in columns:
        seller = F.coalesce(seller, json_text(F.col("seller"), "$.id"))
    return listing.select(
        truthy(product).alias("product_id"), seller.alias("seller_id"), F.col("review_count").cast("string").alias("review_count")
    )


def derive_requests(listing: DataFrame, base_url: str, max_review_pages: int = 1) -> DataFrame:
    """``(kind, product_id, seller_id, page, request_key)`` that a listing leads to, each once.

    Detail: every product.  Seller: every distinct seller.  Review: every distinct product and seller pair
    with a positive review count, times the pages.  A row is read once and opened into what it leads to; repeats
    are dropped in its task before anything moves.
    """
    ids = _pair_ids(listing)
    sold = F.col("seller_id") != ""
    reviewed = F.col("product_id").isNotNull() & sold & F.col("review_count").isNotNull() & (int_or_zero(F.col("review_count")) > 0)
    none = F.lit(None).cast("string")

    def lead(kind: str, product: Column, seller: Column, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("kind"), product.alias("product_id"), seller.alias("seller_id")))

    leads = F.array(
        lead("detail", F.col("product_id"), none, F.col("product_id").isNotNull()),
        lead("seller", none, F.col("seller_id"), sold),
        lead("review", F.col("product_id"), F.col("seller_id"), reviewed),
    )
    each = ids.select(F.explode(F.array_compact(leads)).alias("lead")).select("lead.*").distinct()
    pages = F.when(F.col("kind") == "review", F.sequence(F.lit(1), F.lit(max_review_pages))).otherwise(F.array(F.lit(None).cast("int")))
    review = {
        "limit": str(REVIEW_LIMIT), "include": REVIEW_INCLUDE, "sort": REVIEW_SORT, "page": F.col("page").cast("string"),
        "product_id": F.col("product_id"), "seller_id": F.col("seller_id"),
    }
    key = (
        F.when(F.col("kind") == "detail", named_request_key(F.concat(F.lit(f"{base_url}/products/"), "product_id"), {"platform": "web"}))
        .when(F.col("kind") == "seller", named_request_key(F.lit(f"{base_url}/sellers"), {"seller_id": F.col("seller_id")}))
        .otherwise(named_request_key(F.lit(f"{base_url}/reviews"), review))
    )
    return each.withColumn("page", F.explode(pages)).select("kind", "product_id", "seller_id", "page", key.alias("request_key"))


def ttl_dedupe(
    requests: DataFrame, cache: DataFrame, ttl_seconds: int = TTL_SECONDS, tiebreak: Sequence[Order] | None = None
) -> DataFrame:
    """Requests whose key was not fetched within the time to live before them.

    ``requests`` has ``request_key`` and ``requested_at``; ``cache`` has ``request_key`` and ``fetched_at``.
    The cache is reduced to the newest fetch per key before it moves.  A request that goes out is a fetch itself:
    later ones of the same key count from it (``within_run``).
    """
    newest = cache.groupBy("request_key").agg(F.max("fetched_at").alias("fetched_at"))
    fresh = F.col("fetched_at") > F.col("requested_at") - F.make_dt_interval(secs=F.lit(ttl_seconds))
    asked = requests.join(newest, "request_key", "left").where(~F.coalesce(fresh, F.lit(False))).drop("fetched_at")
    return within_run(asked, ttl_seconds, tiebreak)


def within_run(requests: DataFrame, ttl_seconds: int = TTL_SECONDS, tiebreak: Sequence[Order] | None = None) -> DataFrame:
    """Of the requests of a key the first, then the first after its time to live, and so on.

    Requests of one moment are one, chosen by ``tiebreak``, before anything else moves.  The times of a key then pass
    through one task in order, which remembers the last one kept and nothing else: a key with any number of times takes the
    memory of one batch.  Rows without a key or a time are kept.
    """
    key, at = "request_key", "requested_at"
    timed = requests.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    first = latest_per_key(timed, [key, at], [], tiebreak)
    moments = first.select(key, F.unix_micros(F.col(at).cast("timestamp")).alias("at")).repartition(key).sortWithinPartitions(key, "at")
    due = moments.mapInArrow(_due_times(ttl_seconds * 1_000_000), "request_key string, at bigint").select(F.col(key).alias("_key"), F.col("at").alias("_at"))
    kept = first.join(due, (F.col(key) == F.col("_key")) & (F.unix_micros(F.col(at).cast("timestamp")) == F.col("_at")), "left_semi")
    return kept.unionByName(requests.where(F.col(key).isNull() | F.col(at).isNull()))


def _due_times(ttl: int):
    """Keeps, of (request_key, at) sorted by both, the times at least ``ttl`` after the last one kept."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last = None, 0
        for batch in batches:
            keys, times = batch.column("request_key"), batch.column("at").to_numpy()
            ends = np.flatnonzero(np.r_[pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False), True]) + 1 if len(times) else []
            chosen, start = [], 0
            for end in ends:
                here = keys[start].as_py()
                if here != key:
                    key = here
                    chosen.append(start)
                    last, place = times[start], start
                while (place := start + int(np.searchsorted(times[start:end], last + ttl))) < end:
                    chosen.append(place)
                    last = times[place]
                start = end
            yield batch.take(pa.array(chosen, pa.int64()))

    return kept
