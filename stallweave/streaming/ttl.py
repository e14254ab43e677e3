"""Time-limited deduplication of a request stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

TTL = "24 hours"
TTL_SECONDS = 86_400
#: Fixed value: the state store; it keeps the times of all keys on disk and not on the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Buckets that keys are dealt to unless the caller says otherwise, and their column.
BUCKETS, BUCKET = 1024, "_bucket"


def suppress_repeats(requests: DataFrame, key: str = "request_key", ts: str = "requested_at", ttl: str = TTL) -> DataFrame:
    """First request per key within ``ttl`` of event time; state older than the watermark is dropped.

    Suppression lasts at least ``ttl``: state leaves with the watermark.  The exact rule is ``requests_due``.
    """
    return requests.withWatermark(ts, ttl).dropDuplicatesWithinWatermark([key])


def _due(key: str, ts: str, ttl_seconds: int):
    """Per bucket of keys the time of each key's last request that went out; a timeout forgets those that nothing can be within
    the time to live of.  A bucket's state comes and goes with its rows, so a key costs no call of its own."""
    ttl = ttl_seconds * 1_000_000

    def due(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = dict(zip(*state.get)) if state.exists else {}
        if not state.hasTimedOut:
            frame = pd.concat(list(frames), ignore_index=True).drop(columns=BUCKET)
            chosen = _going_out(frame, key, ts, ttl, last)
            if chosen:
                yield frame.iloc[chosen]
        kept = {name: at for name, at in last.items() if _forgotten_at(at, ttl) > state.getCurrentWatermarkMs()}
        if kept:
            state.update((list(kept), list(kept.values())))
            state.setTimeoutTimestamp(_forgotten_at(min(kept.values()), ttl))
        elif state.exists:
            state.remove()

    return due


def _forgotten_at(at: int, ttl: int) -> int:
    """Watermark, in milliseconds, that no request within ``ttl`` of ``at`` can come behind."""
    return (at + ttl) // 1000 + 1


def _going_out(frame: pd.DataFrame, key: str, ts: str, ttl: int, last: dict) -> list[int]:
    """Places of the rows that go out; ``last`` is brought up to date.  Rows without a key or a time are kept."""
    codes, names = pd.factorize(frame[key])
    names = names.tolist()
    there = (codes >= 0) & frame[ts].notna().to_numpy()
    times = frame[ts].to_numpy().astype("datetime64[us]").astype(np.int64)
    rows = np.flatnonzero(there)
    rows = rows[np.lexsort((times[rows], codes[rows]))]
    times, codes = times[rows], codes[rows]
    bounds = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1], True]) if len(rows) else []
    chosen = np.flatnonzero(~there).tolist()
    for start, end in zip(bounds[:-1], bounds[1:]):
        name, own = names[codes[start]], times[start:end]
        place = int(np.searchsorted(own, last[name] + ttl)) if name in last else 0
        while place < len(own):
            last[name] = at = int(own[place])
            after = int(np.searchsorted(own, at, side="right"))
            chosen.append(_first(frame, rows[start + place : start + after]))
            place = int(np.searchsorted(own, at + ttl))
    return chosen


def _first(frame: pd.DataFrame, rows: np.ndarray) -> int:
    """Of rows of one moment the first by all columns, so that the choice does not depend on the order of arrival."""
    if len(rows) == 1:
        return int(rows[0])
    some = frame.iloc[rows].reset_index(drop=True)
    return int(rows[some.sort_values(list(some.columns), kind="stable").index[0]])


def requests_due(
    requests: DataFrame, key: str = "request_key", ts: str = "requested_at", ttl_seconds: int = TTL_SECONDS, delay: str = "1 hour",
    buckets: int = BUCKETS,
) -> DataFrame:
    """The stream of requests that go out: the first of a key, then the first not within ``ttl_seconds`` of it, and so on.

    The same rule as the batch ``ttl_dedupe`` where a key's requests arrive in the order of their times from one micro-batch
    to the next (within a batch any order will do); one that arrives after a later request of its key went out is taken as a
    repeat of it.  State is one time per key, kept by buckets of keys, and leaves by a timeout ``ttl_seconds`` after it.  Rows
    older than the watermark (``delay`` behind the newest) are late and go; rows without a key or a time are kept.  A task holds
    the rows of one bucket in one micro-batch and the bucket's times, so many keys want more ``buckets``; their number belongs
    to the checkpoint and stays what it was.
    """
    requests.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    dealt = requests.withWatermark(ts, delay).withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    state = T.StructType([T.StructField("keys", T.ArrayType(requests.schema[key].dataType)), T.StructField("at", T.ArrayType(T.LongType()))])
    return dealt.groupBy(BUCKET).applyInPandasWithState(
        _due(key, ts, ttl_seconds), requests.schema, state, "append", GroupStateTimeout.EventTimeTimeout
    )
