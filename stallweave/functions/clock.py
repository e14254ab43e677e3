"""Run clocks.  The clock is always a parameter, so a job can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stamp formats of the landing layout.
RUN_ID_FORMAT = "yyyyMMdd_HHmmss"
PARTITION_FORMAT = "yyyy-MM-dd"
EPOCH = "1970-01-01 00:00:00"


def run_id_ts(c: Column, strict: bool = True) -> Column:
    """run id text to a zone-free timestamp.  Strict raises on bad text, else NULL."""
    if strict:
        return F.to_timestamp_ntz(c, F.lit(RUN_ID_FORMAT))
    return F.try_to_timestamp(c, F.lit(RUN_ID_FORMAT)).cast("timestamp_ntz")


def unix_ts(c: Column) -> Column:
    """unix seconds to an instant."""
    return F.timestamp_seconds(c)


def run_id(ts: Column) -> Column:
    """run id of a run clock."""
    return F.date_format(ts, RUN_ID_FORMAT)


def run_dt(ts: Column) -> Column:
    """partition date of a run clock."""
    return F.date_format(ts, PARTITION_FORMAT)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text in UTC (the session zone is pinned to UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def as_clock(now: dt.datetime | str | Column | None) -> Column:
    """Timestamp column for a run clock; ``None`` means the start of the query."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return F.lit(str(now)).cast("timestamp")
