"""The 24 hour rule, exact, over a batch and as a stream's state machine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stallweave.plans import rotation
from stallweave.streaming.ttl import requests_due

START = dt.datetime(2024, 1, 1)
SCHEMA = "request_key string, requested_at timestamp, n int"


def at(hours):
    return START + dt.timedelta(hours=hours)


def asked(spark, *rows):
    return spark.createDataFrame([(k, None if h is None else at(h), n) for n, (k, h) in enumerate(rows)], SCHEMA)


def plain(rows):
    last, kept = {}, set()
    for k, h in sorted((r for r in rows if None not in r), key=lambda r: (r[1], r[0])):
        if k not in last or h - last[k] >= 24:
            last[k] = h
            kept.add((k, h))
    return kept


#: Repeats after 23, 25 and 49 hours; a request just within and just at its time; many in one moment.
ROWS = [("a", 0), ("a", 23), ("a", 25), ("a", 49), ("b", 0), ("b", 23.999), ("b", 24), ("b", 47.5), ("b", 48), ("c", 5), ("c", 5), ("c", 5), ("d", 100)]


def test_batch_rule(spark):
    got = rotation.within_run(asked(spark, *ROWS))
    times = {(r["request_key"], (r["requested_at"] - START).total_seconds() / 3600) for r in got.collect()}
    assert times == plain(ROWS) and {("a", 0), ("a", 25), ("a", 49)} <= times and ("a", 23) not in times
    assert got.count() == len(times)
    odd = rotation.within_run(asked(spark, (None, 1), (None, 1), ("x", None), ("x", 1)))
    assert odd.count() == 4
    assert rotation.within_run(asked(spark, ("x", 1)).limit(0)).count() == 0


def test_key_with_a_million_times(spark):
    """One key with 10^6 times among others passes as a stream of batches: nothing holds its times together."""
    n = 1_000_000
    many = spark.range(n).select(
        F.when(F.col("id") % 1000 == 7, F.concat(F.lit("k"), (F.col("id") % 13).cast("string"))).otherwise("hot").alias("request_key"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.pmod(F.col("id") * 7919, F.lit(n)) * 60_000_000).alias("requested_at"),
    )
    got = rotation.within_run(many)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan
    keys = got.groupBy("request_key").agg(F.count("*").alias("n"), F.min(F.unix_micros("requested_at")).alias("first")).collect()
    counts = {r["request_key"]: r["n"] for r in keys}
    # The hot key has nearly every minute of 694 days: one request a day, or a few minutes later where a minute is another key's.
    assert len(counts) == 14 and 690 <= counts["hot"] <= 695


def run_stream(spark, tmp_path, *landings, **options):
    where, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    for rows in landings:
        asked(spark, *rows).repartition(3).write.mode("append").parquet(where)
        stream = spark.readStream.schema(SCHEMA).parquet(where)
        query = requests_due(stream, **options).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        query.option("path", out).trigger(availableNow=True).start().awaitTermination()
    return [(r["request_key"], (r["requested_at"] - START).total_seconds() / 3600) for r in spark.read.schema(SCHEMA).parquet(out).collect()]


def test_stream_rule_over_restarts(spark, tmp_path):
    ordered = sorted(ROWS, key=lambda r: r[1])
    got = run_stream(spark, tmp_path, [r for r in ordered if r[1] < 10], [r for r in ordered if 10 <= r[1] < 30], [r for r in ordered if r[1] >= 30])
    assert sorted(got) == sorted(plain(ROWS)) and len(got) == len(set(got))


def test_stream_forgets_with_its_timer(spark, tmp_path):
    """State leaves a day after the request that went out; a request out of order is taken as a repeat."""
    got = run_stream(spark, tmp_path, [("a", 0), ("z", 30)], [("a", 31), ("z", 29.5)], [("z", 80)], [("a", 79.5), ("q", 81)], delay="2 hours")
    assert sorted(got) == [("a", 0), ("a", 31), ("a", 79.5), ("q", 81), ("z", 30), ("z", 80)]


def test_stream_keeps_state_by_buckets(spark, tmp_path):
    """Keys share the state of their bucket; a state, a frame and a timer per key made the stream grow by 8 ms a key."""
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path))
    plan = requests_due(stream)._jdf.queryExecution().logical().toString()
    assert "FlatMapGroupsInPandasWithState" in plan and "pmod(xxhash64(request_key" in plan


def test_stream_of_few_buckets(spark, tmp_path):
    """Keys that share a bucket keep their own times, over landings and through its timeout."""
    rows = [(f"k{n}", h) for n in range(40) for h in (n, n + 23, n + 25, n + 60)]
    ordered = sorted(rows, key=lambda r: r[1])
    got = run_stream(spark, tmp_path, ordered[:50], ordered[50:120], ordered[120:], buckets=2)
    assert sorted(got) == sorted(plain(rows))


def test_stream_ties_and_missing_times(spark, tmp_path):
    """Of requests of one moment the first by all columns goes out, and rows without a time are kept, as in the batch."""
    got = spark.createDataFrame([("a", at(0), 2), ("a", None, 1), ("a", at(0), 1), ("a", None, 1), ("a", at(30), 5)], SCHEMA)
    where, out = str(tmp_path / "in"), str(tmp_path / "out")
    got.repartition(3).write.parquet(where)
    query = requests_due(spark.readStream.schema(SCHEMA).parquet(where)).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    query.option("path", out).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(SCHEMA).parquet(out).collect()
    assert sorted((r["requested_at"] or START, r["n"]) for r in rows) == [(START, 1), (START, 1), (START, 1), (at(30), 5)]
