"""Keyed state and late ticks: copies within the horizon, restarts, bounded state, nothing lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candela.operators import ingest, quality
from candela.operators.window_stats import window_stats
from candela.plans.catalog import canon, ticks
from candela.session import scratch_path, session_conf
from candela.sources import fixtures as fx
from candela.streaming import keyed_state, late
from candela.streaming import queries as P
from candela.streaming.replay import chunks, replay
from candela.streaming.sources import file_source

SF = "/root/testdata/sf0.001"
BOUNDED = {"availableNow": True}
KEYS = ["symbol", "event_time", "source", "offset"]


def _clean(env):
    rows = ingest.parse_ticks(ingest.decode_envelope(env)).drop("json_value")
    return rows.filter(quality.silver_predicate(rows.columns))


def _rows(df):
    return sorted(map(tuple, canon(df).collect()), key=str)


@pytest.fixture(scope="module")
def envelope(spark):
    return fx.envelope_from_ticks(fx.redelivered_ticks(ticks(spark, SF))).checkpoint()


def test_state_dedup_over_restarts(spark, envelope):
    """Copies in one batch and in later ones, a restart after each chunk, buckets of an hour and of a day."""
    # Every 7th message comes again two hours later, in another chunk if it falls there.
    again = envelope.filter(F.col("offset") % 7 == 0).withColumns(
        {"timestamp": F.col("timestamp") + F.expr("INTERVAL 2 HOURS"), "offset": F.col("offset") + 50_000_000}
    )
    env = envelope.unionByName(again).checkpoint()
    out = scratch_path(spark, "silver")
    with session_conf(spark, keyed_state.ROCKSDB):
        replay(spark, env, lambda s, ck: keyed_state.start_silver_dedup_state(s, out, ck, trigger=BOUNDED, bucket="1 day"))
    want = quality.dedup(_clean(env)).select(*KEYS)
    assert _rows(spark.read.parquet(out).select(*KEYS)) == _rows(want)


def test_state_is_bounded_by_the_horizon(spark):
    """A day of ticks a batch: state holds the horizon's keys, not the history's."""
    start = dt.datetime(2024, 1, 1)
    landing, ck, out = (scratch_path(spark, n) for n in ("landing", "ck", "silver"))
    sizes = []
    with session_conf(spark, keyed_state.ROCKSDB):
        for day in range(5):
            rows = [
                ("A", start + dt.timedelta(days=day, minutes=10 * i), f"s{k}", 1.0, 1, day * 1000 + i) for i in range(100) for k in range(2)
            ]
            t = spark.createDataFrame(rows, "symbol string, event_time timestamp, source string, price double, volume bigint, offset bigint")
            t = t.withColumns({"kafka_timestamp": F.col("event_time"), "partition": F.lit(0)})
            fx.envelope_from_ticks(t.withColumn("offset", F.col("offset") * 1_271_957 + 1)).write.mode("append").parquet(landing)
            q = keyed_state.start_silver_dedup_state(file_source(spark, landing), out, ck, trigger=BOUNDED, horizon="2 hours")
            q.awaitTermination()
            assert q.exception() is None
            sizes.append(q.recentProgress[-1].stateOperators[0].numRowsTotal)
    assert spark.read.parquet(out).count() == _clean(spark.read.parquet(landing)).count() > 500
    # Two hours and a bucket of one hold at most 3 * 6 * 2 keys and a few rows of bookkeeping a bucket.
    assert max(sizes) <= 60 and sizes[-1] <= sizes[0] + 20


def test_late_split_loses_nothing(spark, envelope):
    """Reversed delivery: input = windows + late, and the windows are those that the stream itself keeps."""
    out, log = scratch_path(spark, "late"), scratch_path(spark, "log")
    replay(spark, envelope, lambda s, ck: late.start_late_split(P.clean_ticks(s), out, ck, trigger=BOUNDED), reverse=True)
    replay(spark, envelope, lambda s, ck: P.start_window_stats(P.clean_ticks(s), ck, log, trigger=BOUNDED), reverse=True)
    counts = {r.kind: r.n for r in late.window_accounting(spark, out).collect()}
    assert counts["input"] == counts["windows"] + counts["late"] == quality.quality_filter(ingest.parse_ticks(ingest.decode_envelope(envelope))).count()
    assert counts["late"] > 0
    assert _rows(window_stats(late.on_time(spark, out))) == _rows(P.latest_window_stats(spark, log))


def test_late_batch_run_again(spark, envelope):
    """A batch written a second time replaces its folders; ticks without a time go to the side table."""
    out = scratch_path(spark, "late")
    write = late.split_batch(out)
    first, *_, last = [P.clean_ticks(c) for c in chunks(envelope)]
    timeless = first.limit(3).withColumn("event_time", F.lit(None).cast("timestamp"))
    write(last, 0)
    write(first.unionByName(timeless), 1)
    before = _rows(late.late_rows(spark, out))
    write(first.unionByName(timeless), 1)
    assert _rows(late.late_rows(spark, out)) == before and len(before) == first.count() + 3
    write(last.limit(0), 2)
    write(first, 3)  # after an empty batch the watermark is still known
    assert late.late_rows(spark, out).count() == 2 * first.count() + 3
