"""Stored daily states: merging batches equals aggregating all ticks, and no old tick is read."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from candela.operators import daily_state as D
from candela.operators import gold as G
from candela.plans.catalog import canon, ticks
from candela.schema import GOLD, GOLD_COLS
from candela.session import scratch_path

SF = "/root/testdata/sf0.001"
TICK = "symbol string, event_time timestamp, source string, price double, volume bigint"


def _rows(df):
    return sorted(tuple(r) for r in canon(df).collect())


@pytest.fixture
def night(spark):
    """Previous gold and state log, the new ticks (late ones of earlier days included) and all ticks."""
    t = ticks(spark, SF, "user")
    is_new = (F.col("event_time") >= "2024-01-25") | ((F.col("event_time") >= "2024-01-22") & (F.col("offset") % 5 == 0))
    log, gold = scratch_path(spark, "states"), scratch_path(spark, "gold")
    D.write_generation(D.daily_states(t.filter(~is_new)), log)
    D.gold_from_states(D.state_log(spark, log)).write.parquet(gold)
    return spark.read.schema(GOLD).parquet(gold).select(*GOLD_COLS), log, t.filter(is_new), t


def test_update_equals_full_and_again(spark, night):
    prev, log, new, everything = night
    full = _rows(G.gold_daily(everything))
    for _ in range(2):  # the second run replaces the batch's folder
        batch = D.append_batch(new, log, "night")
        assert _rows(G.replaced_from(prev, *D.gold_changes(prev, log, batch))) == full
    D.compact(spark, log)
    assert D.generations(spark, log) == [1]
    assert D.state_log(spark, log).groupBy("symbol", "trade_date").count().filter("count > 1").isEmpty()
    assert _rows(D.gold_from_states(D.state_log(spark, log))) == full


def test_update_reads_no_tick_and_only_the_batch_days(spark, night):
    prev, log, new, _ = night
    batch = D.append_batch(new, log, "night")
    recomputed, start = D.gold_changes(prev, log, batch)
    files = recomputed.inputFiles()
    assert files and all("/states-" in f or "/gold-" in f for f in files)
    scans = [x for x in recomputed._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    # The log's scans carry the batch's days as a partition filter; the other scans read gold and the batch's own folder.
    of_log = [x for x in scans if "batch_id#" in x]
    assert of_log and all(re.search(r"PartitionFilters: \[.*trade_date#\d+ (IN|INSET) ", x) for x in of_log)


def test_incomplete_generation_is_not_seen(spark, night):
    _, log, _, _ = night
    before = _rows(D.gold_from_states(D.state_log(spark, log)))
    # A rebuild that died before its last step left files, but no _SUCCESS.
    D.daily_states(spark.createDataFrame([("X", dt.datetime(2024, 1, 1), "s", 1.0, 1)], TICK)).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{log}/gen=7/batch_id=base")
    assert D.generations(spark, log) == [0]
    assert _rows(D.gold_from_states(D.state_log(spark, log))) == before


def test_empty_batch_and_missing_log(spark, night):
    prev, log, new, _ = night
    assert D.gold_changes(prev, log, D.append_batch(new.limit(0), log, "empty")) is None
    with pytest.raises(FileNotFoundError):
        D.state_log(spark, scratch_path(spark, "none"))


def test_many_sources_of_one_day(spark):
    """As many sources as ticks: sums merge them, no row gathers them."""
    t = spark.range(20_000).select(
        F.lit("A").alias("symbol"), (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=F.col("id"))).alias("event_time"),
        F.concat(F.lit("s"), F.col("id")).alias("source"), (F.lit(1e6) + F.col("id") % 7).alias("price"), F.lit(1).cast("bigint").alias("volume"),
    )
    got, want = G.daily_ohlcv(t).first(), t.agg(F.avg("price"), F.stddev_samp("price")).first()
    assert abs(got.avg_price - want[0]) < 1e-6 and abs(got.volatility - want[1]) < 1e-9
    assert (got.open_price, got.close_price) == (1e6, 1e6 + 19_999 % 7)
    flat = G.daily_ohlcv(t.withColumn("price", F.lit(0.1))).first()
    assert flat.volatility == 0.0
    plan = G.daily_ohlcv(t)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
