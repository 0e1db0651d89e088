"""Streaming guarantees: restart without loss or repeat, dual sinks, failure, late data."""

import time

import pytest
from pyspark.sql import functions as F

from candela.plans.catalog import canon, ticks
from candela.session import scratch_path
from candela.sources import fixtures as fx
from candela.streaming import queries as P
from candela.streaming.replay import chunks, replay
from candela.streaming.sources import file_source

SF = "/root/testdata/sf0.001"
BOUNDED = {"availableNow": True}


def _envelope(spark):
    return fx.envelope_from_ticks(ticks(spark, SF))


def test_restart_no_loss_no_repeat(spark):
    env = _envelope(spark)
    out = scratch_path(spark, "silver")
    replay(spark, env, lambda s, ck: P.start_silver_sink(P.clean_ticks(s), out, ck, trigger=BOUNDED))
    got = spark.read.parquet(out)
    from candela.operators import ingest, quality

    want = quality.quality_filter(ingest.parse_ticks(ingest.decode_envelope(env)))
    assert got.count() == want.count()
    assert got.groupBy("symbol", "event_time", "source").count().filter("count > 1").count() == 0


def test_update_mode_equals_batch(spark):
    from candela.operators import ingest, quality
    from candela.operators.window_stats import window_stats

    env = _envelope(spark)
    log = scratch_path(spark, "stats")
    replay(spark, env, lambda s, ck: P.start_window_stats(P.clean_ticks(s), ck, log, trigger=BOUNDED))
    got = canon(P.latest_window_stats(spark, log))
    batch = canon(window_stats(quality.quality_filter(ingest.parse_ticks(ingest.decode_envelope(env)))))
    assert sorted(got.collect()) == sorted(batch.collect())


def test_reversed_replay_drops_late_windows(spark):
    env = _envelope(spark)
    fwd, rev = scratch_path(spark, "fwd"), scratch_path(spark, "rev")
    replay(spark, env, lambda s, ck: P.start_window_stats(P.clean_ticks(s), ck, fwd, trigger=BOUNDED))
    replay(spark, env, lambda s, ck: P.start_window_stats(P.clean_ticks(s), ck, rev, trigger=BOUNDED), reverse=True)
    n_fwd = P.latest_window_stats(spark, fwd).count()
    n_rev = P.latest_window_stats(spark, rev).count()
    # only the first delivered (latest) chunk survives: later chunks are behind the watermark
    last_chunk = chunks(env)[-1]
    assert 0 < n_rev < n_fwd
    assert P.latest_window_stats(spark, rev).filter(F.col("window_start") < "2024-01-24").count() == 0
    assert last_chunk.count() > 0


def test_silver_stateless_sink_keeps_late_rows(spark):
    env = _envelope(spark)
    out = scratch_path(spark, "silver")
    replay(spark, env, lambda s, ck: P.start_silver_sink(P.clean_ticks(s), out, ck, trigger=BOUNDED), reverse=True)
    from candela.operators import ingest, quality

    want = quality.quality_filter(ingest.parse_ticks(ingest.decode_envelope(env))).count()
    assert spark.read.parquet(out).count() == want


def test_dual_sinks_from_one_stream(spark):
    landing = scratch_path(spark, "landing")
    _envelope(spark).write.parquet(landing)
    clean = P.clean_ticks(file_source(spark, landing))
    silver, stats, ck = scratch_path(spark, "silver"), scratch_path(spark, "stats"), scratch_path(spark, "ck")
    q1 = P.start_silver_sink(clean, silver, ck + "/silver", trigger=BOUNDED)
    q2 = P.start_stats_messages(clean, ck + "/stats", path=stats, trigger=BOUNDED)
    q1.awaitTermination()
    q2.awaitTermination()
    assert spark.read.parquet(silver).count() > 0
    msgs = spark.read.parquet(stats)
    assert msgs.filter(F.col("key").isNull() | F.col("value").isNull()).count() == 0
    assert msgs.select(F.from_json("value", "tick_count bigint").alias("v")).filter("v.tick_count >= 1").count() == msgs.count()


def test_await_all_fails_when_a_sibling_dies(spark):
    landing = scratch_path(spark, "landing")
    _envelope(spark).write.parquet(landing)
    clean = P.clean_ticks(file_source(spark, landing))
    ck = scratch_path(spark, "ck")

    def boom(batch, batch_id):
        raise ValueError("sink down")

    bad = clean.writeStream.option("checkpointLocation", ck + "/bad").foreachBatch(boom).start()
    good = P.start_silver_sink(clean, scratch_path(spark, "silver"), ck + "/good", trigger={"processingTime": "1 second"})
    with pytest.raises(RuntimeError, match="failed"):
        P.await_all(spark, [bad, good])
    time.sleep(0.5)
    assert not good.isActive


def test_stream_silver_dedup_independent_of_batches(spark):
    from candela.operators import quality

    env = fx.envelope_from_ticks(fx.redelivered_ticks(ticks(spark, SF)))
    out = scratch_path(spark, "silver")
    replay(spark, env, lambda s, ck: P.start_silver_dedup(s, out, ck, trigger=BOUNDED))
    got = spark.read.parquet(out)
    assert got.groupBy("symbol", "event_time", "source").count().filter("count > 1").count() == 0
    from candela.plans.catalog import silver

    assert got.count() == silver(spark, SF).count()
    assert quality.dedup(got).count() == got.count()


def test_dedup_within_watermark_variant(spark):
    env = fx.envelope_from_ticks(fx.redelivered_ticks(ticks(spark, SF)))
    out = scratch_path(spark, "silver")
    replay(spark, env, lambda s, ck: P.start_silver_dedup_within_watermark(s, out, ck, trigger=BOUNDED))
    got = spark.read.parquet(out)
    # copies arrive one minute after their original, inside the 5-minute delay: all dropped
    assert got.groupBy("symbol", "event_time", "source").count().filter("count > 1").count() == 0


def test_stream_job_cli_two_sinks(spark):
    from candela.plans import jobs

    landing = scratch_path(spark, "landing")
    _envelope(spark).write.parquet(landing)
    silver, stats, ck = scratch_path(spark, "silver"), scratch_path(spark, "stats"), scratch_path(spark, "ck")
    args = jobs.parse_args(
        ["stream", "--source-path", landing, "--output-path", silver, "--checkpoint-path", ck,
         "--stats-path", stats, "--available-now"]
    )
    jobs.JOBS["stream"](spark, args)
    assert spark.read.parquet(silver).count() > 0
    assert spark.read.parquet(stats).count() > 0


def test_rocksdb_state_store_gives_same_result(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    env = _envelope(spark)
    log = scratch_path(spark, "stats")
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        replay(spark, env, lambda s, ck: P.start_window_stats(P.clean_ticks(s), ck, log, trigger=BOUNDED))
    finally:
        if old:
            spark.conf.set(key, old)
        else:
            spark.conf.unset(key)
    from candela.operators import ingest, quality
    from candela.operators.window_stats import window_stats

    batch = canon(window_stats(quality.quality_filter(ingest.parse_ticks(ingest.decode_envelope(env)))))
    assert sorted(canon(P.latest_window_stats(spark, log)).collect()) == sorted(batch.collect())


def test_stream_dedup_date_partitioned_prunes_and_matches(spark):
    import datetime as dt

    env = fx.envelope_from_ticks(fx.redelivered_ticks(ticks(spark, SF)))
    a, b = scratch_path(spark, "silver_sym"), scratch_path(spark, "silver_date")
    replay(spark, env, lambda s, ck: P.start_silver_dedup(s, a, ck, trigger=BOUNDED, partition_by=("symbol",)))
    replay(
        spark,
        env,
        lambda s, ck: P.start_silver_dedup(s, b, ck, trigger=BOUNDED, partition_by=("symbol", "event_date")),
    )
    cols = ["symbol", "event_time", "source", "offset"]
    assert sorted(spark.read.parquet(a).select(*cols).collect()) == sorted(spark.read.parquet(b).select(*cols).collect())
    schema = spark.read.parquet(b).schema
    keys = P.stored_keys(
        spark, b, schema, dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4), partition_by=("symbol", "event_date")
    )
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_update_log_reader_prunes_old_batches(spark):
    env = _envelope(spark)
    log = scratch_path(spark, "stats")
    replay(spark, env, lambda s, ck: P.start_window_stats(P.clean_ticks(s), ck, log, trigger=BOUNDED))
    recent = P.latest_window_stats(spark, log, min_batch_id=6)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
    # batches 6-7 hold the last chunk (days 24+) only
    assert recent.filter(F.col("window_start") < "2024-01-24").count() == 0
    assert 0 < recent.count() < P.latest_window_stats(spark, log).count()


def test_compaction_keeps_the_current_values(spark):
    log = scratch_path(spark, "stats_compact")
    replay(spark, _envelope(spark), lambda s, ck: P.start_window_stats(P.clean_ticks(s), ck, log, trigger=BOUNDED))
    before = sorted(map(str, P.latest_window_stats(spark, log).collect()))
    batches = sorted(int(r.batch_id) for r in spark.read.parquet(log).select("batch_id").distinct().collect())
    P.compact_window_stats(spark, log, batches[-2])
    left = sorted(int(r.batch_id) for r in spark.read.parquet(log).select("batch_id").distinct().collect())
    assert left == batches[-2:]
    assert sorted(map(str, P.latest_window_stats(spark, log).collect())) == before


def test_dedup_lookup_reads_only_the_days_of_the_batch(spark):
    import datetime as dt

    path = scratch_path(spark, "silver_days")
    rows = ticks(spark, SF).select("symbol", "event_time", "source").withColumn("event_date", F.to_date("event_time"))
    rows.write.partitionBy("symbol", "event_date").parquet(path)
    days = [dt.date(2024, 1, 2), dt.date(2024, 1, 20)]
    keys = P.stored_keys(
        spark, path, rows.schema, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 21), partition_by=("symbol", "event_date"), days=days
    )
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.d for r in keys.select(F.to_date("event_time").alias("d")).distinct().collect()} <= set(days)


def test_message_log_compaction(spark):
    """Folding the message log keeps the newest message a window; the last batch can't be folded."""
    log = scratch_path(spark, "messages")
    replay(spark, _envelope(spark), lambda s, ck: P.start_stats_messages(P.clean_ticks(s), ck, path=log, trigger=BOUNDED))

    def current():
        rows = spark.read.parquet(log).withColumn("window", F.get_json_object("value", "$.window_start"))
        return sorted(map(str, P.latest_by_key(rows, ["key", "window"], ["value"]).collect()))

    before = current()
    batches = sorted(int(r.batch_id) for r in spark.read.parquet(log).select("batch_id").distinct().collect())
    with pytest.raises(ValueError):
        P.compact_stats_messages(spark, log, batches[-1])
    assert P.compact_stats_messages(spark, log) == batches[-2] and current() == before
    left = sorted(int(r.batch_id) for r in spark.read.parquet(log).select("batch_id").distinct().collect())
    assert left == batches[-2:] and P.compact_stats_messages(spark, log) is None


def test_silver_dedup_writes_few_files(spark, tmp_path):
    """A micro-batch writes a file a folder, however many tasks hold its rows."""
    rows = spark.range(400).selectExpr(
        "if(id % 2 = 0, 'A', 'B') AS symbol", "10.5D AS price", "id AS volume", "'src' AS source", "id AS offset",
        "timestamp'2024-01-03 00:00:00' + make_interval(0, 0, 0, int(id % 3), 0, 0, id) AS event_time",
        "0 AS partition", "timestamp'2024-01-05 00:00:00' AS kafka_timestamp",
    )
    out = str(tmp_path / "silver")
    replay(spark, fx.envelope_from_ticks(rows), lambda s, ck: P.start_silver_dedup(s, out, ck, trigger={"availableNow": True}), bounds=())
    files = list((tmp_path / "silver").glob("symbol=*/event_date=*/*.parquet"))
    assert len(files) == 6
    clean = rows.filter("offset % 31 <> 0 AND offset % 37 <> 0 AND offset % 41 <> 0").count()
    assert spark.read.parquet(out).count() == clean
