"""Plan shape: shuffles, pruning, pushdown, no Python in the hot path."""

from pyspark.sql import functions as F

from candela.operators import gold as G
from candela.operators import marts
from candela.plans.catalog import gold, ticks
from candela.schema import GOLD
from candela.session import scratch_path
from candela.sources.lake import read_partitioned, scan, write_partitioned

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_has_two_exchanges_and_one_window_sort(spark):
    p = _plan(gold(spark, SF))
    # tick level by (symbol, day, source), its few rows by (symbol, day), daily rows by symbol
    assert p.count("Exchange hashpartitioning") == 3
    # the day's mean beside its states, the lag, and every trailing frame in one
    assert p.count("Window [") == 3


def test_tick_level_gold_is_hashed(spark):
    from candela.plans.catalog import daily

    lines = _plan(daily(spark, SF)).split("\n")
    tick_level = [x for x in lines if "Aggregate" in x and "var_pop" in x]
    assert tick_level and all("HashAggregate" in x and "SortAggregate" not in x for x in tick_level)


def test_gold_scan_is_pruned(spark):
    p = _plan(gold(spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in p  # event_id is not read


def test_no_python_udfs(spark):
    for df in (gold(spark, SF), marts.top_movers_latest(gold(spark, SF))):
        p = _plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_partition_pruning_on_symbol(spark):
    path = scratch_path(spark, "gold_pruning")
    write_partitioned(gold(spark, SF), path)
    g = read_partitioned(spark, path, GOLD)
    p = _plan(marts.price_series(g, ["click"]))
    assert "PartitionFilters: [isnotnull(symbol" in p and "click" in p


def test_filter_pushdown_to_parquet(spark):
    path = scratch_path(spark, "ticks_pushdown")
    ticks(spark, SF).write.parquet(path)
    df = scan(spark, path).filter(F.col("price") > 100).select("symbol", "price")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(price), GreaterThan(price,100.0)]" in p
    assert "ReadSchema: struct<symbol:string,price:double>" in p


def test_scalar_subquery_for_latest_date(spark):
    p = _plan(marts.on_latest_date(gold(spark, SF)))
    assert "Subquery" in p


def test_dedup_aggregates_map_side(spark):
    from candela.operators.quality import dedup

    p = _plan(dedup(ticks(spark, SF)))
    assert "partial_min_by" in p


def test_windows_share_sort_in_indicators(spark):
    from candela.operators import indicators as I

    d = G.daily_ohlcv(ticks(spark, SF))
    p = _plan(I.with_sma(G.with_rsi(G.with_prev_close(d)), 5))
    assert p.count("Exchange hashpartitioning") == 3  # two aggregates + one for all windows
    assert p.count("Window [") == 3  # a day's mean beside its states; lag; then every trailing frame in one node


def test_serving_upsert_reads_only_touched_dates(spark):
    """The source's date span is a static partition filter on the target scan."""
    from candela.operators import serving

    g = gold(spark, SF, "user")
    ok, _ = serving.serving_cast(g)
    path = scratch_path(spark, "serving_dpp")
    ok.withColumn("loaded_at", F.current_timestamp()).write.partitionBy("trade_date").parquet(path)
    src = ok.filter(F.col("trade_date") >= "2024-01-29")
    target = spark.read.parquet(path)
    current = serving.touched_partitions(target, src)
    p = _plan(current)
    assert "PartitionFilters: [isnotnull(trade_date" in p and "(trade_date#" in p and ">= 2024-01-29" in p
    assert current.select("trade_date").distinct().count() == 2


def test_tick_level_aggregates_combine_map_side(spark):
    """Hot keys: every tick-level aggregate has a partial (map-side) stage, so a
    symbol-day or window holding a third of all ticks reaches the shuffle as one
    row per map task."""
    from candela.operators.window_stats import window_stats

    t = ticks(spark, SF)
    assert "partial_min_by" in _plan(G.daily_ohlcv(t))
    assert "partial_avg" in _plan(window_stats(t))


def test_partitioned_write_uses_rebalance(spark):
    path = scratch_path(spark, "rebalance")
    df = gold(spark, SF)
    write_partitioned(df, path)
    plan = df.hint("rebalance", "symbol")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_rank_over_ranges_with_ties_and_other_columns(spark):
    """At least eight ranges, columns outside the order, many rows of equal price."""
    from pyspark.sql import Window

    from candela.operators import ranking

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        df = ticks(spark, SF).select("offset", F.floor(F.col("price") / 50).alias("price"), "symbol", "event_time", "source")
        order = [F.col("price").desc_nulls_first(), F.col("offset")]
        ranked = ranking.with_position(df, order)
        want = df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
        assert sorted(map(str, ranked.collect())) == sorted(map(str, want.collect()))
        big = spark.range(1_200_000).selectExpr("id", "id % 1000 AS k", "cast(id AS string) AS a", "id * 2 AS b")
        ranks = ranking.with_position(big, [F.col("k"), F.col("id")])
        # rows of key k stand after those of smaller keys: 1200 each, in order of id
        wrong = ranks.filter(F.col("rank") != F.col("k") * 1200 + F.expr("id div 1000") + 1)
        assert wrong.count() == 0 and ranks.count() == 1_200_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_untouched_symbols_never_reach_a_window(spark):
    """Gold is cut to the touched symbols by an inner join below every window."""
    path = scratch_path(spark, "gold_prev")
    gold(spark, SF, "user").write.parquet(path)
    prev = spark.read.schema(GOLD).parquet(path)
    all_ticks = ticks(spark, SF, "user")
    new = all_ticks.filter("event_time >= '2024-01-29' and symbol in ('U1', 'U2')")
    recomputed, start = G.gold_changes(prev, all_ticks, new)
    assert {r.symbol for r in recomputed.select("symbol").distinct().collect()} == {r.symbol for r in start.collect()} <= {"U1", "U2"}
    plan = recomputed._jdf.queryExecution().optimizedPlan().toString().split("\n")
    first_window = min(i for i, x in enumerate(plan) if "Window [" in x)
    assert not any("LeftOuter" in x for x in plan[first_window:])
