"""Gold invariants: deterministic OHLC, bounds, incremental = full."""

from pyspark.sql import functions as F

from candela.operators import gold as G
from candela.plans.catalog import ticks

SF = "/root/testdata/sf0.001"


def _rows(df):
    """Rows with doubles rounded (sums in another order differ in the last bit)."""
    from candela.plans.catalog import canon

    return sorted(tuple(r) for r in canon(df).collect())


def test_open_close_shuffle_invariant(spark):
    t = ticks(spark, SF)
    a = G.daily_ohlcv(t)
    b = G.daily_ohlcv(t.repartition(7, F.rand(seed=3)).sortWithinPartitions(F.rand(seed=5)))
    assert _rows(a) == _rows(b)


def test_ohlc_bounds(spark):
    d = G.daily_ohlcv(ticks(spark, SF, "user"))
    bad = d.filter(
        (F.col("low_price") > F.col("open_price"))
        | (F.col("open_price") > F.col("high_price"))
        | (F.col("low_price") > F.col("close_price"))
        | (F.col("close_price") > F.col("high_price"))
    )
    assert bad.count() == 0


def test_open_is_first_tick(spark):
    import datetime as dt

    rows = [
        ("A", dt.datetime(2024, 1, 1, 10, 0), "s1", 3.0),
        ("A", dt.datetime(2024, 1, 1, 9, 0), "s2", 5.0),
        ("A", dt.datetime(2024, 1, 1, 9, 0), "s1", 4.0),  # same time: source breaks the tie
        ("A", dt.datetime(2024, 1, 1, 11, 0), "s1", 6.0),
    ]
    t = spark.createDataFrame(rows, "symbol string, event_time timestamp, source string, price double").withColumn(
        "volume", F.lit(1).cast("bigint")
    )
    r = G.daily_ohlcv(t).first()
    assert (r.open_price, r.close_price, r.high_price, r.low_price, r.total_volume) == (4.0, 6.0, 6.0, 3.0, 4)


def test_single_tick_day_has_null_volatility(spark):
    import datetime as dt

    t = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 1), "s", 1.0, 1)],
        "symbol string, event_time timestamp, source string, price double, volume bigint",
    )
    assert G.daily_ohlcv(t).first().volatility is None


def test_prev_close_is_previous_row_not_previous_day(closes):
    import datetime as dt

    df = closes([10, 20])
    df = df.withColumn("trade_date", F.when(F.col("close_price") == 20, F.lit(dt.date(2024, 1, 9))).otherwise(F.col("trade_date")))
    r = G.with_prev_close(df).orderBy("trade_date").collect()
    assert r[1].prev_close == 10.0


def test_incremental_equals_full(spark):
    t = ticks(spark, SF, "user")
    cut = F.lit("2024-01-20").cast("timestamp")
    is_new = (F.col("event_time") >= cut) | ((F.col("offset") % 5) == 0)
    prev = G.gold_daily(t.filter(~is_new))
    inc = G.gold_incremental(prev, t, t.filter(is_new))
    full = G.gold_daily(t)
    assert _rows(inc) == _rows(full)


def test_incremental_new_symbol_and_late_tick(spark):
    rows_old = [
        ("A", dt_(1, 10), "s", 10.0, 1), ("A", dt_(2, 10), "s", 11.0, 1), ("A", dt_(3, 10), "s", 9.0, 1),
    ]
    rows_new = [
        ("A", dt_(2, 23), "s", 15.0, 1),  # late tick: changes A's day-2 close and every later RSI
        ("A", dt_(4, 10), "s", 12.0, 1),
        ("B", dt_(4, 9), "s", 5.0, 2),  # a symbol never seen before
        ("B", dt_(5, 9), "s", 6.0, 2),
    ]
    schema = "symbol string, event_time timestamp, source string, price double, volume bigint"
    old = spark.createDataFrame(rows_old, schema)
    new = spark.createDataFrame(rows_new, schema)
    inc = G.gold_incremental(G.gold_daily(old), old.unionByName(new), new)
    assert _rows(inc) == _rows(G.gold_daily(old.unionByName(new)))


def dt_(day, hour):
    import datetime as dt

    return dt.datetime(2024, 1, day, hour)


def test_hashed_open_close_equals_struct_order_with_ties(spark):
    import datetime as dt

    rows = [
        ("A", dt.datetime(2024, 1, 1, 10, 0), "s1", 3.0, 1),
        ("A", dt.datetime(2024, 1, 1, 9, 0), "s2", 5.0, 1),
        ("A", dt.datetime(2024, 1, 1, 9, 0), "s1", 4.0, 1),
        ("A", dt.datetime(2024, 1, 1, 11, 0), "s0", 6.0, 1),
        ("A", dt.datetime(2024, 1, 1, 11, 0), "s9", 7.0, 1),
        ("B", dt.datetime(2024, 1, 2, 0, 0), None, 1.0, 1),
        ("B", dt.datetime(2024, 1, 2, 0, 0), "a", 2.0, 1),
        ("C", dt.datetime(2024, 1, 2, 0, 0), "a", 0.1, 1),
        ("C", dt.datetime(2024, 1, 2, 0, 0), "b", 0.1, 1),
        ("C", dt.datetime(2024, 1, 2, 0, 1), "b", 0.1, 1),
        ("D", dt.datetime(2024, 1, 2, 0, 0), "a", None, 1),
    ]
    t = spark.createDataFrame(rows, "symbol string, event_time timestamp, source string, price double, volume bigint")
    r = {x.symbol: x for x in G.daily_ohlcv(t).collect()}
    assert (r["A"].open_price, r["A"].close_price) == (4.0, 7.0)
    assert (r["B"].open_price, r["B"].close_price) == (1.0, 2.0)  # NULL source sorts first
    assert r["C"].volatility == 0.0 and r["D"].volatility is None and r["D"].avg_price is None


def test_merged_days_equal_a_plain_aggregate(spark):
    t = G.with_trade_date(ticks(spark, SF))
    order = F.struct("event_time", "source")
    plain = t.groupBy("symbol", "trade_date").agg(
        F.min_by("price", order).alias("open_price"), F.max("price").alias("high_price"), F.min("price").alias("low_price"),
        F.max_by("price", order).alias("close_price"), F.sum("volume").alias("total_volume"), F.avg("price").alias("avg_price"),
        F.stddev_samp("price").alias("volatility"),
    )
    assert _rows(G.daily_ohlcv(ticks(spark, SF))) == _rows(plain)
