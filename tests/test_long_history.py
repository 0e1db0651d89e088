"""Windows over blocks with a halo equal the plain windows; a long history is spread over tasks."""

import pytest
from pyspark.sql import functions as F

from candela.operators import gold as G
from candela.operators import indicators as I
from candela.operators import long_history as L
from candela.schema import GOLD_COLS


@pytest.fixture(scope="module")
def daily(spark):
    """One symbol with a third of all rows, many short ones, one with a single row, and gaps between days."""
    hot = spark.range(3000).select(F.lit("HOT").alias("symbol"), F.expr("date_add(DATE'1990-01-01', cast(id * 2 as int))").alias("trade_date"), "id")
    rest = spark.range(6000).select(
        F.concat(F.lit("S"), F.floor(F.col("id") / 20)).alias("symbol"),
        F.expr("date_add(DATE'2000-01-01', cast(id % 20 as int))").alias("trade_date"), "id",
    )
    one = spark.range(1).select(F.lit("ONE").alias("symbol"), F.expr("DATE'2001-01-01'").alias("trade_date"), "id")
    price = (F.xxhash64("symbol", "id") % 1000 + 1500) / 100
    rows = hot.unionByName(rest).unionByName(one).withColumn("close_price", price).drop("id")
    for c in ("open_price", "high_price", "low_price", "avg_price", "volatility"):
        rows = rows.withColumn(c, F.col("close_price"))
    return rows.withColumn("total_volume", F.lit(1).cast("bigint")).checkpoint()


@pytest.mark.parametrize("block_rows", [14, 15, 100, 4096])
def test_gold_equals_the_plain_windows(daily, block_rows):
    got = L.gold_long_history(daily, block_rows=block_rows)
    assert got.columns == GOLD_COLS
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, G.gold_from_daily(daily).collect()))


@pytest.mark.parametrize("name", ["sma", "rsi_strict", "rolling"])
def test_indicators_equal_the_plain_windows(daily, name):
    compute, halo = {
        "sma": (lambda d: I.with_sma(d, 5), 4),
        "rsi_strict": (lambda d: I.with_rsi_strict(d, 14), 14),
        "rolling": (lambda d: I.with_volatility_rolling(d, 14, out="rolling"), 13),
    }[name]
    got = L.over_blocks(daily, compute, halo, 64).select(*compute(daily).columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, compute(daily).collect()))


def test_a_hot_symbol_is_spread(daily):
    """The window's exchange is by (symbol, block), and no block holds more than its rows and a halo."""
    seen = {}

    def compute(rows):
        seen["rows"] = rows
        return G.with_prev_close(rows)

    L.over_blocks(daily, compute, 14, 100).count()
    sizes = seen["rows"].groupBy("symbol").count().agg(F.max("count")).first()[0]
    assert sizes <= 114
    assert seen["rows"].filter("symbol.name = 'HOT'").select("symbol.block").distinct().count() >= 30
    plan = G.with_prev_close(seen["rows"])._jdf.queryExecution().executedPlan().toString()
    assert "Window [lag(close_price" in plan and "hashpartitioning(symbol" in plan


def test_bad_sizes(daily):
    with pytest.raises(ValueError):
        L.over_blocks(daily, G.with_prev_close, 14, 13)
