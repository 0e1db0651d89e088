"""The reference's scalar indicator cases, restated as DataFrame tests."""

import math

import pytest
from pyspark.sql import functions as F

from candela.operators import gold as G
from candela.operators import indicators as I


def last(df, col):
    return df.orderBy(F.col("trade_date").desc()).first()[col]


# ---- simple moving average
def test_sma_basic(closes):
    assert last(I.with_sma(closes([10, 20, 30]), 3), "sma") == pytest.approx(20)


def test_sma_too_few_rows(closes):
    assert last(I.with_sma(closes([10, 20]), 5), "sma") is None


def test_sma_window_zero(closes):
    assert last(I.with_sma(closes([10, 20, 30]), 0), "sma") is None


def test_sma_uses_only_last_n(closes):
    assert last(I.with_sma(closes([100, 100, 10, 20, 30]), 3), "sma") == pytest.approx(20)


# ---- population volatility
def test_volatility_constant_is_zero(closes):
    assert I.volatility_pop(closes([50, 50, 50, 50])).first()["volatility"] == 0


def test_volatility_single_is_null(closes):
    assert I.volatility_pop(closes([50])).first()["volatility"] is None


def test_volatility_spread_ordering(closes):
    low = I.volatility_pop(closes([100, 101, 99, 100])).first()["volatility"]
    high = I.volatility_pop(closes([100, 150, 50, 100])).first()["volatility"]
    assert low == pytest.approx(0.7071, abs=1e-4)
    assert high == pytest.approx(35.3553, abs=1e-4)
    assert low < high


def test_volatility_rolling_matches_population(closes):
    df = I.with_volatility_rolling(closes([100, 150, 50, 100]), 4)
    assert last(df, "volatility") == pytest.approx(35.3553, abs=1e-4)


# ---- percent change
@pytest.mark.parametrize("prev,cur,want", [(100, 110, 10.0), (100, 90, -10.0), (0, 100, None)])
def test_pct_change(closes, prev, cur, want):
    df = G.with_pct_change(G.with_prev_close(closes([prev, cur])))
    got = last(df, "pct_change")
    assert got == (pytest.approx(want) if want is not None else None)


def test_pct_change_first_row_null(closes):
    df = G.with_pct_change(G.with_prev_close(closes([100, 110])))
    assert df.orderBy("trade_date").first()["pct_change"] is None


# ---- RSI
def test_rsi_too_few_prices(closes):
    df = closes([1, 2, 3])
    assert last(I.with_rsi_strict(df, 14), "rsi") is None
    assert last(G.with_rsi(df), "rsi_14") == 100.0  # pipeline form: partial frame, no loss


def test_rsi_all_gains(closes):
    df = closes(range(1, 17))
    assert last(I.with_rsi_strict(df, 14), "rsi") == 100.0
    assert last(G.with_rsi(df), "rsi_14") == 100.0


MIXED = [100, 102, 101, 105, 103, 107, 110, 108, 112, 115, 113, 117, 120, 118, 122]


def test_rsi_mixed_in_range(closes):
    r = last(I.with_rsi_strict(closes(MIXED), 14), "rsi")
    assert 0 <= r <= 100
    assert r == pytest.approx(77.5)  # gains 31, losses 9


def test_rsi_period_argument(closes):
    df = I.with_rsi_strict(closes(MIXED), 7)
    assert df.filter(F.col("rsi").isNotNull()).count() == len(MIXED) - 7


def test_pipeline_rsi_equals_strict_from_row_14(spark):
    """The fake zero delta of early rows does not change the ratio: both RSI forms
    agree from the 15th row on, and the pipeline form is in [0, 100] everywhere."""
    from candela.plans.catalog import daily

    d = daily(spark, "/root/testdata/sf0.001")
    both = I.with_rsi_strict(G.with_rsi(d), 14)
    rows = both.select("rsi_14", "rsi").collect()
    assert all(0 <= r.rsi_14 <= 100 for r in rows)
    strict = [r for r in rows if r.rsi is not None]
    assert strict and all(math.isclose(r.rsi, r.rsi_14, rel_tol=1e-9, abs_tol=1e-9) for r in strict)


def test_rsi_status_bands(spark):
    from candela.functions.indicators import rsi_status

    df = spark.createDataFrame([(75.0,), (70.0,), (50.0,), (30.0,), (10.0,), (None,)], "r double")
    got = [r.s for r in df.select(rsi_status("r").alias("s")).collect()]
    assert got == ["Overbought", "Overbought", "Neutral", "Oversold", "Oversold", "Neutral"]


def test_volatility_7d_is_calendar_range(spark):
    import datetime as dt

    rows = [("A", dt.date(2024, 1, d), float(v)) for d, v in [(1, 1), (2, 3), (9, 5), (10, 7)]]
    g = spark.createDataFrame(rows, "symbol string, trade_date date, volatility double")
    got = {r.trade_date.day: r.volatility_7d for r in I.with_volatility_7d(g).collect()}
    assert got == {1: 1.0, 2: 2.0, 9: 5.0, 10: 6.0}  # day 9 does not see day 2 (7 days back)


@pytest.mark.parametrize("fn", [lambda d: I.with_rsi_strict(d, 0), lambda d: G.with_rsi(d, period=0),
                                lambda d: I.with_volatility_rolling(d, 0), lambda d: I.with_volatility_7d(d.withColumn("volatility", F.lit(1.0)), 0)])
def test_non_positive_windows_are_rejected(closes, fn):
    with pytest.raises(ValueError):
        fn(closes([1, 2, 3]))
