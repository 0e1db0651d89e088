"""Indicator operators over daily rows (one row per symbol and trade_date).

These restate the scalar indicator specification (moving average, population
volatility, strict RSI) as window expressions: every frame is keyed by
(symbol ORDER BY trade_date), the same ordering gold uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.functions import indicators as ind


def with_sma(df: DataFrame, n: int, price_col: str = "close_price", out: str = "sma") -> DataFrame:
    """Mean of the last n prices; NULL while fewer than n rows exist, or n <= 0."""
    if n <= 0:
        return df.withColumn(out, F.lit(None).cast("double"))
    frame = ind.trailing_rows(n)
    return df.withColumn(out, F.when(F.count(price_col).over(frame) == n, F.avg(price_col).over(frame)))


def with_rsi_strict(
    df: DataFrame, period: int = ind.RSI_PERIOD, price_col: str = "close_price", out: str = "rsi"
) -> DataFrame:
    """RSI over exactly ``period`` deltas; NULL until period + 1 prices exist."""
    delta = F.col(price_col) - F.lag(price_col, 1).over(ind.by_symbol())
    frame = ind.trailing_rows(period)
    g = F.when(F.col("_delta").isNotNull(), ind.gain("_delta"))
    lo = F.when(F.col("_delta").isNotNull(), ind.loss("_delta"))
    return (
        df.withColumn("_delta", delta)
        .withColumn("_g", g)
        .withColumn("_l", lo)
        .withColumn(
            out,
            F.when(
                F.count("_delta").over(frame) == period,
                ind.rsi_from_averages(F.avg("_g").over(frame), F.avg("_l").over(frame)),
            ),
        )
        .drop("_delta", "_g", "_l")
    )


def volatility_pop(daily: DataFrame, price_col: str = "close_price") -> DataFrame:
    """Population volatility of each symbol's closes; NULL below two closes."""
    return daily.groupBy("symbol").agg(
        F.count(price_col).alias("n"), ind.stddev_pop_min2(price_col).alias("volatility")
    )


def with_volatility_rolling(
    df: DataFrame, n: int = ind.RSI_PERIOD, price_col: str = "close_price", out: str = "volatility"
) -> DataFrame:
    """Population volatility of the last n closes (partial frames), NULL below two."""
    frame = ind.trailing_rows(n)
    return df.withColumn(
        out, F.when(F.count(price_col).over(frame) >= 2, F.stddev_pop(price_col).over(frame))
    )


def with_volatility_7d(gold: DataFrame, days: int = 7, out: str = "volatility_7d") -> DataFrame:
    """Average daily volatility over the calendar range [date - 6 days, date] per symbol."""
    return gold.withColumn(out, F.avg("volatility").over(ind.trailing_days(days)))


def volatility_7d_market(gold: DataFrame, days: int = 7) -> DataFrame:
    """Market-wide 7-day average volatility per date.

    Pre-aggregated to one row per date (sum and count) before the calendar
    window, so the un-partitioned window sees one row per day, not per symbol.
    """
    per_day = gold.groupBy("trade_date").agg(
        F.sum("volatility").alias("_s"), F.count("volatility").alias("_n")
    )
    frame = (
        Window.orderBy(F.unix_date("trade_date")).rangeBetween(-(days - 1), Window.currentRow)
    )
    return per_day.select(
        "trade_date",
        (F.sum("_s").over(frame) / F.sum("_n").over(frame)).alias("volatility_7d"),
    )
