"""Tumbling-window price statistics per symbol (batch and streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.schema import WINDOW_STATS_COLS

# Fixed values that must equal the reference: window length and watermark delay.
WINDOW = "1 minute"
WATERMARK = "5 minutes"


def window_stats(ticks: DataFrame, duration: str = WINDOW) -> DataFrame:
    """avg/max/min/sample-stddev/count of price per (window, symbol).

    Works unchanged on a streaming DataFrame carrying a watermark.
    """
    return (
        ticks.groupBy(F.window("event_time", duration), "symbol")
        .agg(
            F.avg("price").alias("avg_price"),
            F.max("price").alias("max_price"),
            F.min("price").alias("min_price"),
            F.stddev_samp("price").alias("volatility"),
            F.count("price").alias("tick_count"),
        )
        .select(
            "symbol",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *WINDOW_STATS_COLS[3:],
        )
    )


def stats_json(stats: DataFrame) -> DataFrame:
    """Keyed message form: key = symbol, value = JSON of all stats columns."""
    return stats.select(
        F.col("symbol").alias("key"), F.to_json(F.struct(*WINDOW_STATS_COLS)).alias("value")
    )
