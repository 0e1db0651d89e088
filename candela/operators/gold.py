"""Gold layer: daily OHLCV per symbol, day-over-day change and RSI.

Plan shape: tick scan (pruned to symbol/price/volume/event_time + tie-break)
→ partial aggregate → Exchange(symbol, trade_date) → final aggregate →
Exchange(symbol) → one sort → one Window node for lag and the trailing frames.
Tick-level work is spread over (symbol, day), so a symbol holding a third of all
ticks still fans out over its days; windows only ever see daily rows, whose
count per symbol is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.functions import indicators as ind
from candela.schema import GOLD_COLS
from candela.session import shared_dir

# Within a (symbol, day) the silver contract makes (event_time, source) unique,
# so the first/last tick is well defined without lineage columns.
DEFAULT_TICK_ORDER = ("event_time", "source")

# Mergeable state of a (symbol, trade_date): prices at the first and last tick by
# (time, second ordering column), extremes, and the sums behind mean and deviation.
STATE_COLS = [
    "symbol", "trade_date", "first_time", "first_by", "open_price", "last_time", "last_by", "close_price",
    "high_price", "low_price", "total_volume", "n", "price_sum", "m2",
]


def with_trade_date(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("trade_date", F.to_date("event_time"))


def daily_ohlcv(ticks: DataFrame, order_by: Sequence[str] = DEFAULT_TICK_ORDER) -> DataFrame:
    """One row per (symbol, trade_date).

    open/close are the prices of the first/last tick by ``order_by`` (the
    reference's unordered first/last is nondeterministic after a shuffle).
    volatility is the sample standard deviation (NULL for a single tick).

    Ticks are only ever hashed: a primitive ordering column keeps every
    aggregation buffer fixed-width. A second ordering column (``source``)
    becomes part of the tick-level key, inside which the first column alone
    decides, and the few rows per (symbol, day) are then merged.
    """
    if len(order_by) > 2:
        raise ValueError("order ticks by one column, or by time and a second key column")
    if len(order_by) == 1:
        return with_trade_date(ticks).groupBy("symbol", "trade_date").agg(
            F.min_by("price", order_by[0]).alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", order_by[0]).alias("close_price"),
            F.sum("volume").alias("total_volume"),
            F.avg("price").alias("avg_price"),
            F.stddev_samp("price").alias("volatility"),
        )
    return ohlcv(merge_states(partial_days(ticks, *order_by)))


def partial_days(ticks: DataFrame, time: str, second: str) -> DataFrame:
    """Mergeable state per (symbol, trade_date, second ordering column); columns as in ``STATE_COLS``."""
    by = F.col(second)
    states = with_trade_date(ticks).groupBy("symbol", "trade_date", by.alias("first_by")).agg(
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        F.min_by("price", time).alias("open_price"),
        F.max_by("price", time).alias("close_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.sum("volume").alias("total_volume"),
        F.count("price").alias("n"),
        F.sum("price").alias("price_sum"),
        (F.var_pop("price") * F.count("price")).alias("m2"),
    )
    return states.withColumn("last_by", F.col("first_by")).select(*STATE_COLS)


def merge_states(states: DataFrame) -> DataFrame:
    """Any number of states a (symbol, trade_date) merged into one: first/last by (time, second), sums, and M2.

    Each state's squared deviations are moved to the day's mean, which a window
    on the same exchange and sort puts beside it: M2 = sum(m2 + n * (mean - day
    mean)^2). A day's states stream through both, spilled where they are many, and
    are never gathered into one row; there is no difference of large sums, and a
    day of one price has M2 zero however its mean was rounded.
    """
    keys = ["symbol", "trade_date"]
    day = Window.partitionBy(*keys)
    mean = F.try_divide(F.sum("price_sum").over(day), F.sum("n").over(day))
    off = F.try_divide("price_sum", "n") - F.col("_mean")
    moved = states.withColumn("_mean", mean).withColumn("m2", F.when(F.col("n") > 0, F.col("m2") + F.col("n") * off * off))
    days = moved.groupBy(*keys).agg(
        F.min(F.struct("first_time", "first_by", "open_price")).alias("_first"),
        F.max(F.struct("last_time", "last_by", "close_price")).alias("_last"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("n").alias("n"),
        F.sum("price_sum").alias("price_sum"),
        F.sum("m2").alias("m2"),
    )
    days = days.withColumn("m2", F.when(F.col("high_price") == F.col("low_price"), 0.0).otherwise(F.col("m2")))
    return days.select("*", "_first.*", "_last.*").select(*STATE_COLS)


def ohlcv(states: DataFrame) -> DataFrame:
    """Daily rows of merged states (one a day)."""
    n = F.col("n")
    return states.select(
        "symbol",
        "trade_date",
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "total_volume",
        F.try_divide("price_sum", n).alias("avg_price"),
        F.when(n > 1, F.sqrt(F.try_divide("m2", n - 1))).alias("volatility"),
    )


def with_prev_close(daily: DataFrame, price_col: str = "close_price") -> DataFrame:
    """prev_close is the previous *row* of the symbol, not the previous calendar day."""
    return daily.withColumn("prev_close", F.lag(price_col, 1).over(ind.by_symbol()))


def with_pct_change(df: DataFrame) -> DataFrame:
    return df.withColumn("pct_change", ind.pct_change("close_price", "prev_close"))


def with_gain_loss(df: DataFrame, price_col: str = "close_price", period: int = ind.RSI_PERIOD) -> DataFrame:
    """gain/loss of each day's delta and their trailing means over ``period`` rows.

    Reuses an existing prev_close (lag of close_price) so the plan holds one
    Window node for the lag and one for both trailing means, on one sort.
    """
    if price_col == "close_price" and "prev_close" in df.columns:
        prev = F.col("prev_close")
    else:
        prev = F.lag(price_col, 1).over(ind.by_symbol())
    delta = F.col(price_col) - prev
    frame = ind.trailing_rows(period)
    return df.withColumns({"gain": ind.gain(delta), "loss": ind.loss(delta)}).withColumns(
        {"avg_gain": F.avg("gain").over(frame), "avg_loss": F.avg("loss").over(frame)}
    )


def with_rsi(
    df: DataFrame, price_col: str = "close_price", period: int = ind.RSI_PERIOD, out: str = "rsi_14"
) -> DataFrame:
    """Pipeline RSI: plain trailing means, partial frames allowed (first day → 100)."""
    return (
        with_gain_loss(df, price_col, period)
        .withColumn(out, ind.rsi_from_averages("avg_gain", "avg_loss"))
        .drop("gain", "loss", "avg_gain", "avg_loss")
    )


def gold_from_daily(daily: DataFrame, period: int = ind.RSI_PERIOD) -> DataFrame:
    return with_rsi(with_pct_change(with_prev_close(daily)), period=period).select(*GOLD_COLS)


def gold_daily(ticks: DataFrame, order_by: Sequence[str] = DEFAULT_TICK_ORDER) -> DataFrame:
    """Full gold assembly: daily OHLCV → prev_close → pct_change → rsi_14."""
    return gold_from_daily(daily_ohlcv(ticks, order_by))


# Rows of history a recomputed row can read: lag needs 1, the 14-row gain/loss
# frame needs 13 earlier gains, each of which needs one more earlier close.
def context_rows(period: int = ind.RSI_PERIOD) -> int:
    return period


def gold_changes(
    gold_prev: DataFrame,
    silver_all: DataFrame,
    new_ticks: DataFrame,
    order_by: Sequence[str] = DEFAULT_TICK_ORDER,
    period: int = ind.RSI_PERIOD,
) -> tuple[DataFrame, DataFrame] | None:
    """(recomputed rows, first touched day per symbol) for a batch of new ticks; None for an empty batch.

    * days touched by the batch (late ticks included) are re-aggregated from
      silver, reading only those (symbol, trade_date) groups;
    * per touched symbol, every row from its first touched day on is recomputed,
      seeded with the ``period`` gold rows before it. Other symbols never reach
      a window: gold is cut to the touched symbols by an inner join first.
    """
    spark = new_ticks.sparkSession
    shared_dir(spark)
    # Read several times below, so the new ticks are reduced once.
    touched = with_trade_date(new_ticks).select("symbol", "trade_date").distinct().checkpoint(eager=True)
    # Earliest touched day (a one-row aggregate): pushed into the silver scan as
    # a static range filter, so only row groups from that day on are read.
    first_day = touched.agg(F.min("trade_date")).first()[0]
    if first_day is None:
        return None
    recent = silver_all.filter(F.col("event_time") >= F.lit(first_day).cast("timestamp"))
    redo = daily_ohlcv(with_trade_date(recent).join(touched, ["symbol", "trade_date"], "left_semi"), order_by)
    return recomputed_rows(gold_prev, redo, touched, period)


def recomputed_rows(
    gold_prev: DataFrame, redo: DataFrame, touched: DataFrame, period: int = ind.RSI_PERIOD
) -> tuple[DataFrame, DataFrame]:
    """(gold rows of each touched symbol from its first touched day on, that day per symbol).

    ``redo`` are the daily rows of the ``touched`` (symbol, trade_date) pairs.
    Gold is cut to the touched symbols before any window; before a symbol's
    first touched day only the ``period`` rows of context are read.
    """
    start = touched.groupBy("symbol").agg(F.min("trade_date").alias("_start"))
    own = gold_prev.select(*redo.columns).join(start, "symbol")
    later = own.filter(F.col("trade_date") >= F.col("_start")).join(touched, ["symbol", "trade_date"], "left_anti")
    back = F.row_number().over(Window.partitionBy("symbol").orderBy(F.col("trade_date").desc()))
    context = own.filter(F.col("trade_date") < F.col("_start")).withColumn("_back", back)
    context = context.filter(F.col("_back") <= context_rows(period))
    daily = context.select(*redo.columns).unionByName(later.select(*redo.columns)).unionByName(redo)
    recomputed = gold_from_daily(daily, period).join(start, "symbol").filter(F.col("trade_date") >= F.col("_start"))
    return recomputed.select(*GOLD_COLS), start


def gold_incremental(
    gold_prev: DataFrame,
    silver_all: DataFrame,
    new_ticks: DataFrame,
    order_by: Sequence[str] = DEFAULT_TICK_ORDER,
    period: int = ind.RSI_PERIOD,
) -> DataFrame:
    """A gold table brought up to date with a batch of new ticks; equals a full rebuild.

    Rows before a symbol's first touched day, and all rows of untouched
    symbols, are kept as they are.
    """
    changes = gold_changes(gold_prev, silver_all, new_ticks, order_by, period)
    if changes is None:
        return gold_prev.select(*GOLD_COLS)
    return replaced_from(gold_prev, *changes)


def replaced_from(gold_prev: DataFrame, recomputed: DataFrame, start: DataFrame) -> DataFrame:
    """Previous gold with each touched symbol's rows from its first touched day on replaced."""
    unchanged = gold_prev.join(start, "symbol", "left").filter(
        F.col("_start").isNull() | (F.col("trade_date") < F.col("_start"))
    )
    return unchanged.select(*GOLD_COLS).unionByName(recomputed)
