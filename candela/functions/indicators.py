"""Indicator formulas as Column expressions (JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

# Fixed values that must equal the reference: RSI banding thresholds and the default RSI period.
RSI_OVERBOUGHT = 70
RSI_OVERSOLD = 30
RSI_PERIOD = 14


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def by_symbol(order: str = "trade_date", partition: str = "symbol") -> WindowSpec:
    """The one ordering every daily indicator shares, so Catalyst sorts once."""
    return Window.partitionBy(partition).orderBy(order)


def trailing_rows(n: int, order: str = "trade_date", partition: str = "symbol") -> WindowSpec:
    """The current row and the n-1 rows before it (partial frames at the start)."""
    if n < 1:
        raise ValueError(f"a trailing frame needs at least one row, got {n}")
    return by_symbol(order, partition).rowsBetween(-(n - 1), Window.currentRow)


def trailing_days(days: int, date_col: str = "trade_date", partition: str = "symbol") -> WindowSpec:
    """Calendar range: the current date and the days-1 dates before it."""
    if days < 1:
        raise ValueError(f"a calendar range needs at least one day, got {days}")
    return (
        Window.partitionBy(partition)
        .orderBy(F.unix_date(F.col(date_col)))
        .rangeBetween(-(days - 1), Window.currentRow)
    )


def pct_change(current, previous) -> Column:
    """(current - previous) / previous * 100; NULL when previous is NULL or 0."""
    cur, prev = _c(current), _c(previous)
    return F.when(prev.isNotNull() & (prev != 0), ((cur - prev) / prev) * 100)


def gain(delta) -> Column:
    """Positive part of a price delta; a NULL delta (first row) counts as 0.0."""
    d = _c(delta)
    return F.when(d > 0, d).otherwise(F.lit(0.0))


def loss(delta) -> Column:
    d = _c(delta)
    return F.when(d < 0, -d).otherwise(F.lit(0.0))


def rsi_from_averages(avg_gain, avg_loss) -> Column:
    """100 when there is no loss in the frame, else 100 - 100 / (1 + gain/loss)."""
    g, lo = _c(avg_gain), _c(avg_loss)
    return F.when(lo == 0, F.lit(100.0)).otherwise(100 - (100 / (1 + (g / lo))))


def rsi_status(rsi) -> Column:
    """Dashboard banding; a NULL RSI falls through to Neutral."""
    r = _c(rsi)
    return (
        F.when(r >= RSI_OVERBOUGHT, F.lit("Overbought"))
        .when(r <= RSI_OVERSOLD, F.lit("Oversold"))
        .otherwise(F.lit("Neutral"))
    )


def stddev_pop_min2(x) -> Column:
    """Population standard deviation, NULL for fewer than two values."""
    v = _c(x)
    return F.when(F.count(v) >= 2, F.stddev_pop(v))


def normalise_symbol(x) -> Column:
    return F.upper(F.trim(_c(x)))
