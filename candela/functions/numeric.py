"""Deterministic decimal rounding of doubles.

Two engines that sum the same doubles in different orders can disagree in the
last bit. Snapping to 8 decimals first removes that noise; the second step then
rounds half-up at the wanted scale. Both steps are IEEE multiply/add + floor,
so any engine evaluating the same expression gets the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAP_SCALE = 8


def _half_up(c: Column, scale: int) -> Column:
    k = float(10**scale)
    return F.floor(c * F.lit(k) + F.lit(0.5)).cast("double") / F.lit(k)


def round_half_up(c: Column, scale: int) -> Column:
    return _half_up(_half_up(c, SNAP_SCALE), scale)


def round_sql(expr: str, scale: int) -> str:
    """The same rounding as SQL text (DuckDB / Spark SQL)."""

    def half_up(e: str, s: int) -> str:
        return f"(CAST(floor(({e}) * 1e{s} + 0.5) AS DOUBLE) / 1e{s})"

    return half_up(half_up(expr, SNAP_SCALE), scale)
