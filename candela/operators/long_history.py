"""Row windows over long histories: one symbol's rows spread over many tasks.

A window keyed by symbol puts a symbol's whole history into one task. Here every
row gets its position inside its symbol (range partitioning by symbol and date, a
row number per range, offsets of the ranges before), and blocks of ``block_rows``
positions become the window's key. A block also carries the last ``halo`` rows of
the block before it, so any frame of at most ``halo`` rows before the current one
sees the same rows as in the plain window; the halo rows themselves are dropped
afterwards.

The operators of ``gold`` and ``indicators`` are used as they are: inside a block
the column ``symbol`` holds (symbol, block).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.indicators import RSI_PERIOD
from candela.operators.gold import DEFAULT_TICK_ORDER, context_rows, daily_ohlcv, with_pct_change, with_prev_close, with_rsi
from candela.schema import GOLD_COLS
from candela.session import shared_dir

#: Daily rows a block: sixteen years of trading days.
BLOCK_ROWS = 4096


def with_symbol_position(daily: DataFrame, out: str = "_pos") -> DataFrame:
    """0-based position of each row inside its symbol by ``trade_date`` (one row a day)."""
    spark = daily.sparkSession
    shared_dir(spark)
    base = daily.checkpoint(eager=True)  # range boundaries are sampled: the rows are read twice
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Sizes and positions must see one assignment to ranges, so it is written down.
    ranged = base.repartitionByRange(parts, "symbol", "trade_date").withColumn("_range", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)
    sizes = ranged.groupBy("symbol", "_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("symbol").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = sizes.select(
        F.col("symbol").alias("_of"), F.col("_range").alias("_in"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("symbol", "_range").orderBy("trade_date")))
    same = F.col("symbol").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_in"))
    placed = local.join(offsets, same).withColumn(out, F.col("_offset") + F.col("_local") - 1)
    return placed.drop("_range", "_local", "_of", "_in", "_offset")


def over_blocks(
    daily: DataFrame, compute: Callable[[DataFrame], DataFrame], halo: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``compute(daily)`` for windows by (symbol ORDER BY trade_date) that look at most ``halo`` rows back."""
    if halo < 0 or block_rows < max(1, halo):
        raise ValueError(f"blocks of {block_rows} rows can't hold a halo of {halo}")
    pos = F.col("_pos")
    block = F.floor(pos / block_rows)
    own = F.struct(block.alias("block"), F.lit(True).alias("own"))
    ahead = F.struct((block + 1).alias("block"), F.lit(False).alias("own"))
    places = F.when(pos % block_rows >= block_rows - halo, F.array(own, ahead)).otherwise(F.array(own))
    rows = with_symbol_position(daily).withColumn("_place", F.explode(places)).drop("_pos")
    rows = rows.withColumn("symbol", F.struct(F.col("symbol").alias("name"), F.col("_place.block").alias("block")))
    rows = rows.withColumn("_own", F.col("_place.own")).drop("_place")
    return compute(rows).filter("_own").withColumn("symbol", F.col("symbol.name")).drop("_own")


def gold_long_history(
    daily: DataFrame, period: int = RSI_PERIOD, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Gold of daily rows: prev_close, pct_change and RSI, block by block."""

    def compute(rows: DataFrame) -> DataFrame:
        return with_rsi(with_pct_change(with_prev_close(rows)), period=period)

    return over_blocks(daily, compute, context_rows(period), block_rows).select(*GOLD_COLS)


def gold_daily_long_history(ticks: DataFrame, order_by=DEFAULT_TICK_ORDER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    return gold_long_history(daily_ohlcv(ticks, order_by), block_rows=block_rows)
