"""Dashboard queries over the gold table (cards, series, movers, RSI, volatility)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.functions import indicators as ind
from candela.operators.indicators import with_volatility_7d
from candela.operators.ranking import with_position
from candela.schema import GOLD_COLS, SERVING_COLS

MOVER_COLS = ["symbol", "trade_date", "close_price", "pct_change", "rsi_14"]


def latest_date(gold: DataFrame):
    """Uncorrelated scalar subquery: (SELECT max(trade_date) FROM gold)."""
    return gold.select(F.max("trade_date")).scalar()


def on_latest_date(gold: DataFrame) -> DataFrame:
    return gold.filter(F.col("trade_date") == latest_date(gold))


def top_movers_latest(gold: DataFrame) -> DataFrame:
    """Latest date ordered by |pct_change| desc, NULLs first (the serving database's order)."""
    order = [F.abs("pct_change").desc_nulls_first(), F.col("symbol").asc()]
    return with_position(on_latest_date(gold).select(*MOVER_COLS), order).select("rank", *MOVER_COLS)


def top_gainers_latest(gold: DataFrame) -> DataFrame:
    """Bar-chart order: signed pct_change desc, NULLs last."""
    order = [F.col("pct_change").desc_nulls_last(), F.col("symbol").asc()]
    return with_position(on_latest_date(gold).select(*MOVER_COLS), order).select("rank", *MOVER_COLS)


def latest_rows(df: DataFrame, order, n: int = 20, cols: Sequence[str] | None = None) -> DataFrame:
    """Top-n by ``order`` (TakeOrderedAndProject), with the position as a column."""
    top = df.orderBy(*order).limit(n)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))  # n rows at most
    return ranked.select("rank", *(cols or df.columns))


def gold_latest(gold: DataFrame, n: int = 20) -> DataFrame:
    return latest_rows(gold, [F.col("trade_date").desc(), F.col("symbol").asc()], n, GOLD_COLS)


def market_overview(gold: DataFrame, approx: bool = False) -> DataFrame:
    """Overview cards. ``approx`` counts symbols with a HyperLogLog++ sketch
    (no shuffle by symbol), for very large symbol universes."""
    n_symbols = F.approx_count_distinct("symbol") if approx else F.count_distinct("symbol")
    return gold.agg(
        n_symbols.alias("symbols"),
        F.max("trade_date").alias("latest_date"),
        F.avg("pct_change").alias("avg_pct_change"),
        F.avg("avg_price").alias("avg_price"),
        F.sum("total_volume").alias("total_volume"),
    )


def market_trends(gold: DataFrame) -> DataFrame:
    return gold.groupBy("trade_date").agg(
        F.avg("close_price").alias("avg_close"),
        F.sum("total_volume").alias("total_volume"),
        F.avg("volatility").alias("avg_volatility"),
        F.avg("pct_change").alias("avg_pct_change"),
    )


def daily_return(gold: DataFrame, by: str) -> DataFrame:
    """'Daily Return %' = average pct_change in the filter context (by date or symbol)."""
    return gold.groupBy(by).agg(F.avg("pct_change").alias("daily_return"))


def price_series(gold: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Slicer on the raw symbol column, so a symbol-partitioned table is pruned."""
    return gold.filter(F.col("symbol").isin(list(symbols))).select("symbol", "trade_date", "close_price")


def rsi_bands(gold: DataFrame) -> DataFrame:
    return gold.select("symbol", "trade_date", "rsi_14", ind.rsi_status("rsi_14").alias("status"))


def rsi_status(gold: DataFrame) -> DataFrame:
    """As the dashboard measure is written: MAX(rsi_14) over the context, then banded."""
    return (
        gold.groupBy("symbol")
        .agg(F.max("rsi_14").alias("rsi"))
        .withColumn("status", ind.rsi_status("rsi"))
    )


def rsi_status_latest(gold: DataFrame) -> DataFrame:
    """The evident intent: the RSI of each symbol's latest day."""
    return (
        gold.groupBy("symbol")
        .agg(F.max_by("rsi_14", "trade_date").alias("rsi"))
        .withColumn("status", ind.rsi_status("rsi"))
    )


def risk_return_points(gold: DataFrame) -> DataFrame:
    """Scatter points; rows with a NULL axis are kept and flagged, not dropped."""
    return gold.select(
        "symbol",
        "trade_date",
        "volatility",
        "pct_change",
        "total_volume",
        (F.col("volatility").isNotNull() & F.col("pct_change").isNotNull()).alias("is_complete"),
    )


def candlestick(gold: DataFrame, symbol: str) -> DataFrame:
    return gold.filter(F.col("symbol") == symbol).select(
        "symbol", "trade_date", "open_price", "high_price", "low_price", "close_price"
    )


def symbol_detail(serving: DataFrame, symbol: str) -> DataFrame:
    return serving.filter(F.col("symbol") == symbol).select(*SERVING_COLS)


def volatility_7d(gold: DataFrame) -> DataFrame:
    return with_volatility_7d(gold).select("symbol", "trade_date", "volatility_7d")


def register_serving_views(gold: DataFrame, table: str = "gold_daily_metrics") -> None:
    """Expose gold as ``table`` and the movers of its latest date as the SQL view
    ``vw_top_movers_latest`` (Spark SQL temp views, re-evaluated on every read).

    The view's order (|pct_change| descending, NULLs first, then symbol) is a
    range-partitioned distributed sort; ``top_movers_latest`` adds a rank column.
    """
    gold.createOrReplaceTempView(table)
    gold.sparkSession.sql(
        f"""CREATE OR REPLACE TEMP VIEW vw_top_movers_latest AS
        WITH day AS (SELECT * FROM {table} WHERE trade_date = (SELECT max(trade_date) FROM {table}))
        SELECT symbol, trade_date, close_price, pct_change, rsi_14
        FROM day
        ORDER BY abs(pct_change) DESC NULLS FIRST, symbol"""
    )
