"""Query catalogue: every operator as a runnable query plus its SQL oracle.

``QUERIES[name] = (fn, sql)`` where ``fn(spark, sf_dir) -> DataFrame`` builds
the Spark plan over the driver's tables and ``sql`` is the equivalent DuckDB
text (``None`` where no plain-SQL statement exists). Outputs are canonicalised
the same way on both sides: doubles rounded half-up to 4 decimals, timestamps
printed as text, ranks as BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampNTZType, TimestampType

from candela.functions.indicators import normalise_symbol
from candela.functions.numeric import round_half_up
from candela.operators import daily_state
from candela.operators import gold as G
from candela.operators import indicators as I
from candela.operators import ingest, long_history, marts, quality, serving
from candela.operators.window_stats import window_stats
from candela.plans import sqlparts as S
from candela.schema import GOLD, GOLD_COLS, LINEAGE_COLS, SERVING_COLS, STAGING_TICK_TYPES, TICK_COLS
from candela.session import scratch_path, shared_dir
from candela.sources import fixtures as fx
from candela.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}
#: Queries that return an estimate, which no SQL statement repeats; tests hold them to their bounds.
ESTIMATES: dict[str, QueryFn] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, sql)
        return fn

    return deco


def estimate(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        ESTIMATES[name] = fn
        return fn

    return deco


def canon(df: DataFrame, scale: int = 4) -> DataFrame:
    """Doubles → half-up rounded; timestamps → 'yyyy-MM-dd HH:mm:ss.SSSSSS' text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DoubleType):
            c = round_half_up(c, scale)
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- fixtures
# Fixed parameters of the catalogue's fixtures.
WATCHLIST = " click, VIEW ,purchase ,unknown"
SLICER_SYMBOLS = ("click", "view")
DETAIL_SYMBOL = "click"
UPSERT_TARGET_LAST_DAY = "2024-01-25"
UPSERT_SOURCE_FIRST_DAY = "2024-01-21"
UPSERT_NULL_PCT_SYMBOL = "U1"
REPLACE_RUN_DATE = "2024-01-26"
REPLACE_SOURCE_FIRST_DAY = "2024-01-25"  # the deleted day is loaded again
INCREMENTAL_CUTOFF = "2024-01-25"
INCREMENTAL_LATE_FROM = "2024-01-20"
INCREMENTAL_LATE_MOD = 7


def ticks(spark: SparkSession, sf: str, symbols: str = "event_type") -> DataFrame:
    return fx.ticks_from_events(table(spark, sf, "events"), symbols)


def gold(spark: SparkSession, sf: str, symbols: str = "event_type") -> DataFrame:
    return G.gold_daily(ticks(spark, sf, symbols))


def snapped_gold(spark: SparkSession, sf: str, symbols: str = "event_type") -> DataFrame:
    """Gold with doubles snapped to 8 decimals: what the serving fixtures load, so both engines cast the same values."""
    return canon(gold(spark, sf, symbols), 8)


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return G.daily_ohlcv(ticks(spark, sf))


def raw(spark: SparkSession, sf: str, source: DataFrame | None = None) -> DataFrame:
    """Decoded envelope (json_value + lineage) with the JSON defect rules applied."""
    src = source if source is not None else ticks(spark, sf)
    return ingest.decode_envelope(fx.envelope_from_ticks(src))


def bronze(spark: SparkSession, sf: str, redelivered: bool = False) -> DataFrame:
    src = ticks(spark, sf)
    if redelivered:
        src = fx.redelivered_ticks(src)
    return ingest.bronze(fx.envelope_from_ticks(src), stamp=False)


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return quality.silver(bronze(spark, sf, redelivered=True))


# ------------------------------------------------------------ SQL snippets
_T = S.with_gold  # WITH ticks, daily, ..., gold
_TS = S.with_snapped_gold  # ..., snapped
_TICKS = f"WITH ticks AS ({S.ticks_sql()})"
_PARSED = f"{_TICKS}, parsed AS ({S.parsed_sql()})"
_SILVER = (
    f"WITH base AS ({S.ticks_sql()}), ticks AS ({S.redelivered_sql('base')}), "
    f"parsed AS ({S.parsed_sql()}), silver AS ({S.silver_sql()})"
)


# ======================================================= sources and parse
@query(
    "src_envelope",
    S.canon_select(
        ["json_value", "kafka_timestamp", "partition", "offset"],
        f"(SELECT {S.json_text_sql()} AS json_value, kafka_timestamp, \"partition\", \"offset\" FROM ticks)",
    ).replace("SELECT", f"{_TICKS} SELECT", 1),
)
def q_src_envelope(spark, sf):
    return canon(raw(spark, sf))


@query(
    "parse_ticks",
    f"{_PARSED} " + S.canon_select(["offset", "symbol", "price", "volume", "event_time"], "parsed"),
)
def q_parse_ticks(spark, sf):
    return canon(ingest.parse_ticks(raw(spark, sf)).select("offset", "symbol", "price", "volume", "event_time"))


@query(
    "validate_ticks",
    f"""{_TICKS} SELECT "offset", NOT ("offset" % {fx.JSON_GARBAGE_MOD} = 0 OR "offset" % {fx.JSON_WRONG_TYPE_MOD} = 0
        OR "offset" % {fx.JSON_MISSING_KEY_MOD} = 0) AS is_valid FROM ticks""",
)
def q_validate_ticks(spark, sf):
    return ingest.validate(raw(spark, sf)).select("offset", "is_valid")


@query(
    "validate_error_counts",
    f"""{_TICKS} SELECT error, count(*) AS n FROM (
      SELECT 'not_json' AS error FROM ticks WHERE "offset" % {fx.JSON_GARBAGE_MOD} = 0
      UNION ALL SELECT 'type:price' FROM ticks
        WHERE "offset" % {fx.JSON_GARBAGE_MOD} <> 0 AND "offset" % {fx.JSON_WRONG_TYPE_MOD} = 0
      UNION ALL SELECT 'missing:volume' FROM ticks
        WHERE "offset" % {fx.JSON_GARBAGE_MOD} <> 0 AND "offset" % {fx.JSON_MISSING_KEY_MOD} = 0
    ) GROUP BY error""",
)
def q_validate_error_counts(spark, sf):
    return ingest.error_counts(raw(spark, sf))


_BRONZE_OUT = TICK_COLS + ["json_value"] + LINEAGE_COLS


@query("bronze_ticks", f"{_PARSED} " + S.canon_select(_BRONZE_OUT, "parsed"))
def q_bronze_ticks(spark, sf):
    return canon(bronze(spark, sf).select(*_BRONZE_OUT))


# ============================================================ quality
@query(
    "quality_filter",
    f"{_TICKS}, dirty AS ({S.dirty_sql()}) "
    + S.canon_select(["offset", "symbol", "price", "volume"], "dirty", f"WHERE {S.quality_pred_sql()}"),
)
def q_quality_filter(spark, sf):
    dirty = fx.dirty_ticks(ticks(spark, sf))
    return canon(quality.quality_filter(dirty).select("offset", "symbol", "price", "volume"))


_NOT_OK = f"NOT coalesce({S.quality_pred_sql()}, false)"


@query(
    "quality_rejects",
    f"""{_TICKS}, dirty AS ({S.dirty_sql()}) SELECT reason, count(*) AS n FROM (
      SELECT 'null_symbol' AS reason FROM dirty WHERE {_NOT_OK} AND symbol IS NULL
      UNION ALL SELECT 'bad_price' FROM dirty WHERE {_NOT_OK} AND NOT coalesce(price > 0, false)
      UNION ALL SELECT 'bad_volume' FROM dirty WHERE {_NOT_OK} AND NOT coalesce(volume >= 0, false)
    ) GROUP BY reason""",
)
def q_quality_rejects(spark, sf):
    return quality.reject_counts(fx.dirty_ticks(ticks(spark, sf)))


@query(
    "silver_dedup",
    f"""WITH base AS ({S.ticks_sql()}), red AS ({S.redelivered_sql('base')})
    SELECT symbol, strftime(event_time, '{S.TS_FORMAT_SQL}') AS event_time, source,
      arg_min("offset", struct_pack(a := kafka_timestamp, b := "partition", c := "offset")) AS "offset"
    FROM red GROUP BY symbol, event_time, source""",
)
def q_silver_dedup(spark, sf):
    red = fx.redelivered_ticks(ticks(spark, sf))
    return canon(quality.dedup(red).select("symbol", "event_time", "source", "offset"))


@query("silver_ticks", f"{_SILVER} " + S.canon_select(TICK_COLS, "silver"))
def q_silver_ticks(spark, sf):
    return canon(silver(spark, sf))


@query(
    "silver_preview_20",
    f"{_SILVER} "
    + S.canon_select(
        ["rank"] + TICK_COLS,
        "(SELECT row_number() OVER (ORDER BY symbol, event_time, source) AS \"rank\", * FROM silver)",
        'ORDER BY "rank" LIMIT 20',
    ),
)
def q_silver_preview_20(spark, sf):
    order = [F.col("symbol"), F.col("event_time"), F.col("source")]
    return canon(marts.latest_rows(silver(spark, sf), order, 20, TICK_COLS))


@query(
    "symbol_watchlist",
    f"""{_TICKS}, w AS (SELECT DISTINCT upper(trim(s)) AS symbol
        FROM (SELECT unnest(string_split('{WATCHLIST}', ',')) AS s)),
      c AS (SELECT upper(trim(symbol)) AS symbol, count(*) AS n FROM ticks GROUP BY 1)
    SELECT w.symbol, coalesce(c.n, 0) AS n FROM w LEFT JOIN c ON w.symbol = c.symbol""",
)
def q_symbol_watchlist(spark, sf):
    return symbol_watchlist(ticks(spark, sf), WATCHLIST)


def symbol_watchlist(tick_df: DataFrame, watchlist: str) -> DataFrame:
    """Ticks per watch-listed symbol after strip + upper-case normalisation.

    Ticks are pre-aggregated per symbol before meeting the list, so the join
    sees one row per symbol.
    """
    spark = tick_df.sparkSession
    wanted = (
        spark.range(1)
        .select(F.explode(F.split(F.lit(watchlist), ",")).alias("raw"))
        .select(normalise_symbol("raw").alias("symbol"))
        .distinct()
    )
    counts = tick_df.groupBy(normalise_symbol("symbol").alias("symbol")).agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counts, "symbol", "left").select("symbol", F.coalesce("n", F.lit(0)).alias("n"))


# ================================================================ gold
_DAILY_COLS = [
    "symbol", "trade_date", "open_price", "high_price", "low_price", "close_price",
    "total_volume", "avg_price", "volatility",
]


@query("daily_ohlcv", f"{_T()} " + S.canon_select(_DAILY_COLS, "daily"))
def q_daily_ohlcv(spark, sf):
    return canon(daily(spark, sf))


@query("prev_close", f"{_T()} " + S.canon_select(["symbol", "trade_date", "close_price", "prev_close"], "gold"))
def q_prev_close(spark, sf):
    return canon(G.with_prev_close(daily(spark, sf)).select("symbol", "trade_date", "close_price", "prev_close"))


@query("pct_change", f"{_T()} " + S.canon_select(["symbol", "trade_date", "pct_change"], "gold"))
def q_pct_change(spark, sf):
    return canon(G.with_pct_change(G.with_prev_close(daily(spark, sf))).select("symbol", "trade_date", "pct_change"))


_GL = ["symbol", "trade_date", "gain", "loss", "avg_gain", "avg_loss"]


@query("gain_loss", f"{_T()} " + S.canon_select(_GL, "avgs"))
def q_gain_loss(spark, sf):
    return canon(G.with_gain_loss(daily(spark, sf)).select(*_GL))


@query("gold_rsi", f"{_T()} " + S.canon_select(["symbol", "trade_date", "rsi_14"], "gold"))
def q_gold_rsi(spark, sf):
    return canon(G.with_rsi(daily(spark, sf)).select("symbol", "trade_date", "rsi_14"))


_GOLD_SQL = f"{_T()} " + S.canon_select(GOLD_COLS, "gold")
_GOLD_USERS_SQL = f"{_T('user')} " + S.canon_select(GOLD_COLS, "gold")


@query("gold_daily", _GOLD_SQL)
def q_gold_daily(spark, sf):
    return canon(gold(spark, sf))


@query("gold_daily_users", _GOLD_USERS_SQL)
def q_gold_daily_users(spark, sf):
    return canon(gold(spark, sf, "user"))


_LI_ORDER = "tick_order"


_GOLD_LINEITEM_SQL = f"WITH ticks AS ({S.lineitem_ticks_sql()}), {S.gold_ctes(order=_LI_ORDER)} " + S.canon_select(GOLD_COLS, "gold")


@query("gold_daily_lineitem", _GOLD_LINEITEM_SQL)
def q_gold_daily_lineitem(spark, sf):
    li = fx.ticks_from_lineitem(table(spark, sf, "lineitem"))
    return canon(G.gold_daily(li, fx.LINEITEM_ORDER))


def _incremental_fixture(spark, sf) -> tuple[DataFrame, str, DataFrame, DataFrame]:
    """(previous gold, its state log, all ticks, new ticks, late ones of earlier days included).

    Previous gold and its log are what the last night left behind: they are made
    once a session and data folder, so a query only does the night's own work.
    """
    all_ticks = ticks(spark, sf, "user")
    is_new = (F.col("event_time") >= F.lit(INCREMENTAL_CUTOFF).cast("timestamp")) | (
        (F.col("event_time") >= F.lit(INCREMENTAL_LATE_FROM).cast("timestamp"))
        & (F.col("offset") % INCREMENTAL_LATE_MOD == 0)
    )
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    if key not in _LAST_NIGHT:
        gold_path, log_path = scratch_path(spark, "gold_prev"), scratch_path(spark, "daily_states")
        daily_state.write_generation(daily_state.daily_states(all_ticks.filter(~is_new)), log_path)
        daily_state.gold_from_states(daily_state.state_log(spark, log_path)).write.parquet(gold_path)
        _LAST_NIGHT[key] = gold_path, log_path
    gold_path, log_path = _LAST_NIGHT[key]
    return spark.read.schema(GOLD).parquet(gold_path).select(*GOLD_COLS), log_path, all_ticks, all_ticks.filter(is_new)


_LAST_NIGHT: dict[tuple[str, str], tuple[str, str]] = {}


@query("gold_incremental", _GOLD_USERS_SQL)
def q_gold_incremental(spark, sf):
    """Gold of the first days brought up to date with a batch of new ticks, merged into the stored daily states."""
    gold_prev, log, _, new_ticks = _incremental_fixture(spark, sf)
    batch = daily_state.append_batch(new_ticks, log, "night")
    return canon(G.replaced_from(gold_prev, *daily_state.gold_changes(gold_prev, log, batch)))


@query("gold_incremental_reread", _GOLD_USERS_SQL)
def q_gold_incremental_reread(spark, sf):
    """The same update without stored states: the touched days are aggregated from silver again."""
    gold_prev, _, all_ticks, new_ticks = _incremental_fixture(spark, sf)
    return canon(G.gold_incremental(gold_prev, all_ticks, new_ticks))


@query("gold_from_states", _GOLD_USERS_SQL)
def q_gold_from_states(spark, sf):
    """Full gold from a log of three batches with common days, compacted; no tick is read twice."""
    path, t = scratch_path(spark, "daily_states"), ticks(spark, sf, "user")
    part = F.col("offset") % 3
    daily_state.write_generation(daily_state.daily_states(t.filter(part == 0)), path)
    daily_state.append_batch(t.filter(part == 1), path, "one")
    daily_state.append_batch(t.filter(part == 2), path, "two")
    daily_state.append_batch(t.filter(part == 1), path, "one")  # run again: replaces its folder
    daily_state.compact(spark, path)
    return canon(daily_state.gold_from_states(daily_state.state_log(spark, path)))


#: Block size of the long-history queries: small, so the fixture's symbols span many blocks.
HISTORY_BLOCK_ROWS = 32


@query("gold_long_history", _GOLD_LINEITEM_SQL)
def q_gold_long_history(spark, sf):
    """Gold with windows over blocks of a symbol's days and a halo of 14 rows; equals the plain windows."""
    t = fx.ticks_from_lineitem(table(spark, sf, "lineitem"))
    return canon(long_history.gold_daily_long_history(t, fx.LINEITEM_ORDER, HISTORY_BLOCK_ROWS))


# ========================================================== indicators
def _rsi_strict_sql(period: int) -> str:
    w = S.w_rows(period)
    return f"""{_T()}, d AS (SELECT *, close_price - lag(close_price) OVER ({S.W_SYM}) AS delta FROM daily),
      e AS (SELECT *, CASE WHEN delta > 0 THEN delta WHEN delta IS NOT NULL THEN CAST(0.0 AS DOUBLE) END AS g,
                      CASE WHEN delta < 0 THEN -delta WHEN delta IS NOT NULL THEN CAST(0.0 AS DOUBLE) END AS l FROM d),
      r AS (SELECT symbol, trade_date, CASE WHEN count(delta) OVER {w} = {period} THEN
              CASE WHEN avg(l) OVER {w} = 0 THEN CAST(100.0 AS DOUBLE)
                   ELSE 100 - (100 / (1 + (avg(g) OVER {w} / avg(l) OVER {w}))) END END AS rsi FROM e)
    """ + S.canon_select(["symbol", "trade_date", "rsi"], "r")


@query("rsi_strict", _rsi_strict_sql(14))
def q_rsi_strict(spark, sf):
    return canon(I.with_rsi_strict(daily(spark, sf), 14).select("symbol", "trade_date", "rsi"))


@query("rsi_strict_7", _rsi_strict_sql(7))
def q_rsi_strict_7(spark, sf):
    return canon(I.with_rsi_strict(daily(spark, sf), 7).select("symbol", "trade_date", "rsi"))


def _sma_sql(n: int) -> str:
    w = S.w_rows(n)
    return f"""{_T()}, s AS (SELECT symbol, trade_date,
        CASE WHEN count(close_price) OVER {w} = {n} THEN avg(close_price) OVER {w} END AS sma FROM daily)
    """ + S.canon_select(["symbol", "trade_date", "sma"], "s")


@query("sma_5", _sma_sql(5))
def q_sma_5(spark, sf):
    return canon(I.with_sma(daily(spark, sf), 5).select("symbol", "trade_date", "sma"))


@query("sma_14", _sma_sql(14))
def q_sma_14(spark, sf):
    return canon(I.with_sma(daily(spark, sf), 14).select("symbol", "trade_date", "sma"))


@query(
    "volatility_pop",
    f"""{_T()}, v AS (SELECT symbol, count(close_price) AS n,
        CASE WHEN count(close_price) >= 2 THEN stddev_pop(close_price) END AS volatility FROM daily GROUP BY symbol)
    """ + S.canon_select(["symbol", "n", "volatility"], "v"),
)
def q_volatility_pop(spark, sf):
    return canon(I.volatility_pop(daily(spark, sf)))


@query(
    "volatility_rolling_14",
    f"""{_T()}, v AS (SELECT symbol, trade_date, CASE WHEN count(close_price) OVER {S.w_rows(14)} >= 2
        THEN stddev_pop(close_price) OVER {S.w_rows(14)} END AS volatility FROM daily)
    """ + S.canon_select(["symbol", "trade_date", "volatility"], "v"),
)
def q_volatility_rolling_14(spark, sf):
    return canon(I.with_volatility_rolling(daily(spark, sf), 14).select("symbol", "trade_date", "volatility"))


def _vol7_sql(symbols: str) -> str:
    return f"""{_T(symbols)}, v AS (SELECT symbol, trade_date, avg(volatility) OVER (PARTITION BY symbol
        ORDER BY (trade_date - DATE '1970-01-01') RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS volatility_7d
        FROM gold)
    """ + S.canon_select(["symbol", "trade_date", "volatility_7d"], "v")


@query("volatility_7d", _vol7_sql("event_type"))
def q_volatility_7d(spark, sf):
    return canon(marts.volatility_7d(gold(spark, sf)))


@query("volatility_7d_users", _vol7_sql("user"))
def q_volatility_7d_users(spark, sf):
    return canon(marts.volatility_7d(gold(spark, sf, "user")))


@query(
    "volatility_7d_market",
    f"""{_T('user')}, p AS (SELECT trade_date, sum(volatility) AS s, count(volatility) AS n FROM gold GROUP BY 1),
      v AS (SELECT trade_date, sum(s) OVER w / sum(n) OVER w AS volatility_7d FROM p
        WINDOW w AS (ORDER BY (trade_date - DATE '1970-01-01') RANGE BETWEEN 6 PRECEDING AND CURRENT ROW))
    """ + S.canon_select(["trade_date", "volatility_7d"], "v"),
)
def q_volatility_7d_market(spark, sf):
    return canon(I.volatility_7d_market(gold(spark, sf, "user")))


_WS_COLS = ["symbol", "window_start", "window_end", "avg_price", "max_price", "min_price", "volatility", "tick_count"]


def window_stats_sql(src: str) -> str:
    return f"""SELECT symbol, time_bucket(INTERVAL 1 minute, event_time) AS window_start,
        time_bucket(INTERVAL 1 minute, event_time) + INTERVAL 1 minute AS window_end,
        avg(price) AS avg_price, max(price) AS max_price, min(price) AS min_price,
        stddev_samp(price) AS volatility, count(price) AS tick_count
      FROM {src} GROUP BY ALL"""


@query("window_stats_1m", f"{_TICKS}, ws AS ({window_stats_sql('ticks')}) " + S.canon_select(_WS_COLS, "ws"))
def q_window_stats_1m(spark, sf):
    return canon(window_stats(ticks(spark, sf)))


# ============================================================== marts
_MOVERS = ["rank"] + marts.MOVER_COLS


def _movers_sql(order: str) -> str:
    return f"""{_T()}, m AS (SELECT row_number() OVER (ORDER BY {order}) AS "rank", symbol, trade_date,
        close_price, pct_change, rsi_14 FROM gold WHERE trade_date = (SELECT max(trade_date) FROM gold))
    """ + S.canon_select(_MOVERS, "m")


@query("top_movers_latest", _movers_sql("abs(pct_change) DESC NULLS FIRST, symbol"))
def q_top_movers_latest(spark, sf):
    return canon(marts.top_movers_latest(gold(spark, sf)))


@query("top_movers_latest_users", _movers_sql("abs(pct_change) DESC NULLS FIRST, symbol").replace(_T(), _T("user")))
def q_top_movers_latest_users(spark, sf):
    return canon(marts.top_movers_latest(gold(spark, sf, "user")))


@query(
    "top_movers_view_sql",
    f"""{_T('user')} """
    + S.canon_select(marts.MOVER_COLS, "gold", "WHERE trade_date = (SELECT max(trade_date) FROM gold)"),
)
def q_top_movers_view_sql(spark, sf):
    """The serving view queried through Spark SQL (scalar subquery in SQL)."""
    marts.register_serving_views(gold(spark, sf, "user"))
    return canon(spark.sql("SELECT * FROM vw_top_movers_latest"))


@query("top_gainers_latest", _movers_sql("pct_change DESC NULLS LAST, symbol"))
def q_top_gainers_latest(spark, sf):
    return canon(marts.top_gainers_latest(gold(spark, sf)))


@query(
    "gold_latest_20",
    f"{_T('user')} "
    + S.canon_select(
        ["rank"] + GOLD_COLS,
        '(SELECT row_number() OVER (ORDER BY trade_date DESC, symbol) AS "rank", * FROM gold)',
        'ORDER BY "rank" LIMIT 20',
    ),
)
def q_gold_latest_20(spark, sf):
    return canon(marts.gold_latest(gold(spark, sf, "user"), 20))


@query(
    "market_overview",
    f"""{_T('user')}, m AS (SELECT count(DISTINCT symbol) AS symbols, max(trade_date) AS latest_date,
        avg(pct_change) AS avg_pct_change, avg(avg_price) AS avg_price,
        CAST(sum(total_volume) AS BIGINT) AS total_volume FROM gold)
    """ + S.canon_select(["symbols", "latest_date", "avg_pct_change", "avg_price", "total_volume"], "m"),
)
def q_market_overview(spark, sf):
    return canon(marts.market_overview(gold(spark, sf, "user")))


@query(
    "market_trends",
    f"""{_T('user')}, m AS (SELECT trade_date, avg(close_price) AS avg_close,
        CAST(sum(total_volume) AS BIGINT) AS total_volume, avg(volatility) AS avg_volatility,
        avg(pct_change) AS avg_pct_change FROM gold GROUP BY trade_date)
    """ + S.canon_select(["trade_date", "avg_close", "total_volume", "avg_volatility", "avg_pct_change"], "m"),
)
def q_market_trends(spark, sf):
    return canon(marts.market_trends(gold(spark, sf, "user")))


@query(
    "daily_return_by_date",
    f"{_T('user')}, m AS (SELECT trade_date, avg(pct_change) AS daily_return FROM gold GROUP BY 1) "
    + S.canon_select(["trade_date", "daily_return"], "m"),
)
def q_daily_return_by_date(spark, sf):
    return canon(marts.daily_return(gold(spark, sf, "user"), "trade_date"))


@query(
    "daily_return_by_symbol",
    f"{_T('user')}, m AS (SELECT symbol, avg(pct_change) AS daily_return FROM gold GROUP BY 1) "
    + S.canon_select(["symbol", "daily_return"], "m"),
)
def q_daily_return_by_symbol(spark, sf):
    return canon(marts.daily_return(gold(spark, sf, "user"), "symbol"))


_IN_SLICER = ", ".join(f"'{s}'" for s in SLICER_SYMBOLS)


@query(
    "price_series",
    f"{_T()} " + S.canon_select(["symbol", "trade_date", "close_price"], "gold", f"WHERE symbol IN ({_IN_SLICER})"),
)
def q_price_series(spark, sf):
    return canon(marts.price_series(gold(spark, sf), SLICER_SYMBOLS))


_STATUS_SQL = "CASE WHEN {r} >= 70 THEN 'Overbought' WHEN {r} <= 30 THEN 'Oversold' ELSE 'Neutral' END"


@query(
    "rsi_bands",
    f"{_T('user')}, b AS (SELECT symbol, trade_date, rsi_14, {_STATUS_SQL.format(r='rsi_14')} AS status FROM gold) "
    + S.canon_select(["symbol", "trade_date", "rsi_14", "status"], "b"),
)
def q_rsi_bands(spark, sf):
    return canon(marts.rsi_bands(gold(spark, sf, "user")))


@query(
    "rsi_status",
    f"""{_T('user')}, m AS (SELECT symbol, max(rsi_14) AS rsi FROM gold GROUP BY 1),
      b AS (SELECT symbol, rsi, {_STATUS_SQL.format(r='rsi')} AS status FROM m)
    """ + S.canon_select(["symbol", "rsi", "status"], "b"),
)
def q_rsi_status(spark, sf):
    return canon(marts.rsi_status(gold(spark, sf, "user")))


@query(
    "rsi_status_latest",
    f"""{_T('user')}, m AS (SELECT symbol, arg_max(rsi_14, trade_date) AS rsi FROM gold GROUP BY 1),
      b AS (SELECT symbol, rsi, {_STATUS_SQL.format(r='rsi')} AS status FROM m)
    """ + S.canon_select(["symbol", "rsi", "status"], "b"),
)
def q_rsi_status_latest(spark, sf):
    return canon(marts.rsi_status_latest(gold(spark, sf, "user")))


_RR = ["symbol", "trade_date", "volatility", "pct_change", "total_volume", "is_complete"]


@query(
    "risk_return_points",
    f"""{_T('user')}, p AS (SELECT symbol, trade_date, volatility, pct_change, total_volume,
        volatility IS NOT NULL AND pct_change IS NOT NULL AS is_complete FROM gold)
    """ + S.canon_select(_RR, "p"),
)
def q_risk_return_points(spark, sf):
    return canon(marts.risk_return_points(gold(spark, sf, "user")))


_OHLC = ["symbol", "trade_date", "open_price", "high_price", "low_price", "close_price"]


@query("candlestick", f"{_T()} " + S.canon_select(_OHLC, "gold", f"WHERE symbol = '{DETAIL_SYMBOL}'"))
def q_candlestick(spark, sf):
    return canon(marts.candlestick(gold(spark, sf), DETAIL_SYMBOL))


@query(
    "symbol_detail",
    f"{_TS()} SELECT {S.serving_typed_cols()} FROM snapped WHERE symbol = '{DETAIL_SYMBOL}'",
)
def q_symbol_detail(spark, sf):
    return marts.symbol_detail(serving.serving_typed(snapped_gold(spark, sf)), DETAIL_SYMBOL)


# ============================================================ serving
@query("serving_projection", f"{_T('user')} " + S.canon_select(SERVING_COLS, "gold"))
def q_serving_projection(spark, sf):
    return canon(serving.serving_projection(gold(spark, sf, "user")))


@query(
    "serving_decimal_cast",
    f"{_TS('user')} SELECT {S.serving_typed_cols()} FROM snapped WHERE {S.serving_fits_sql()}",
)
def q_serving_decimal_cast(spark, sf):
    ok, _ = serving.serving_cast(snapped_gold(spark, sf, "user"))
    return ok


def _overflow_sql() -> str:
    parts = []
    for c, t in S.SERVING_TYPES.items():
        parts.append(
            f"SELECT symbol, trade_date, '{c}' AS \"column\" FROM snapped WHERE {S.q(c)} IS NOT NULL "
            f"AND {S.decimal_sql(S.q(c), t)} IS NULL"
        )
    return f"{_TS('user')} " + " UNION ALL ".join(parts)


@query("serving_overflow_rejects", _overflow_sql())
def q_serving_overflow_rejects(spark, sf):
    return serving.overflow_rejects(snapped_gold(spark, sf, "user"))


# Ties at every serving scale, of both signs: k / 10^5 with k a multiple of 5 ends in a 5 one place after the scale.
_EDGE_TYPES = {"price": "open_price", "volatility": "volatility", "pct": "pct_change", "rsi": "rsi_14"}


def _edges_sql() -> str:
    cols = []
    for name, c in _EDGE_TYPES.items():
        t = S.SERVING_TYPES[c]
        cols.append(f"{S.decimal_sql(f'CAST(k * 5 AS DOUBLE) / 1e{t.scale + 1}', t)} AS {name}")
    return f"SELECT event_id, {', '.join(cols)} FROM (SELECT event_id, event_id % 20001 - 10000 AS k FROM events)"


@query("serving_rounding_edges", _edges_sql())
def q_serving_rounding_edges(spark, sf):
    """Decimal casts of exact ties, negative ones included (half away from zero)."""
    k = F.col("event_id") % 20001 - 10000
    values = {n: (k * 5).cast("double") / F.lit(float(10 ** (S.SERVING_TYPES[c].scale + 1))) for n, c in _EDGE_TYPES.items()}
    rows = table(spark, sf, "events").select("event_id", *[v.alias(_EDGE_TYPES[n]) for n, v in values.items()])
    return rows.select("event_id", *[serving._to_decimal(c, S.SERVING_TYPES[c]).alias(n) for n, c in _EDGE_TYPES.items()])


def _serving_sql_cte(name: str, where: str, modified: bool = False) -> str:
    src = "snapped"
    if modified:
        src = (
            "(SELECT * REPLACE (close_price + 1 AS close_price, "
            f"CASE WHEN symbol = '{UPSERT_NULL_PCT_SYMBOL}' THEN NULL ELSE pct_change END AS pct_change) FROM snapped)"
        )
    return f"{name} AS (SELECT {S.serving_typed_cols()} FROM {src} WHERE {where} AND {S.serving_fits_sql()})"


_TGT = _serving_sql_cte("tgt", f"trade_date <= DATE '{UPSERT_TARGET_LAST_DAY}'")
_SRC = _serving_sql_cte("src", f"trade_date >= DATE '{UPSERT_SOURCE_FIRST_DAY}'", modified=True)
_UPSERT_SQL = f"""{_TS('user')}, {_TGT}, {_SRC}
    SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.symbol = tgt.symbol AND src.trade_date = tgt.trade_date)
    UNION ALL SELECT * FROM src"""


def _serving_fixture(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(target: loadable gold of the first days, source: later days, changed).

    Gold is checkpointed once to the shared folder: the fixture derives both
    the target and the source from it.
    """
    shared_dir(spark)
    g = snapped_gold(spark, sf, "user").checkpoint(eager=True)
    tgt, _ = serving.serving_cast(g.filter(F.col("trade_date") <= F.lit(UPSERT_TARGET_LAST_DAY).cast("date")))
    changed = g.filter(F.col("trade_date") >= F.lit(UPSERT_SOURCE_FIRST_DAY).cast("date")).withColumns(
        {
            "close_price": F.col("close_price") + 1,
            "pct_change": F.when(F.col("symbol") != UPSERT_NULL_PCT_SYMBOL, F.col("pct_change")),
        }
    )
    src, _ = serving.serving_cast(changed)
    return tgt, src


def _materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh shared location (partitioned by trade_date) and read back."""
    from candela.sources.lake import write_partitioned

    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_partitioned(df, path, ["trade_date"])
    return spark.read.schema(df.schema).parquet(path)


@query("snk_upsert", _UPSERT_SQL)
def q_snk_upsert(spark, sf):
    tgt, src = _serving_fixture(spark, sf)
    out = serving.upsert(_materialise(tgt, "serving"), src)
    return _materialise(out, "serving_v2").select(*SERVING_COLS)


@query("snk_upsert_idempotent", _UPSERT_SQL)
def q_snk_upsert_idempotent(spark, sf):
    tgt, src = _serving_fixture(spark, sf)
    once = _materialise(serving.upsert(_materialise(tgt, "serving"), src), "serving_v2")
    twice = _materialise(serving.upsert(once, src), "serving_v3")
    return twice.select(*SERVING_COLS)


@query(
    "snk_append_guarded",
    f"""{_TS('user')}, {_TGT}, {_SRC}
    SELECT * FROM tgt UNION ALL
    SELECT * FROM src WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE src.symbol = tgt.symbol AND src.trade_date = tgt.trade_date)""",
)
def q_snk_append_guarded(spark, sf):
    tgt, src = _serving_fixture(spark, sf)
    out = serving.append_guarded(_materialise(tgt, "serving"), src)
    return _materialise(out, "serving_v2").select(*SERVING_COLS)


_SRC_REPLACE = _serving_sql_cte("src", f"trade_date >= DATE '{REPLACE_SOURCE_FIRST_DAY}'", modified=True)


@query(
    "snk_replace_day",
    f"""{_TS('user')}, {_TGT}, {_SRC_REPLACE},
      kept AS (SELECT * FROM tgt WHERE trade_date <> DATE '{REPLACE_RUN_DATE}' - INTERVAL 1 DAY)
    SELECT * FROM kept WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.symbol = kept.symbol AND src.trade_date = kept.trade_date)
    UNION ALL SELECT * FROM src""",
)
def q_snk_replace_day(spark, sf):
    tgt, src = _serving_fixture(spark, sf)
    src = src.filter(F.col("trade_date") >= F.lit(REPLACE_SOURCE_FIRST_DAY).cast("date"))
    out = serving.replace_day(_materialise(tgt, "serving"), src, REPLACE_RUN_DATE)
    return _materialise(out, "serving_v2").select(*SERVING_COLS)


@query(
    "serving_constraint_check",
    f"""{_TS('user')}, {_TGT}, {_SRC},
      blind AS (SELECT * FROM tgt UNION ALL SELECT * FROM src),
      k AS (SELECT symbol, trade_date, count(*) AS c FROM blind GROUP BY ALL)
    SELECT 'duplicate_key' AS violation, count(*) FILTER (WHERE c > 1) AS n FROM k
    UNION ALL SELECT 'null_symbol', count(*) FILTER (WHERE symbol IS NULL) FROM blind
    UNION ALL SELECT 'null_trade_date', count(*) FILTER (WHERE trade_date IS NULL) FROM blind
    UNION ALL SELECT 'symbol_too_long', count(*) FILTER (WHERE length(symbol) > 10) FROM blind""",
)
def q_serving_constraint_check(spark, sf):
    tgt, src = _serving_fixture(spark, sf)
    return serving.constraint_violations(tgt.unionByName(src))


@query(
    "staging_raw_ticks",
    f"""{_TICKS}, s AS (SELECT "offset" AS id, symbol,
        {S.decimal_sql('price', STAGING_TICK_TYPES['price'])} AS price,
        {S.decimal_sql('open', STAGING_TICK_TYPES['open_price'])} AS open_price,
        {S.decimal_sql('day_high', STAGING_TICK_TYPES['day_high'])} AS day_high,
        {S.decimal_sql('day_low', STAGING_TICK_TYPES['day_low'])} AS day_low,
        {S.decimal_sql('prev_close', STAGING_TICK_TYPES['prev_close'])} AS prev_close,
        volume, currency, strftime(event_time, '{S.TS_FORMAT_SQL}') AS event_time, source FROM ticks)
    SELECT * FROM s""",
)
def q_staging_raw_ticks(spark, sf):
    return canon(serving.staging_raw_ticks(ticks(spark, sf)))


# Raw ticks with one defect per rule of the staging table, by event id.
STAGING_DEFECTS = {"overflow_price": 97, "null_symbol": 101, "symbol_too_long": 89, "null_event_time": 83, "source_too_long": 79}


def _staging_rejects_sql() -> str:
    def at(reason: str) -> str:
        return f'"offset" % {STAGING_DEFECTS[reason]} = 0'

    rules = {r: at(r) for r in STAGING_DEFECTS}
    # A null symbol has no length: an id with both symbol defects has neither.
    rules["null_symbol"] = f"({at('null_symbol')} AND NOT {at('symbol_too_long')})"
    rules["symbol_too_long"] = f"({at('symbol_too_long')} AND NOT {at('null_symbol')})"
    rules["accepted"] = "NOT (" + " OR ".join(rules.values()) + ")"
    parts = [f"SELECT '{r}' AS reason FROM ticks WHERE {rule}" for r, rule in rules.items()]
    return f"{_TICKS} SELECT reason, count(*) AS n FROM ({' UNION ALL '.join(parts)}) GROUP BY reason"


@query("staging_rejects", _staging_rejects_sql())
def q_staging_rejects(spark, sf):
    """Refused raw ticks by reason, and how many the staging table takes."""
    t = ticks(spark, sf)

    def at(reason):
        return F.col("offset") % STAGING_DEFECTS[reason] == 0

    dirty = t.withColumns(
        {
            "price": F.when(at("overflow_price"), F.lit(1e9)).otherwise(F.col("price")),
            "symbol": F.when(at("null_symbol") & ~at("symbol_too_long"), F.lit(None).cast("string"))
            .when(at("symbol_too_long") & ~at("null_symbol"), F.lit("LONGER-THAN-TEN"))
            .otherwise(F.col("symbol")),
            "event_time": F.when(~at("null_event_time"), F.col("event_time")),
            "source": F.when(at("source_too_long"), F.repeat(F.lit("s"), 33)).otherwise(F.col("source")),
        }
    )
    ok, refused = serving.staging_load(dirty)
    reasons = refused.select(F.explode("reasons").alias("reason"))
    accepted = ok.select(F.lit("accepted").alias("reason"))
    return reasons.unionByName(accepted).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ====================================================== lake round trips
@query(
    "src_scan",
    f"{_TICKS} SELECT symbol, count(*) AS \"rows\", CAST(sum(volume) AS BIGINT) AS sum_volume FROM ticks GROUP BY 1",
)
def q_src_scan(spark, sf, fmt: str = "parquet"):
    from candela.sources.lake import scan, write_partitioned

    path = scratch_path(spark, "ticks")
    write_partitioned(ticks(spark, sf).select(*TICK_COLS), path, fmt=fmt)
    back = scan(spark, path, fmt)
    return back.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("sum_volume"))


@query(
    "src_partition_discovery",
    f"{_T('user')} SELECT symbol, count(*) AS \"rows\" FROM gold GROUP BY 1",
)
def q_src_partition_discovery(spark, sf):
    from candela.sources.lake import read_partitioned, write_partitioned

    path = scratch_path(spark, "gold")
    write_partitioned(gold(spark, sf, "user"), path)
    back = read_partitioned(spark, path, GOLD)
    return back.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))


_ROUNDTRIP_SQL = f"""{_T()}, r AS (SELECT symbol, count(*) AS "rows", sum(close_price) AS sum_close FROM gold GROUP BY 1)
    """ + S.canon_select(["symbol", "rows", "sum_close"], "r")


@query("snk_overwrite_roundtrip", _ROUNDTRIP_SQL)
def q_snk_overwrite_roundtrip(spark, sf):
    from candela.sources.lake import read_partitioned, write_partitioned

    path = scratch_path(spark, "gold")
    g = gold(spark, sf)
    write_partitioned(g, path)
    write_partitioned(g, path)  # second overwrite of the same location: no duplicates
    back = read_partitioned(spark, path, GOLD)
    return canon(back.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.sum("close_price").alias("sum_close")))


@query("snk_register_sql", _ROUNDTRIP_SQL)
def q_snk_register_sql(spark, sf):
    from candela.sources.lake import register_table, write_partitioned

    path = scratch_path(spark, "gold")
    write_partitioned(gold(spark, sf), path)
    name = register_table(spark, "gold_daily_" + path.rsplit("-", 1)[-1], path, GOLD, ["symbol"])
    return canon(
        spark.sql(
            f"SELECT symbol, count(*) AS `rows`, sum(close_price) AS sum_close FROM {name} GROUP BY symbol"
        )
    )


@query(
    "silver_numeric_symbols",
    """SELECT '000' || CAST(user_id AS VARCHAR) AS symbol, count(*) AS "rows" FROM events GROUP BY 1""",
)
def q_silver_numeric_symbols(spark, sf):
    """Symbols of digits with leading zeros, written by symbol folder and read as the jobs read silver."""
    from candela.schema import SILVER
    from candela.sources.lake import scan, write_partitioned

    path = scratch_path(spark, "silver")
    rows = ticks(spark, sf, "user").withColumn("symbol", F.concat(F.lit("000"), F.expr("substring(symbol, 2)")))
    write_partitioned(rows.select(*TICK_COLS), path)
    return scan(spark, path, "parquet", SILVER).groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))


_ACCOUNTING_SQL = f"""{_SILVER}, judged AS (SELECT *, coalesce({S.quality_pred_sql()} AND event_time IS NOT NULL AND source IS NOT NULL, false) AS ok FROM parsed)
    SELECT kind, n FROM (
      SELECT 'input' AS kind, count(*) AS n FROM parsed
      UNION ALL SELECT 'silver', count(*) FROM silver
      UNION ALL SELECT 'duplicate', (SELECT count(*) FROM judged WHERE ok) - (SELECT count(*) FROM silver)
      UNION ALL SELECT 'rejected', count(*) FROM judged WHERE NOT ok
      UNION ALL SELECT 'reject:null_symbol', count(*) FROM judged WHERE NOT ok AND symbol IS NULL
      UNION ALL SELECT 'reject:bad_price', count(*) FROM judged WHERE NOT ok AND NOT coalesce(price > 0, false)
      UNION ALL SELECT 'reject:bad_volume', count(*) FROM judged WHERE NOT ok AND NOT coalesce(volume >= 0, false)
      UNION ALL SELECT 'reject:null_event_time', count(*) FROM judged WHERE NOT ok AND event_time IS NULL
      UNION ALL SELECT 'reject:null_source', count(*) FROM judged WHERE NOT ok AND source IS NULL)"""


@query("silver_accounting", _ACCOUNTING_SQL)
def q_silver_accounting(spark, sf):
    """Every bronze row is in silver, a duplicate or a reject with its reasons."""
    return quality.silver_accounting(bronze(spark, sf, redelivered=True))


_RANKED = ["rank", "symbol", "trade_date", "close_price", "pct_change"]


@query(
    "rank_lineitem_gold",
    f"""WITH ticks AS ({S.lineitem_ticks_sql()}), {S.gold_ctes(order=_LI_ORDER)},
      r AS (SELECT row_number() OVER (ORDER BY total_volume DESC, symbol, trade_date) AS "rank", * FROM gold)
    """ + S.canon_select(_RANKED, "r"),
)
def q_rank_lineitem_gold(spark, sf):
    """Position of every gold row of the larger tick source by volume; ties by symbol and day."""
    from candela.operators.ranking import with_position

    g = G.gold_daily(fx.ticks_from_lineitem(table(spark, sf, "lineitem")), fx.LINEITEM_ORDER)
    order = [F.col("total_volume").desc(), F.col("symbol"), F.col("trade_date")]
    return canon(with_position(g, order).select(*_RANKED))


# Prices of the nightly chain are whole quarters: sums are exact in any order, so both engines cast the same means.
_QUARTERS = f"SELECT * REPLACE (floor(price * 4 + 0.5) / 4 AS price) FROM ({S.ticks_sql()})"


def _landed(spark, sf) -> str:
    """The nightly chain's landing folder: redelivered envelopes of ticks priced in quarters."""
    landing = scratch_path(spark, "landing")
    rows = ticks(spark, sf).withColumn("price", F.floor(F.col("price") * 4 + 0.5) / 4)
    fx.envelope_from_ticks(fx.redelivered_ticks(rows)).write.parquet(landing)
    return landing


_NIGHTLY_SQL = f"""WITH base AS ({_QUARTERS}), delivered AS ({S.redelivered_sql('base')}), parsed AS ({S.parsed_sql('delivered')}),
      silver AS ({S.silver_sql()}), {S.gold_ctes('silver')},
      loaded AS (SELECT {S.serving_typed_cols()} FROM gold WHERE {S.serving_fits_sql()})
    SELECT * FROM loaded"""


@query("pipeline_nightly", _NIGHTLY_SQL)
def q_pipeline_nightly(spark, sf):
    """Landed envelopes through the jobs: bronze, silver, gold, serving."""
    from candela.plans import jobs
    from candela.schema import SERVING

    root = scratch_path(spark, "lake")
    jobs.run_nightly(spark, jobs.parse_args(["nightly", "--root", root, "--source-path", _landed(spark, sf)]))
    return spark.read.schema(SERVING).parquet(f"{root}/serving").select(*SERVING_COLS)


@query("pipeline_nightly_since", _NIGHTLY_SQL)
def q_pipeline_nightly_since(spark, sf):
    """Two nights: the first days in full, then with --since only what was ingested after; equals one full night."""
    from candela.plans import jobs
    from candela.schema import SERVING
    from candela.streaming.replay import DAY_BOUNDS

    root, all_rows, landing = scratch_path(spark, "lake"), _landed(spark, sf), scratch_path(spark, "landing")
    delivered = spark.read.parquet(all_rows)
    first = F.col("timestamp") < F.lit(DAY_BOUNDS[-1]).cast("timestamp")
    delivered.filter(first).write.parquet(landing)
    argv = ["nightly", "--root", root, "--source-path", landing]
    jobs.run_nightly(spark, jobs.parse_args(argv))
    since = spark.range(1).select(F.current_timestamp().cast("string")).first()[0]
    delivered.filter(~first).write.mode("append").parquet(landing)
    jobs.run_nightly(spark, jobs.parse_args([*argv, "--since", since]))
    return spark.read.schema(SERVING).parquet(f"{root}/serving").select(*SERVING_COLS)


@query("silver_job_accounting", _ACCOUNTING_SQL)
def q_silver_job_accounting(spark, sf):
    """What the silver job says of its one pass over bronze."""
    from candela.plans import jobs

    root = scratch_path(spark, "lake")
    bronze(spark, sf, redelivered=True).write.parquet(f"{root}/bronze")
    jobs.run_silver(spark, jobs.parse_args(["silver", "--input-path", f"{root}/bronze", "--output-path", f"{root}/silver"]))
    return spark.read.parquet(f"{root}/silver_accounting")


@query(
    "validate_job_invalid",
    f"""{_TICKS}, e AS (SELECT "offset", CASE WHEN "offset" % {fx.JSON_GARBAGE_MOD} = 0 THEN 'garbage'
        WHEN "offset" % {fx.JSON_WRONG_TYPE_MOD} = 0 OR "offset" % {fx.JSON_MISSING_KEY_MOD} = 0 THEN 'field' END AS kind FROM ticks)
    SELECT "offset", kind FROM e WHERE kind IS NOT NULL""",
)
def q_validate_job_invalid(spark, sf):
    """Messages that the validation job of the nightly chain sets aside."""
    from candela.plans import jobs

    root = scratch_path(spark, "lake")
    bronze(spark, sf).withColumn("_ingested_at", F.current_timestamp()).write.parquet(f"{root}/bronze")
    jobs.run_validate(spark, jobs.parse_args(["validate", "--input-path", f"{root}/bronze", "--invalid-path", f"{root}/invalid"]))
    garbage = F.col("json_value") == "not json"
    return spark.read.parquet(f"{root}/invalid").select("offset", F.when(garbage, "garbage").otherwise("field").alias("kind"))


@query("gold_bucketed", f"{_T('user')}, r AS (SELECT symbol, trade_date, avg(close_price) OVER {S.w_rows(5)} AS sma, count(close_price) OVER {S.w_rows(5)} AS n FROM gold) "
       "SELECT symbol, trade_date, " + S.canon_col("sma") + " FROM (SELECT symbol, trade_date, CASE WHEN n = 5 THEN sma END AS sma FROM r)")
def q_gold_bucketed(spark, sf):
    """A moving average over gold stored in sorted buckets: neither exchange nor sort."""
    from candela.session import session_conf
    from candela.sources.lake import BUCKET_ORDER, write_bucketed

    path = scratch_path(spark, "gold_bucketed")
    name = "gold_bucketed_" + path.rsplit("-", 1)[-1]
    write_bucketed(gold(spark, sf, "user"), name, path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with session_conf(spark, BUCKET_ORDER):
        out = canon(I.with_sma(spark.table(name).select("symbol", "trade_date", "close_price"), 5).select("symbol", "trade_date", "sma"))
        out._jdf.queryExecution().executedPlan()  # planned under these settings
    return out


@estimate("distinct_symbols_trailing")
def q_distinct_symbols_trailing(spark, sf):
    """Symbols seen in the seven days up to each day, from stored daily sketches (an estimate: tested by its bound)."""
    from candela.operators import symbol_sketch

    path = scratch_path(spark, "symbol_sketches")
    symbol_sketch.daily_symbol_sketches(gold(spark, sf, "user")).write.parquet(path)
    return symbol_sketch.distinct_symbols_trailing(spark.read.parquet(path), 7)


@query("snk_published_upsert", _UPSERT_SQL)
def q_snk_published_upsert(spark, sf):
    """Two publications of serving dates, the second an upsert; readers see them through the switched view."""
    from candela.operators import publication

    tgt, src = _serving_fixture(spark, sf)
    root = scratch_path(spark, "publication")
    name = "serving_" + root.rsplit("-", 1)[-1]
    publication.publish_upsert(tgt, name, root)
    publication.publish_upsert(src, name, root)
    return spark.table(name).select(*SERVING_COLS)
