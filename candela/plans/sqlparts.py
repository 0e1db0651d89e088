"""SQL text (DuckDB dialect) for the oracle side of the query catalogue.

Each fragment restates a fixture or operator of the Spark side in plain SQL
over the driver's tables, so the two engines are checked against each other.
"""

from __future__ import annotations

from candela.functions.numeric import round_sql
from candela.schema import GOLD_COLS, SERVING_COLS, SERVING_TYPES
from candela.sources import fixtures as fx

# Output columns canonicalised on both sides: doubles rounded half-up to 4
# decimals, timestamps printed as text.
DOUBLE_COLS = {
    "price", "open", "day_high", "day_low", "prev_close", "open_price", "high_price", "low_price",
    "close_price", "avg_price", "volatility", "pct_change", "rsi_14", "gain", "loss", "avg_gain",
    "avg_loss", "rsi", "sma", "volatility_7d", "max_price", "min_price", "avg_close",
    "avg_volatility", "avg_pct_change", "daily_return", "sum_close",
}
TS_COLS = {"event_time", "kafka_timestamp", "window_start", "window_end"}
TS_FORMAT_SQL = "%Y-%m-%d %H:%M:%S.%f"


def q(name: str) -> str:
    return f'"{name}"'


def canon_col(name: str) -> str:
    if name in DOUBLE_COLS:
        return f"{round_sql(q(name), 4)} AS {q(name)}"
    if name in TS_COLS:
        return f"strftime({q(name)}, '{TS_FORMAT_SQL}') AS {q(name)}"
    return q(name)


def canon_select(cols, src: str, tail: str = "") -> str:
    return f"SELECT {', '.join(canon_col(c) for c in cols)} FROM {src} {tail}".strip()


def ticks_sql(symbols: str = "event_type") -> str:
    sym = "event_type" if symbols == "event_type" else "'U' || CAST(user_id AS VARCHAR)"
    return f"""SELECT {sym} AS symbol, value AS price,
      CAST(NULL AS DOUBLE) AS open, CAST(NULL AS DOUBLE) AS day_high,
      CAST(NULL AS DOUBLE) AS day_low, CAST(NULL AS DOUBLE) AS prev_close,
      TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume, 'USD' AS currency,
      CAST(ts AS TIMESTAMP) AS event_time, 'src' || CAST(user_id % 3 AS VARCHAR) AS source,
      CAST(ts AS TIMESTAMP) AS kafka_timestamp, CAST(event_id % 3 AS INTEGER) AS "partition",
      event_id AS "offset"
    FROM events"""


def lineitem_ticks_sql() -> str:
    return """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, l_extendedprice / l_quantity AS price,
      CAST(l_quantity AS BIGINT) AS volume, CAST(l_shipdate AS TIMESTAMP) AS event_time,
      'lineitem' AS source, l_orderkey AS "offset", CAST(l_linenumber AS INTEGER) AS "partition",
      l_orderkey * 8 + l_linenumber AS tick_order
    FROM lineitem"""


def dirty_sql(src: str = "ticks") -> str:
    return f"""SELECT CASE WHEN "offset" % {fx.NULL_SYMBOL_MOD} = 0 THEN NULL ELSE symbol END AS symbol,
      CASE WHEN "offset" % {fx.BAD_PRICE_MOD} = 0 THEN CAST(0.0 AS DOUBLE) ELSE price END AS price,
      CASE WHEN "offset" % {fx.NULL_VOLUME_MOD} = 0 THEN NULL
           WHEN "offset" % {fx.NEGATIVE_VOLUME_MOD} = 0 THEN CAST(-1 AS BIGINT) ELSE volume END AS volume,
      event_time, source, "offset"
    FROM {src}"""


def redelivered_sql(src: str = "ticks") -> str:
    return f"""SELECT * FROM {src}
    UNION ALL
    SELECT symbol, price, open, day_high, day_low, prev_close, volume, currency, event_time, source,
      kafka_timestamp + INTERVAL 1 MINUTE AS kafka_timestamp, "partition",
      "offset" + {fx.REDELIVER_OFFSET} AS "offset"
    FROM {src} WHERE "offset" % {fx.REDELIVER_MOD} = 0"""


def json_text_sql() -> str:
    p = "CAST(CAST(price AS DECIMAL(10,2)) AS VARCHAR)"
    return f"""CASE WHEN "offset" % {fx.JSON_GARBAGE_MOD} = 0 THEN 'not json' ELSE
      '{{"symbol":"' || symbol || '","price":' ||
      CASE WHEN "offset" % {fx.JSON_WRONG_TYPE_MOD} = 0 THEN '"' || {p} || '"' ELSE {p} END ||
      CASE WHEN "offset" % {fx.JSON_MISSING_KEY_MOD} = 0 THEN '' ELSE ',"volume":' || CAST(volume AS VARCHAR) END ||
      ',"currency":"USD","event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') ||
      '+00:00","source":"' || source || '"}}' END"""


def parsed_sql(src: str = "ticks") -> str:
    """What a permissive parse of the raw JSON yields, per defect rule."""
    g, wt, mk = fx.JSON_GARBAGE_MOD, fx.JSON_WRONG_TYPE_MOD, fx.JSON_MISSING_KEY_MOD
    garbage = f'"offset" % {g} = 0'
    return f"""SELECT CASE WHEN {garbage} THEN NULL ELSE symbol END AS symbol,
      CASE WHEN {garbage} OR "offset" % {wt} = 0 THEN NULL
           ELSE CAST(CAST(price AS DECIMAL(10,2)) AS DOUBLE) END AS price,
      open, day_high, day_low, prev_close,
      CASE WHEN {garbage} OR "offset" % {mk} = 0 THEN NULL ELSE volume END AS volume,
      CASE WHEN {garbage} THEN NULL ELSE currency END AS currency,
      CASE WHEN {garbage} THEN NULL ELSE event_time END AS event_time,
      CASE WHEN {garbage} THEN NULL ELSE source END AS source,
      {json_text_sql()} AS json_value,
      kafka_timestamp, "partition", "offset"
    FROM {src}"""


def quality_pred_sql() -> str:
    return "symbol IS NOT NULL AND price > 0 AND volume >= 0"


def silver_sql(src: str = "parsed") -> str:
    """Quality rules, keys present, earliest delivery per (symbol, event_time, source)."""
    return f"""SELECT * EXCLUDE (_rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol, event_time, source
                                   ORDER BY kafka_timestamp, "partition", "offset") AS _rn
      FROM {src} WHERE {quality_pred_sql()} AND event_time IS NOT NULL AND source IS NOT NULL)
    WHERE _rn = 1"""


def daily_sql(src: str = "ticks", order: str = "struct_pack(t := event_time, s := source)") -> str:
    return f"""SELECT symbol, CAST(event_time AS DATE) AS trade_date,
      arg_min(price, {order}) AS open_price, max(price) AS high_price, min(price) AS low_price,
      arg_max(price, {order}) AS close_price, CAST(sum(volume) AS BIGINT) AS total_volume,
      avg(price) AS avg_price, stddev_samp(price) AS volatility
    FROM {src} GROUP BY symbol, CAST(event_time AS DATE)"""


W_SYM = "PARTITION BY symbol ORDER BY trade_date"


def w_rows(n: int) -> str:
    return f"({W_SYM} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def gold_ctes(src: str = "ticks", order: str | None = None, period: int = 14) -> str:
    """CTEs daily, gold (12 gold columns) over the tick CTE ``src``."""
    daily = daily_sql(src) if order is None else daily_sql(src, order)
    return f"""daily AS ({daily}),
    lagged AS (SELECT *, lag(close_price) OVER ({W_SYM}) AS prev_close FROM daily),
    gl AS (SELECT *,
      CASE WHEN prev_close IS NOT NULL AND prev_close <> 0
           THEN ((close_price - prev_close) / prev_close) * 100 END AS pct_change,
      CASE WHEN close_price - prev_close > 0 THEN close_price - prev_close ELSE CAST(0.0 AS DOUBLE) END AS gain,
      CASE WHEN close_price - prev_close < 0 THEN -(close_price - prev_close) ELSE CAST(0.0 AS DOUBLE) END AS loss
      FROM lagged),
    avgs AS (SELECT *, avg(gain) OVER {w_rows(period)} AS avg_gain, avg(loss) OVER {w_rows(period)} AS avg_loss
      FROM gl),
    gold AS (SELECT symbol, trade_date, open_price, high_price, low_price, close_price, total_volume,
      avg_price, volatility, prev_close, pct_change,
      CASE WHEN avg_loss = 0 THEN CAST(100.0 AS DOUBLE) ELSE 100 - (100 / (1 + (avg_gain / avg_loss))) END AS rsi_14
      FROM avgs)"""


def with_gold(symbols: str = "event_type") -> str:
    return f"WITH ticks AS ({ticks_sql(symbols)}), {gold_ctes()}"


def with_snapped_gold(symbols: str = "event_type") -> str:
    """Gold as the serving fixtures load it: averages snapped to 8 decimals, so both engines cast the same doubles."""
    doubles = [c for c in GOLD_COLS if c in DOUBLE_COLS]
    snapped = ", ".join(f"{round_sql(q(c), 8)} AS {q(c)}" for c in doubles)
    return f"{with_gold(symbols)}, snapped AS (SELECT * REPLACE ({snapped}) FROM gold)"


def decimal_sql(expr: str, t) -> str:
    """The printed value rounded half away from zero, NULL on overflow.

    A direct cast of a double rounds the product of its binary value; the
    serving column takes the decimal number that the double prints as.
    """
    return f"TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL({t.precision},{t.scale}))"


def serving_fits_sql() -> str:
    """Every serving value fits its decimal type (NULL fits)."""
    return " AND ".join(f"({q(c)} IS NULL OR {decimal_sql(q(c), t)} IS NOT NULL)" for c, t in SERVING_TYPES.items())


def serving_typed_cols() -> str:
    out = [f"{decimal_sql(q(c), SERVING_TYPES[c])} AS {q(c)}" if c in SERVING_TYPES else q(c) for c in SERVING_COLS]
    return ", ".join(out)
