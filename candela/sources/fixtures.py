"""Tick-shaped inputs derived by Spark from the driver tables.

Every fixture is a pure projection of a driver table, so its size grows with
the table and the same derivation is expressible in plain SQL for the oracle.

Fixed mapping (tick column ← events column):
    symbol      ← event_type (dense: every symbol trades every day)
                  or 'U' || user_id (sparse user symbols)
    price       ← value
    volume      ← props.$.k as BIGINT
    event_time  ← ts as TIMESTAMP (session zone UTC)
    source      ← 'src' || (user_id % 3)
    currency    ← 'USD'
    open, day_high, day_low, prev_close ← NULL
    offset / partition / kafka_timestamp ← event_id / event_id % 3 / ts
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.schema import TOPIC_RAW

# Fixed defect-injection rules of the dirty fixtures (divisors of the event id).
BAD_PRICE_MOD = 97
NULL_VOLUME_MOD = 89
NULL_SYMBOL_MOD = 101
NEGATIVE_VOLUME_MOD = 83
REDELIVER_MOD = 10
REDELIVER_OFFSET = 10_000_000
JSON_WRONG_TYPE_MOD = 31
JSON_MISSING_KEY_MOD = 37
JSON_GARBAGE_MOD = 41

def _null_double() -> Column:
    return F.lit(None).cast("double")


def _events_symbol(mode: str) -> Column:
    if mode == "event_type":
        return F.col("event_type")
    if mode == "user":
        return F.concat(F.lit("U"), F.col("user_id").cast("string"))
    raise ValueError(f"unknown symbol mode {mode!r}")


def ticks_from_events(events: DataFrame, symbols: str = "event_type") -> DataFrame:
    """Tick rows with lineage columns (kafka_timestamp, partition, offset)."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        _events_symbol(symbols).alias("symbol"),
        F.col("value").alias("price"),
        _null_double().alias("open"),
        _null_double().alias("day_high"),
        _null_double().alias("day_low"),
        _null_double().alias("prev_close"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("volume"),
        F.lit("USD").alias("currency"),
        ts.alias("event_time"),
        F.concat(F.lit("src"), (F.col("user_id") % 3).cast("string")).alias("source"),
        ts.alias("kafka_timestamp"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


# Order of lineitem ticks inside a day: all share the ship date, and
# (l_orderkey, l_linenumber) is the table's key; an order has at most 7 lines.
LINEITEM_ORDER = ("tick_order",)


def ticks_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Second, larger tick source: one supplier = one symbol, ship date = time.

    Lineage: offset = l_orderkey, partition = l_linenumber; ``tick_order``
    packs both, and is the open/close ordering (``LINEITEM_ORDER``).
    """
    ts = F.col("l_shipdate").cast("timestamp")
    return lineitem.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        _null_double().alias("open"),
        _null_double().alias("day_high"),
        _null_double().alias("day_low"),
        _null_double().alias("prev_close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.lit("USD").alias("currency"),
        ts.alias("event_time"),
        F.lit("lineitem").alias("source"),
        ts.alias("kafka_timestamp"),
        F.col("l_linenumber").cast("int").alias("partition"),
        F.col("l_orderkey").alias("offset"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("tick_order"),
    )


def dirty_ticks(ticks: DataFrame) -> DataFrame:
    """Ticks with injected quality defects (bad price, NULL/negative volume, NULL symbol)."""
    off = F.col("offset")
    return ticks.withColumns(
        {
            "price": F.when(off % BAD_PRICE_MOD == 0, F.lit(0.0)).otherwise(F.col("price")),
            "volume": F.when(off % NULL_VOLUME_MOD == 0, F.lit(None).cast("bigint"))
            .when(off % NEGATIVE_VOLUME_MOD == 0, F.lit(-1).cast("bigint"))
            .otherwise(F.col("volume")),
            "symbol": F.when(off % NULL_SYMBOL_MOD == 0, F.lit(None).cast("string")).otherwise(
                F.col("symbol")
            ),
        }
    )


def redelivered_ticks(ticks: DataFrame) -> DataFrame:
    """At-least-once delivery: every 10th message arrives twice, one minute later."""
    copies = ticks.filter(F.col("offset") % REDELIVER_MOD == 0).withColumns(
        {
            "offset": F.col("offset") + REDELIVER_OFFSET,
            "kafka_timestamp": F.col("kafka_timestamp") + F.expr("INTERVAL 1 MINUTE"),
        }
    )
    return ticks.unionByName(copies)


def _json_text(ticks: DataFrame) -> Column:
    off = F.col("offset")
    price_txt = F.col("price").cast("decimal(10,2)").cast("string")
    price_json = F.when(off % JSON_WRONG_TYPE_MOD == 0, F.concat(F.lit('"'), price_txt, F.lit('"'))).otherwise(
        price_txt
    )
    volume_json = F.when(off % JSON_MISSING_KEY_MOD == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"volume":'), F.col("volume").cast("string"))
    )
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    body = F.concat(
        F.lit('{"symbol":"'),
        F.col("symbol"),
        F.lit('","price":'),
        price_json,
        volume_json,
        F.lit(',"currency":"USD","event_time":"'),
        iso,
        F.lit('","source":"'),
        F.col("source"),
        F.lit('"}'),
    )
    return F.when(off % JSON_GARBAGE_MOD == 0, F.lit("not json")).otherwise(body)


def envelope_from_ticks(ticks: DataFrame) -> DataFrame:
    """Kafka-shaped records (key, value, topic, partition, offset, timestamp).

    The JSON payload is built by concatenation from a DECIMAL(10,2) price, an
    integer volume and an ISO-8601 time, and carries three kinds of defects:
    price as a JSON string, a missing volume key, and a non-JSON payload.
    """
    return ticks.select(
        F.col("symbol").alias("key"),
        _json_text(ticks).cast("binary").alias("value"),
        F.lit(TOPIC_RAW).alias("topic"),
        F.col("partition"),
        F.col("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )
