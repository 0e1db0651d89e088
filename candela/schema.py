"""Table schemas and fixed names of the tick pipeline."""

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Fixed values that must equal the reference: topic names, the tick fields,
# which fields are required, and the JSON type of each field.
TOPIC_RAW = "finance-raw-stream"
TOPIC_PROCESSED = "finance-processed-stream"
REQUIRED_FIELDS = ("symbol", "price", "volume", "event_time", "source")
FIELD_JSON_TYPES = {
    "symbol": "string",
    "price": "number",
    "open": "number",
    "day_high": "number",
    "day_low": "number",
    "prev_close": "number",
    "volume": "number",
    "currency": "string",
    "event_time": "string",
    "source": "string",
}

# Parsed tick. nullable=False documents intent; from_json does not enforce it,
# so non-null is an explicit filter in operators.quality.
TICK = StructType(
    [
        StructField("symbol", StringType(), False),
        StructField("price", DoubleType(), False),
        StructField("open", DoubleType(), True),
        StructField("day_high", DoubleType(), True),
        StructField("day_low", DoubleType(), True),
        StructField("prev_close", DoubleType(), True),
        StructField("volume", LongType(), True),
        StructField("currency", StringType(), True),
        StructField("event_time", TimestampType(), False),
        StructField("source", StringType(), False),
    ]
)
TICK_COLS = [f.name for f in TICK.fields]

# The record shape of a Kafka source (and of file replays standing in for it).
ENVELOPE = StructType(
    [
        StructField("key", StringType(), True),
        StructField("value", BinaryType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("timestamp", TimestampType(), True),
    ]
)

LINEAGE_COLS = ["kafka_timestamp", "partition", "offset"]
BRONZE_COLS = TICK_COLS + ["json_value"] + LINEAGE_COLS + ["_ingested_at"]
SILVER_COLS = TICK_COLS + ["_ingested_at"]

_NULLABLE_TICK = [StructField(f.name, f.dataType, True) for f in TICK.fields]
_INGESTED = StructField("_ingested_at", TimestampType(), True)
BRONZE = StructType(
    [
        *_NULLABLE_TICK,
        StructField("json_value", StringType(), True),
        StructField("kafka_timestamp", TimestampType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        _INGESTED,
    ]
)
SILVER = StructType([*_NULLABLE_TICK, _INGESTED])
DEDUP_KEYS = ["symbol", "event_time", "source"]

# Fixed values that must equal the reference: window statistics and gold columns.
WINDOW_STATS_COLS = [
    "symbol",
    "window_start",
    "window_end",
    "avg_price",
    "max_price",
    "min_price",
    "volatility",
    "tick_count",
]

GOLD = StructType(
    [
        StructField("symbol", StringType(), True),
        StructField("trade_date", DateType(), True),
        StructField("open_price", DoubleType(), True),
        StructField("high_price", DoubleType(), True),
        StructField("low_price", DoubleType(), True),
        StructField("close_price", DoubleType(), True),
        StructField("total_volume", LongType(), True),
        StructField("avg_price", DoubleType(), True),
        StructField("volatility", DoubleType(), True),
        StructField("prev_close", DoubleType(), True),
        StructField("pct_change", DoubleType(), True),
        StructField("rsi_14", DoubleType(), True),
    ]
)
GOLD_COLS = [f.name for f in GOLD.fields]
GOLD_KEYS = ["symbol", "trade_date"]

# Mergeable daily state (operators.gold.STATE_COLS) as the state log stores it.
DAILY_STATE = StructType(
    [
        StructField("symbol", StringType(), True),
        StructField("trade_date", DateType(), True),
        StructField("first_time", TimestampType(), True),
        StructField("first_by", StringType(), True),
        StructField("open_price", DoubleType(), True),
        StructField("last_time", TimestampType(), True),
        StructField("last_by", StringType(), True),
        StructField("close_price", DoubleType(), True),
        StructField("high_price", DoubleType(), True),
        StructField("low_price", DoubleType(), True),
        StructField("total_volume", LongType(), True),
        StructField("n", LongType(), True),
        StructField("price_sum", DoubleType(), True),
        StructField("m2", DoubleType(), True),
    ]
)

# Fixed values that must equal the reference: the serving table's columns in
# their order (gold without prev_close), its decimal types and text length limits.
SERVING_COLS = [
    "symbol",
    "trade_date",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "total_volume",
    "avg_price",
    "volatility",
    "pct_change",
    "rsi_14",
]
SERVING_TYPES = {
    "open_price": DecimalType(12, 4),
    "high_price": DecimalType(12, 4),
    "low_price": DecimalType(12, 4),
    "close_price": DecimalType(12, 4),
    "avg_price": DecimalType(12, 4),
    "volatility": DecimalType(12, 6),
    "pct_change": DecimalType(8, 4),
    "rsi_14": DecimalType(6, 2),
}
SERVING = StructType(
    [StructField(c, SERVING_TYPES.get(c, GOLD[c].dataType), True) for c in SERVING_COLS]
    + [StructField("loaded_at", TimestampType(), True)]
)
SYMBOL_MAX_LEN = 10
CURRENCY_MAX_LEN = 8
SOURCE_MAX_LEN = 32

STAGING_TICK_TYPES = {
    "price": DecimalType(12, 4),
    "open_price": DecimalType(12, 4),
    "day_high": DecimalType(12, 4),
    "day_low": DecimalType(12, 4),
    "prev_close": DecimalType(12, 4),
}
STAGING_COLS = [
    "id",
    "symbol",
    "price",
    "open_price",
    "day_high",
    "day_low",
    "prev_close",
    "volume",
    "currency",
    "event_time",
    "source",
]
