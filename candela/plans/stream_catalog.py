"""Streaming entries of the query catalogue.

Each query replays the envelope fixture (derived from ``events``) in four
delivery-time chunks through a real Structured Streaming query, restarting
from its checkpoint after each chunk, and returns what the sink holds. The
oracle is the batch SQL of the same result; that of ``stream_late_drop`` uses
the replay's fixed chunk boundaries, which decide its outcome.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from candela.plans import sqlparts as S
from candela.plans.catalog import _SILVER, _TICKS, canon, query, ticks, window_stats_sql
from candela.schema import BRONZE_COLS, WINDOW_STATS_COLS
from candela.session import scratch_path, session_conf
from candela.sources import fixtures as fx
from candela.streaming import late, topic_log
from candela.streaming import queries as P
from candela.streaming.keyed_state import ROCKSDB, start_silver_dedup_state
from candela.streaming.replay import DAY_BOUNDS, chunks, replay

BOUNDED = {"availableNow": True}
_PARSED = f"{_TICKS}, parsed AS ({S.parsed_sql()})"
_CLEAN = f"{_PARSED}, clean AS (SELECT * FROM parsed WHERE {S.quality_pred_sql()})"


def _envelope(spark, sf, redelivered: bool = False):
    t = ticks(spark, sf)
    if redelivered:
        t = fx.redelivered_ticks(t)
    return fx.envelope_from_ticks(t)


_BRONZE_OUT = [c for c in BRONZE_COLS if c != "_ingested_at"]


@query("stream_bronze_append", f"{_PARSED} " + S.canon_select(_BRONZE_OUT, "parsed"))
def q_stream_bronze_append(spark, sf):
    out = scratch_path(spark, "bronze")
    replay(spark, _envelope(spark, sf), lambda s, ck: P.start_bronze_sink(s, out, ck, trigger=BOUNDED))
    return canon(spark.read.parquet(out).select(*_BRONZE_OUT))


@query("stream_silver_append", f"{_CLEAN} " + S.canon_select(P.STREAM_SILVER_COLS, "clean"))
def q_stream_silver_append(spark, sf):
    out = scratch_path(spark, "silver")
    replay(spark, _envelope(spark, sf), lambda s, ck: P.start_silver_sink(P.clean_ticks(s), out, ck, trigger=BOUNDED))
    return canon(spark.read.parquet(out).select(*P.STREAM_SILVER_COLS))


@query(
    "stream_silver_dedup",
    f"{_SILVER} " + S.canon_select(["symbol", "event_time", "source", "offset"], "silver"),
)
def q_stream_silver_dedup(spark, sf):
    out = scratch_path(spark, "silver")
    replay(spark, _envelope(spark, sf, redelivered=True), lambda s, ck: P.start_silver_dedup(s, out, ck, trigger=BOUNDED))
    return canon(spark.read.parquet(out).select("symbol", "event_time", "source", "offset"))


@query(
    "stream_silver_dedup_state",
    f"{_SILVER} " + S.canon_select(["symbol", "event_time", "source", "offset"], "silver"),
)
def q_stream_silver_dedup_state(spark, sf):
    """Deduplication by keyed state with timers; the replay delivers in order, so a day's horizon covers every copy."""
    out = scratch_path(spark, "silver")
    with session_conf(spark, ROCKSDB):
        replay(
            spark,
            _envelope(spark, sf, redelivered=True),
            lambda s, ck: start_silver_dedup_state(s, out, ck, trigger=BOUNDED, bucket="1 day"),
        )
    return canon(spark.read.parquet(out).select("symbol", "event_time", "source", "offset"))


_WS_SQL = f"{_CLEAN}, ws AS ({window_stats_sql('clean')}) "


@query("stream_window_stats_update", _WS_SQL + S.canon_select(WINDOW_STATS_COLS, "ws"))
def q_stream_window_stats_update(spark, sf):
    out = scratch_path(spark, "stats_log")
    replay(
        spark,
        _envelope(spark, sf),
        lambda s, ck: P.start_window_stats(P.clean_ticks(s), ck, out, mode="update", trigger=BOUNDED),
    )
    return canon(P.latest_window_stats(spark, out))


@query(
    "stream_window_stats_append",
    _WS_SQL
    + S.canon_select(
        WINDOW_STATS_COLS,
        "ws",
        "WHERE window_end <= (SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 5 MINUTE FROM clean)",
    ),
)
def q_stream_window_stats_append(spark, sf):
    out = scratch_path(spark, "stats")
    replay(
        spark,
        _envelope(spark, sf),
        lambda s, ck: P.start_window_stats(P.clean_ticks(s), ck, out, mode="append", trigger=BOUNDED),
    )
    return canon(spark.read.parquet(out).select(*WINDOW_STATS_COLS))


_JSON_COLS = ["key"] + WINDOW_STATS_COLS


@query(
    "stream_stats_json",
    _WS_SQL + S.canon_select(_JSON_COLS, "(SELECT symbol AS key, * FROM ws)"),
)
def q_stream_stats_json(spark, sf):
    out = scratch_path(spark, "stats_json")
    replay(
        spark,
        _envelope(spark, sf),
        lambda s, ck: P.start_stats_messages(P.clean_ticks(s), ck, path=out, trigger=BOUNDED),
    )
    schema = "symbol string, window_start timestamp, window_end timestamp, avg_price double, " \
        "max_price double, min_price double, volatility double, tick_count bigint"
    log = spark.read.parquet(out).select("key", "batch_id", F.from_json("value", schema).alias("v")).select(
        "key", "batch_id", "v.*"
    )
    latest = P.latest_by_key(log, ["key", "window_start"], [c for c in WINDOW_STATS_COLS if c != "window_start"])
    return canon(latest.select(*_JSON_COLS))


_LATE_SQL = (
    f"{_CLEAN}, first_delivered AS (SELECT * FROM clean WHERE kafka_timestamp >= TIMESTAMP '{DAY_BOUNDS[-1]}'), "
    f"ws AS ({window_stats_sql('first_delivered')}) " + S.canon_select(WINDOW_STATS_COLS, "ws")
)


@query("stream_late_drop", _LATE_SQL)
def q_stream_late_drop(spark, sf):
    """Reversed delivery: the first chunk delivered (the latest days) moves the
    watermark past everything delivered after it, so the stateful aggregation
    drops those chunks whole; the surviving windows are exactly the stats of
    the first delivered chunk (the replay's chunk boundaries are fixed)."""
    out = scratch_path(spark, "stats_log")
    replay(
        spark,
        _envelope(spark, sf),
        lambda s, ck: P.start_window_stats(P.clean_ticks(s), ck, out, mode="update", trigger=BOUNDED),
        reverse=True,
    )
    return canon(P.latest_window_stats(spark, out))


_LATE_COLS = ["symbol", "event_time", "source", "price", "volume", "watermark"]


def _late_split(spark, sf) -> str:
    """The reversed replay through the late split: all but the first delivered chunk is behind its watermark."""
    out = scratch_path(spark, "late_split")
    replay(spark, _envelope(spark, sf), lambda s, ck: late.start_late_split(P.clean_ticks(s), out, ck, trigger=BOUNDED), reverse=True)
    return out


@query(
    "late_rows",
    f"""{_CLEAN}, mark AS (SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 5 MINUTE AS watermark FROM clean),
      late AS (SELECT clean.*, mark.watermark FROM clean, mark WHERE kafka_timestamp < TIMESTAMP '{DAY_BOUNDS[-1]}')
    """
    + f"SELECT {', '.join(S.canon_col(c) for c in _LATE_COLS[:-1])}, strftime(watermark, '{S.TS_FORMAT_SQL}') AS watermark FROM late",
)
def q_late_rows(spark, sf):
    """Ticks behind the watermark, kept in the side table with the watermark they missed."""
    return canon(late.late_rows(spark, _late_split(spark, sf)).select(*_LATE_COLS))


@query(
    "late_accounting",
    f"""{_CLEAN} SELECT 'input' AS kind, count(*) AS n FROM clean
    UNION ALL SELECT 'windows', count(*) FROM clean WHERE kafka_timestamp >= TIMESTAMP '{DAY_BOUNDS[-1]}'
    UNION ALL SELECT 'late', count(*) FROM clean WHERE kafka_timestamp < TIMESTAMP '{DAY_BOUNDS[-1]}'""",
)
def q_late_accounting(spark, sf):
    """Input = windows + late."""
    return late.window_accounting(spark, _late_split(spark, sf))


@query("stream_topic_log", f"{_PARSED} " + S.canon_select(_BRONZE_OUT, "parsed"))
def q_stream_topic_log(spark, sf):
    """Bronze from a landed topic log: a segment a chunk, each read from the positions in the checkpoint."""
    root, out, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    for part in chunks(_envelope(spark, sf)):
        topic_log.append_segment(part, root)
        q = P.start_bronze_sink(topic_log.topic_log(spark, root, "earliest", True, 8), out, checkpoint, trigger=BOUNDED)
        q.awaitTermination()
    return canon(spark.read.parquet(out).select(*_BRONZE_OUT))


@query(
    "stream_message_log",
    _WS_SQL
    + S.canon_select(
        _JSON_COLS,
        "(SELECT symbol AS key, * FROM ws)",
        "WHERE window_end <= (SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 5 MINUTE FROM clean)",
    ),
)
def q_stream_message_log(spark, sf):
    """The message of every closed window, committed once an epoch."""
    from candela.operators.window_stats import stats_json, window_stats

    out = scratch_path(spark, "messages")
    replay(spark, _envelope(spark, sf), lambda s, ck: topic_log.start_message_log(stats_json(window_stats(P.clean_ticks(s))), out, ck, BOUNDED))
    schema = "symbol string, window_start timestamp, window_end timestamp, avg_price double, " \
        "max_price double, min_price double, volatility double, tick_count bigint"
    rows = topic_log.committed_messages(spark, out).select("key", F.from_json("value", schema).alias("v")).select("key", "v.*")
    return canon(rows.select(*_JSON_COLS))
