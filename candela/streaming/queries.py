"""Streaming queries: bronze/silver appends, windowed stats, keyed dedup merge.

Each ``start_*`` takes a streaming DataFrame and returns a started
StreamingQuery. ``trigger`` is a DataStreamWriter.trigger keyword dict:
{"processingTime": "15 seconds"} in production, {"availableNow": True} for
bounded runs (nightly bronze, tests).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candela.operators.ingest import bronze, decode_envelope, parse_ticks
from candela.operators.quality import dedup, quality_filter, silver_predicate
from candela.operators.window_stats import WATERMARK, stats_json, window_stats
from candela.schema import DEDUP_KEYS, LINEAGE_COLS, TICK_COLS, TOPIC_PROCESSED, WINDOW_STATS_COLS
from candela.session import remove_path, scratch_path, session_conf
from candela.sources.lake import write_partitioned

# Fixed values that must equal the reference: default trigger intervals.
SILVER_STREAM_TRIGGER = {"processingTime": "15 seconds"}
BRONZE_STREAM_TRIGGER = {"processingTime": "30 seconds"}
STREAM_SILVER_COLS = TICK_COLS + ["kafka_timestamp"]


def clean_ticks(envelope: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Decode → parse → quality filter → event-time watermark.

    The watermark only bounds the state of downstream aggregations; stateless
    sinks of this stream drop nothing.
    """
    parsed = parse_ticks(decode_envelope(envelope)).drop("json_value")
    return quality_filter(parsed).withWatermark("event_time", watermark)


def _writer(df: DataFrame, checkpoint: str, trigger: dict | None, mode: str):
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    return w.trigger(**(trigger or SILVER_STREAM_TRIGGER))


def start_silver_sink(
    clean: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None
) -> StreamingQuery:
    """Append cleaned ticks, partitioned by symbol (stateless: no late drop)."""
    w = _writer(clean.select(*STREAM_SILVER_COLS), checkpoint, trigger or SILVER_STREAM_TRIGGER, "append")
    return w.format(fmt).partitionBy("symbol").option("path", path).start()


def start_bronze_sink(
    envelope: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None
) -> StreamingQuery:
    """Append every record as received: parsed fields, raw payload, lineage, ingestion time."""
    w = _writer(bronze(envelope), checkpoint, trigger or BRONZE_STREAM_TRIGGER, "append")
    return w.format(fmt).partitionBy("symbol").option("path", path).start()


def _batch_log_writer(path: str):
    """foreachBatch body: each micro-batch lands in its own batch_id folder.

    Overwriting that folder makes a retried batch idempotent.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def start_window_stats(
    clean: DataFrame,
    checkpoint: str,
    path: str,
    mode: str = "update",
    trigger: dict | None = None,
) -> StreamingQuery:
    """1-minute stats per symbol under the watermark.

    update: every trigger re-emits the windows it changed into a batch log
    (read the current value with ``latest_window_stats``); append: a window is
    written once, after the watermark passes its end.
    """
    stats = window_stats(clean)
    w = _writer(stats, checkpoint, trigger, mode)
    if mode == "append":
        return w.format("parquet").option("path", path).start()
    return w.foreachBatch(_batch_log_writer(path)).start()


def start_stats_messages(
    clean: DataFrame,
    checkpoint: str,
    brokers: str | None = None,
    topic: str = TOPIC_PROCESSED,
    path: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keyed JSON messages (key = symbol) in update mode: to Kafka when brokers are
    given, otherwise into a batch log at ``path``."""
    msgs = stats_json(window_stats(clean))
    w = _writer(msgs, checkpoint, trigger, "update")
    if brokers:
        return w.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).start()
    if not path:
        raise ValueError("either brokers or path is required")
    return w.foreachBatch(_batch_log_writer(path)).start()


def latest_by_key(log: DataFrame, keys: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Current value per key from an update log: the row of the highest batch_id.

    A partial aggregate, so a key updated in every batch still reaches the
    shuffle as one row per map task.
    """
    picked = log.groupBy(*keys).agg(F.max_by(F.struct(*value_cols), F.col("batch_id").cast("bigint")).alias("_v"))
    return picked.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in value_cols])


def latest_window_stats(spark: SparkSession, path: str, min_batch_id: int | None = None) -> DataFrame:
    """Current stats per (symbol, window) from the update log.

    Windows behind the watermark never change again, so a consumer that has
    folded earlier batches passes ``min_batch_id``; the filter on the
    ``batch_id`` partition column prunes the older folders.
    """
    log = spark.read.parquet(path)
    if min_batch_id is not None:
        log = log.filter(F.col("batch_id").cast("bigint") >= min_batch_id)
    keys = ["symbol", "window_start"]
    return latest_by_key(log, keys, [c for c in WINDOW_STATS_COLS if c not in keys]).select(*WINDOW_STATS_COLS)


def compact_log(
    spark: SparkSession, path: str, keys: dict[str, Column], value_cols: Sequence[str], up_to: int | None = None
) -> int | None:
    """Fold an update log's batches up to ``up_to`` (the last but one) into that batch; returns it (None: nothing to fold).

    The folded rows, the newest per key, are added to that batch's folder by one
    write, and only then do the older folders go. A reader, or a crash, in
    between sees some rows twice, never one less, and takes one a key anyway. The
    last batch is left alone: a stream that starts again may write it anew.
    """
    log = spark.read.parquet(path)
    batches = sorted(int(r.batch_id) for r in log.select("batch_id").distinct().collect())  # one number a folder
    if up_to is None:
        up_to = batches[-2] if len(batches) > 1 else None
    elif up_to >= batches[-1]:
        raise ValueError(f"batch {batches[-1]} may be written again and can't be folded")
    if up_to is None or batches[0] == up_to:
        return None
    own = log.filter(F.col("batch_id").cast("bigint") <= up_to).withColumns({f"_key_{k}": c for k, c in keys.items()})
    newest = latest_by_key(own, [f"_key_{k}" for k in keys], value_cols).select(*value_cols)
    staging = scratch_path(spark, "log_compaction")
    newest.write.parquet(staging)
    spark.read.schema(newest.schema).parquet(staging).write.mode("append").parquet(f"{path}/batch_id={up_to}")
    for batch in batches:
        if batch < up_to:
            remove_path(spark, f"{path}/batch_id={batch}")
    remove_path(spark, staging)
    return up_to


def compact_window_stats(spark: SparkSession, path: str, up_to: int | None = None) -> int | None:
    """Compact the log of ``start_window_stats``; ``latest_window_stats`` gives the same before, meanwhile and after."""
    keys = {"symbol": F.col("symbol"), "window_start": F.col("window_start")}
    return compact_log(spark, path, keys, WINDOW_STATS_COLS, up_to)


def compact_stats_messages(spark: SparkSession, path: str, up_to: int | None = None) -> int | None:
    """Compact the message log of ``start_stats_messages`` to the newest message per key and window."""
    keys = {"key": F.col("key"), "window": F.get_json_object("value", "$.window_start")}
    return compact_log(spark, path, keys, ["key", "value"], up_to)


def stored_keys(
    spark: SparkSession,
    silver_path: str,
    schema,
    lo,
    hi,
    keys: Sequence[str] = DEDUP_KEYS,
    partition_by=("symbol",),
    days: Sequence | None = None,
) -> DataFrame:
    """Keys already in silver for the event-time span [lo, hi], on the given days if any.

    With ``event_date`` among the partition columns the days (or the span)
    prune whole partitions; otherwise the span skips row groups by their
    event_time statistics.
    """
    stored = spark.read.schema(schema).parquet(silver_path)
    if "event_date" in partition_by and days is not None:
        stored = stored.filter(F.col("event_date").isin(list(days)))
    elif "event_date" in partition_by:
        stored = stored.filter(F.col("event_date").between(F.to_date(F.lit(lo)), F.to_date(F.lit(hi))))
    return stored.filter(F.col("event_time").between(F.lit(lo), F.lit(hi))).select(*keys)


def silver_merge_batch(
    silver_path: str, keys: Sequence[str] = DEDUP_KEYS, partition_by: Sequence[str] = ("symbol", "event_date")
):
    """foreachBatch body: insert-only merge of a micro-batch into silver.

    The batch is deduplicated (earliest delivery wins), then anti-joined with
    the silver keys of the batch's event-time span, so a redelivered copy
    arriving in a later batch is dropped, and a retried batch inserts nothing
    twice. With ``event_date`` (derived from event_time) among the partition
    columns the lookup reads just the batch's own days, so one late tick does
    not stretch it over all days in between.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clean = batch.filter(silver_predicate(batch.columns))
        fresh = dedup(clean.select(*TICK_COLS, *LINEAGE_COLS))
        if "event_date" in partition_by:
            fresh = fresh.withColumn("event_date", F.to_date("event_time"))
        fresh = fresh.persist()
        try:
            span = fresh.agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi")).first()
            if span is None or span.lo is None:
                return
            days = None
            if "event_date" in partition_by:
                days = [r.event_date for r in fresh.select("event_date").distinct().collect()]  # calendar days of one batch
            existing = stored_keys(spark, silver_path, fresh.schema, span.lo, span.hi, keys, partition_by, days)
            new_rows = fresh.join(existing, list(keys), "left_anti")
            # A stream's session plans without adaptive execution, and tasks that each hold
            # rows of every folder would write a file a task and folder.
            with session_conf(spark, {"spark.sql.adaptive.enabled": "true"}):
                write_partitioned(new_rows, silver_path, partition_by, mode="append")
        finally:
            fresh.unpersist()

    return merge


def init_table(spark: SparkSession, path: str, schema) -> None:
    """Create an empty table location so the first merge can read it."""
    spark.createDataFrame([], schema).write.mode("append").parquet(path)


def start_silver_dedup(
    bronze_stream: DataFrame,
    silver_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    partition_by: Sequence[str] = ("symbol", "event_date"),
) -> StreamingQuery:
    spark = bronze_stream.sparkSession
    parsed = parse_ticks(decode_envelope(bronze_stream)).drop("json_value")
    schema = parsed.select(*TICK_COLS, *LINEAGE_COLS)
    if "event_date" in partition_by:
        schema = schema.withColumn("event_date", F.to_date("event_time"))
    init_table(spark, silver_path, schema.schema)
    merge = silver_merge_batch(silver_path, partition_by=partition_by)
    return _writer(parsed, checkpoint, trigger, "append").foreachBatch(merge).start()


def start_silver_dedup_within_watermark(
    envelope: DataFrame, path: str, checkpoint: str, delay: str = WATERMARK, trigger: dict | None = None
) -> StreamingQuery:
    """Lighter DED2 variant: ``dropDuplicatesWithinWatermark`` on the dedup keys.

    State is bounded by the delay, but a copy arriving more than ``delay``
    after its original is kept, and the first copy *seen* wins (not the
    earliest delivered) — use ``start_silver_dedup`` when exactness matters.
    """
    parsed = parse_ticks(decode_envelope(envelope)).drop("json_value")
    parsed = parsed.filter(silver_predicate(parsed.columns))
    deduped = parsed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(DEDUP_KEYS))
    w = _writer(deduped.select(*TICK_COLS, *LINEAGE_COLS), checkpoint, trigger, "append")
    return w.format("parquet").partitionBy("symbol").option("path", path).start()


def await_all(spark: SparkSession, queries: Sequence[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Block until any of ``queries`` ends, then stop the others; raise if one failed.

    Watches the given queries only (the session-wide awaitAnyTermination also
    returns for queries that ended earlier in the same session).
    """
    del spark  # kept for signature symmetry with the session-level wait
    while all(q.isActive for q in queries):
        try:
            queries[0].awaitTermination(poll_seconds)
        except StreamingQueryException:
            break
    failed = [q for q in queries if q.exception() is not None]
    for q in queries:
        if q.isActive:
            q.stop()
    if failed:
        raise RuntimeError(f"stream {failed[0].name or failed[0].id} failed: {failed[0].exception()}")
