"""Argument-driven jobs: stream, bronze, validate, silver, gold, serve, nightly, compact.

    python -m candela.plans.jobs stream  --kafka-broker HOST:9092 --output-path P --checkpoint-path C
    python -m candela.plans.jobs bronze  --source-path LANDING --output-path P --checkpoint-path C --available-now
    python -m candela.plans.jobs validate --input-path BRONZE --invalid-path INVALID
    python -m candela.plans.jobs silver  --input-path BRONZE --output-path SILVER [--since TIME]
    python -m candela.plans.jobs silver_stream --source-path LANDING --output-path SILVER --checkpoint-path C
    python -m candela.plans.jobs gold    --input-path SILVER --output-path GOLD [--incremental-from DATE] [--state-path STATES]
    python -m candela.plans.jobs serve   --input-path GOLD --serving-path T --rejects-path R --run-date D
    python -m candela.plans.jobs nightly --root ROOT --source-path LANDING --run-date D [--since TIME] [--register PREFIX]
    python -m candela.plans.jobs compact --stats-path LOG --state-path STATES

Paths may be any Hadoop-compatible URI; --storage-format is parquet or delta.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from candela.operators import daily_state, ingest, publication, quality, serving
from candela.operators import gold as G
from candela.schema import (
    BRONZE,
    DEDUP_KEYS,
    GOLD,
    GOLD_COLS,
    GOLD_KEYS,
    LINEAGE_COLS,
    SERVING,
    SILVER,
    SILVER_COLS,
    TICK_COLS,
)
from candela.session import build_session, ensure_utc, remove_path, scratch_path
from candela.sources.lake import register_table, scan, write_partitioned, write_partitions_dynamic
from candela.streaming import queries as P
from candela.streaming.sources import file_source, kafka_source


def _envelope_stream(spark: SparkSession, args):
    if args.source_path:
        return file_source(spark, args.source_path, args.max_files_per_trigger)
    return kafka_source(
        spark,
        args.kafka_broker,
        starting_offsets=args.starting_offsets,
        fail_on_data_loss=args.fail_on_data_loss,
        min_partitions=args.min_partitions,
    )


def _trigger(args, default_seconds: int) -> dict:
    if args.available_now:
        return {"availableNow": True}
    return {"processingTime": f"{args.trigger_seconds or default_seconds} seconds"}


def run_stream(spark: SparkSession, args) -> None:
    """Cleaned stream → silver files + 1-minute stats messages; fail if either dies."""
    clean = P.clean_ticks(_envelope_stream(spark, args))
    trig = _trigger(args, 15)
    silver_q = P.start_silver_sink(clean, args.output_path, args.checkpoint_path, args.storage_format, trig)
    stats_q = P.start_stats_messages(
        clean,
        args.checkpoint_path + "_kafka",
        brokers=args.kafka_broker if not args.stats_path else None,
        path=args.stats_path,
        trigger=trig,
    )
    if args.available_now:
        for q in (silver_q, stats_q):
            q.awaitTermination()
        return
    P.await_all(spark, [silver_q, stats_q])


def run_bronze(spark: SparkSession, args) -> None:
    q = P.start_bronze_sink(
        _envelope_stream(spark, args), args.output_path, args.checkpoint_path, args.storage_format, _trigger(args, 30)
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_silver_stream(spark: SparkSession, args) -> None:
    """Silver as a stream: exact insert-only dedup merge of each micro-batch."""
    parts = ("symbol", "event_date") if args.partition_by_date else ("symbol",)
    q = P.start_silver_dedup(
        _envelope_stream(spark, args), args.output_path, args.checkpoint_path, _trigger(args, 15), parts
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _since(df, args):
    """Rows ingested since ``--since`` (all without it)."""
    since = getattr(args, "since", None)
    return df if not since else df.filter(F.col("_ingested_at") >= F.lit(since).cast("timestamp"))


def run_validate(spark: SparkSession, args) -> None:
    """Bronze payloads that break the message contract, with their errors, to the invalid path."""
    bronze_df = _since(scan(spark, args.input_path, args.storage_format, BRONZE), args)
    _, invalid = ingest.split_valid(bronze_df.select("json_value", *LINEAGE_COLS, "_ingested_at"))
    invalid.drop("is_valid").write.format(args.storage_format).mode("overwrite").save(args.invalid_path)


def run_silver(spark: SparkSession, args) -> None:
    """Bronze → silver and its rejects in one pass over bronze, with the accounting of that pass.

    Bronze is judged once and staged: accepted rows with the columns silver
    needs, refused ones whole. Silver and the rejects (always written, so nothing
    goes unseen) are made from the staging, and ``<output>_accounting`` says where
    every row went. With ``--since`` only bronze rows ingested since then are
    read, and rows whose key silver has already are left out, so running it
    again adds nothing.
    """
    if args.input_path.rstrip("/") == args.output_path.rstrip("/"):
        raise ValueError("silver must not overwrite the bronze path it reads")
    output, fmt = args.output_path.rstrip("/"), args.storage_format
    observation = Observation("silver")
    rows = quality.judged(_since(scan(spark, args.input_path, fmt, BRONZE), args), observation)
    rejected = F.size("reasons") > 0
    rows = rows.withColumn("json_value", F.when(rejected, F.col("json_value"))).withColumn("_rejected", rejected)
    staging = scratch_path(spark, "silver_staging")
    rows.write.partitionBy("_rejected").parquet(staging)
    staged = spark.read.schema(rows.schema).parquet(staging)
    refused = staged.filter("_rejected").drop("_rejected")
    refused.write.format(fmt).mode("overwrite").save(args.rejects_path or f"{output}_rejects")
    fresh = quality.dedup_accepted(staged.filter(~F.col("_rejected")))
    if getattr(args, "since", None):
        span = fresh.agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi")).first()
        old = scan(spark, output, fmt, SILVER).filter(F.col("event_time").between(F.lit(span.lo), F.lit(span.hi)))
        fresh = fresh.join(old.select(*DEDUP_KEYS), DEDUP_KEYS, "left_anti")
        added = scratch_path(spark, "silver_staging")
        fresh.write.parquet(added)
        fresh = spark.read.schema(SILVER).parquet(added).select(*SILVER_COLS)
        written = fresh.count()
        write_partitioned(fresh, output, fmt=fmt, mode="append")
        remove_path(spark, added)
    else:
        write_partitioned(fresh, output, fmt=fmt)
        written = scan(spark, output, fmt, SILVER).count()
    account = quality.accounting_rows(observation.get, written)
    spark.createDataFrame(account, "kind string, n bigint").coalesce(1).write.format(fmt).mode("overwrite").save(f"{output}_accounting")
    remove_path(spark, staging)


def run_gold(spark: SparkSession, args) -> None:
    """Full rebuild by default; --incremental-from D updates the existing gold with
    the ticks ingested (or, without an ingestion stamp, timed) since D.

    With ``--state-path`` the daily states are stored: a rebuild writes them, and
    an update merges the new ticks' states into them without reading old ticks
    (the new ticks must not have been counted before, except by an earlier run
    with the same date, which is replaced). Without it, the touched days are
    aggregated from silver again.
    """
    silver_all = scan(spark, args.input_path, args.storage_format, SILVER)
    ticks = silver_all.select(*TICK_COLS)
    if not args.incremental_from:
        if args.state_path:
            daily_state.write_generation(daily_state.daily_states(ticks), args.state_path)
            gold_df = daily_state.gold_from_states(daily_state.state_log(spark, args.state_path))
        else:
            gold_df = G.gold_daily(ticks)
        write_partitioned(gold_df, args.output_path, fmt=args.storage_format)
        _register(spark, args, "gold_daily", args.output_path, GOLD, ["symbol"])
        return
    since = F.lit(args.incremental_from).cast("timestamp")
    new_ticks = silver_all.filter(F.coalesce("_ingested_at", "event_time") >= since).select(*TICK_COLS)
    prev = scan(spark, args.output_path, args.storage_format, GOLD).select(*GOLD_COLS)
    if args.state_path:
        batch_id = "since-" + "".join(c if c.isalnum() else "-" for c in args.incremental_from)
        batch = daily_state.append_batch(new_ticks, args.state_path, batch_id)
        changes = daily_state.gold_changes(prev, args.state_path, batch)
    else:
        changes = G.gold_changes(prev, ticks, new_ticks)
    if changes is None:
        return
    # Only symbols with new ticks can change: stage their rows, then replace just
    # those symbol partitions (dynamic overwrite); the rest of gold is untouched.
    recomputed, start = changes
    kept = prev.join(start, "symbol").filter(F.col("trade_date") < F.col("_start")).select(*GOLD_COLS)
    staging = scratch_path(spark, "gold_staging")
    write_partitioned(kept.unionByName(recomputed), staging, fmt=args.storage_format)
    write_partitions_dynamic(
        scan(spark, staging, args.storage_format, GOLD).select(*GOLD_COLS), args.output_path, ["symbol"],
        args.storage_format,
    )
    remove_path(spark, staging)
    _register(spark, args, "gold_daily", args.output_path, GOLD, ["symbol"])


def _register(spark: SparkSession, args, name: str, path: str, schema, partition_by) -> None:
    """Register a job's output in the catalog under ``--register``'s prefix (without it: not at all)."""
    if args.register is not None:
        register_table(spark, f"{args.register}{name}", path, schema, partition_by, args.storage_format)


def run_serve(spark: SparkSession, args) -> None:
    """Gold → serving: bounded types, then the keyed upsert; with --run-date the
    previous day is deleted first, with --serve-since only days from then on are
    loaded. A row with a value over its type goes to the rejects (always
    written; the rejects of the latest load) and its key leaves the table, so no
    older version of it stays. With ``--publish`` the dates go to fresh folders
    and one switch of that catalog view shows them."""
    gold_df = scan(spark, args.input_path, args.storage_format, GOLD)
    if args.serve_since:
        gold_df = gold_df.filter(F.col("trade_date") >= F.lit(args.serve_since).cast("date"))
    ok, rejects = serving.serving_cast(gold_df)
    rejects_path = args.rejects_path or f"{args.serving_path.rstrip('/')}_rejects"
    rejects.write.mode("overwrite").parquet(rejects_path)
    rejected = spark.read.schema(rejects.schema).parquet(rejects_path).select(*GOLD_KEYS)
    delete_date = None
    if args.run_date:
        delete_date = (dt.date.fromisoformat(args.run_date) - dt.timedelta(days=1)).isoformat()
    if args.publish:
        publication.publish_upsert(ok, args.publish, args.serving_path.rstrip("/"), delete_date, rejected)
        return
    staging = scratch_path(spark, "serving_staging")
    serving.upsert_table(ok, args.serving_path, staging, args.storage_format, delete_date, rejected)


def run_nightly(spark: SparkSession, args) -> None:
    """bronze (bounded) → validation → silver → gold → serving, in order, each step waiting.

    Without ``--since`` silver, gold and serving are rebuilt. With it each step
    takes what was ingested since then: silver appends new keys, gold merges
    their daily states, serving loads the days from the first touched one on.
    """
    root = args.root.rstrip("/")
    ns = argparse.Namespace(**vars(args))
    ns.available_now = True
    ns.starting_offsets = "earliest"  # the first bounded run must see what is there; later ones go on from the checkpoint
    ns.output_path, ns.checkpoint_path = f"{root}/bronze", f"{root}/_checkpoints/bronze"
    run_bronze(spark, ns)
    ns.input_path, ns.invalid_path = f"{root}/bronze", f"{root}/invalid"
    run_validate(spark, ns)
    ns.output_path, ns.rejects_path = f"{root}/silver", f"{root}/silver_rejects"
    run_silver(spark, ns)
    ns.input_path, ns.output_path, ns.incremental_from = f"{root}/silver", f"{root}/gold", args.since
    ns.state_path = f"{root}/daily_states"
    run_gold(spark, ns)
    ns.input_path, ns.serving_path, ns.rejects_path = f"{root}/gold", f"{root}/serving", f"{root}/serving_rejects"
    if args.since:
        new = _since(scan(spark, f"{root}/silver", args.storage_format, SILVER), args)
        first = new.agg(F.min(F.to_date("event_time"))).first()[0]
        if first is None:
            return
        ns.serve_since = first.isoformat()
    run_serve(spark, ns)
    if not args.publish:
        _register(spark, ns, "serving_gold_daily", ns.serving_path, SERVING, ["trade_date"])


def run_compact(spark: SparkSession, args) -> None:
    """Fold the logs that grow by the batch: window statistics or messages, and the daily states."""
    if args.stats_path:
        log = spark.read.parquet(args.stats_path)
        fold = P.compact_stats_messages if "value" in log.columns else P.compact_window_stats
        fold(spark, args.stats_path)
    if args.state_path:
        daily_state.compact(spark, args.state_path)


JOBS = {
    "stream": run_stream,
    "bronze": run_bronze,
    "validate": run_validate,
    "silver": run_silver,
    "silver_stream": run_silver_stream,
    "gold": run_gold,
    "serve": run_serve,
    "nightly": run_nightly,
    "compact": run_compact,
}


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="candela")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--kafka-broker", default="localhost:9092")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--fail-on-data-loss", action="store_true", help="stop when offsets are gone from the topic")
    p.add_argument("--min-partitions", type=int, default=None, help="read the topic in at least so many tasks")
    p.add_argument("--source-path", default=None, help="file landing folder instead of Kafka")
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    p.add_argument("--input-path", default="./data/silver")
    p.add_argument("--output-path", default="./data/gold")
    p.add_argument("--checkpoint-path", default="./data/_checkpoints/silver")
    p.add_argument("--stats-path", default=None, help="stats batch log instead of the processed topic")
    p.add_argument("--storage-format", default="parquet", choices=["parquet", "delta"])
    p.add_argument("--trigger-seconds", type=int, default=None)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--incremental-from", default=None)
    p.add_argument("--serving-path", default="./data/serving")
    p.add_argument("--rejects-path", default=None, help="default: the output path with _rejects")
    p.add_argument("--serve-since", default=None, help="serve: load only days from this date on")
    p.add_argument("--run-date", default=None)
    p.add_argument("--since", default=None, help="silver, validate, nightly: only what was ingested since then")
    p.add_argument("--state-path", default=None, help="gold, compact: the stored daily states")
    p.add_argument("--invalid-path", default="./data/invalid", help="validate: messages that break the contract")
    p.add_argument("--publish", default=None, metavar="VIEW", help="serve: publish the dates through this catalog view")
    p.add_argument("--register", default=None, metavar="PREFIX", help="register the written tables under PREFIX + name")
    p.add_argument("--root", default="./data")
    p.add_argument("--rocksdb", action="store_true", help="RocksDB state store (many symbols/windows)")
    p.add_argument(
        "--partition-by-date",
        action=argparse.BooleanOptionalAction,
        default=True,
        help="silver_stream: partition by symbol and event_date, so the duplicate lookup reads a batch's own days",
    )
    p.add_argument(
        "--shuffle-partitions",
        type=int,
        default=None,
        help="initial shuffle partitions; AQE coalesces down to ~advisory size (e.g. input / 128 MB)",
    )
    p.add_argument("--max-partition-bytes", default=None, help="scan split size, e.g. 256m")
    return p.parse_args(argv)


def main(argv=None) -> None:
    args = parse_args(argv)
    extra = {}
    if args.shuffle_partitions:
        extra["spark.sql.shuffle.partitions"] = str(args.shuffle_partitions)
        extra["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(args.shuffle_partitions)
    if args.max_partition_bytes:
        extra["spark.sql.files.maxPartitionBytes"] = args.max_partition_bytes
    if args.rocksdb:
        extra["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
    spark = build_session(app_name=f"candela-{args.job}", extra=extra)
    ensure_utc(spark)
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
