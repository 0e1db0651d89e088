"""Late ticks kept: a stage before the windows that sends what is behind the watermark to a side table.

Each micro-batch is judged by the watermark of the batches before it: the latest
event time they held, less the delay. A tick whose window has ended by then is
late. Both parts go to folders of the batch (overwritten, so a batch run again
gives the same), and the batch leaves the latest event time it knows, one row, for
those after it. Input = on time + late, whatever order ticks come in; a tick
without a time belongs to no window and goes to the side table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candela.operators.window_stats import WATERMARK, window_stats

STATE = "latest timestamp, batch_id bigint"
WINDOW_SECONDS = 60


def known_latest(spark: SparkSession, path: str, batch_id: int):
    """The latest event time of the batches before ``batch_id`` (None: there are none)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/latest")
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return None
    rows = spark.read.schema(STATE).parquet(f"{path}/latest").filter(F.col("batch_id") < batch_id)
    return rows.agg(F.max("latest")).first()[0]


def split_batch(path: str, delay: str = WATERMARK, window_seconds: int = WINDOW_SECONDS):
    """foreachBatch body: ``path/on_time``, ``path/late`` and ``path/latest`` by batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = known_latest(spark, path, batch_id)
        rows = batch.persist()
        try:
            # Watermarks count whole milliseconds.
            mark = F.date_trunc("millisecond", F.lit(before).cast("timestamp")) - F.expr(f"INTERVAL {delay}")
            length = window_seconds * 1_000_000
            end = F.timestamp_micros((F.floor(F.unix_micros("event_time") / length) + 1) * length)
            judged = rows.withColumn("_late", F.coalesce(end <= mark, F.col("event_time").isNull()))
            judged.filter(~F.col("_late")).drop("_late").write.mode("overwrite").parquet(f"{path}/on_time/batch_id={batch_id}")
            late = judged.filter("_late").drop("_late").withColumn("watermark", mark)
            late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
            latest = rows.agg(F.max("event_time").alias("own")).select(F.greatest("own", F.lit(before).cast("timestamp")).alias("latest"))
            latest.write.mode("overwrite").parquet(f"{path}/latest/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return write


def start_late_split(
    clean: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, delay: str = WATERMARK
) -> StreamingQuery:
    """Cleaned ticks (no watermark needed) into the on-time table and the side table of late ones."""
    w = clean.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "15 seconds"}))
    return w.foreachBatch(split_batch(path, delay)).start()


def on_time(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/on_time").drop("batch_id")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The late ticks, each with the watermark it was behind."""
    return spark.read.parquet(f"{path}/late").drop("batch_id")


def window_accounting(spark: SparkSession, path: str) -> DataFrame:
    """(kind, n): ticks that came in, those counted in windows and the late ones; input = windows + late."""
    kept, late = on_time(spark, path), late_rows(spark, path)
    windows = window_stats(kept).agg(F.coalesce(F.sum("tick_count"), F.lit(0)).alias("n")).select(F.lit("windows").alias("kind"), "n")
    parts = kept.select("event_time").unionByName(late.select("event_time"))
    counts = parts.agg(F.count(F.lit(1)).alias("n")).select(F.lit("input").alias("kind"), "n")
    return counts.unionByName(windows).unionByName(late.agg(F.count(F.lit(1)).alias("n")).select(F.lit("late").alias("kind"), "n"))
