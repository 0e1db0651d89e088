"""Streaming sources producing the Kafka envelope (key, value, topic, partition, offset, timestamp)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candela.schema import ENVELOPE, TOPIC_RAW


def kafka_source(
    spark: SparkSession,
    brokers: str,
    topic: str = TOPIC_RAW,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
) -> DataFrame:
    """Subscribe to the raw tick topic (needs the spark-sql-kafka package on the classpath).

    ``min_partitions`` splits topic partitions into more tasks than the topic has.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Envelope records landed as files (replays, or an archive of the topic)."""
    reader = spark.readStream.format(fmt).schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
