"""Quality filter, reject reasons, deterministic dedup."""

import datetime as dt

from pyspark.sql import functions as F

from candela.operators import quality
from candela.plans.catalog import ticks
from candela.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_filter_plus_rejects_is_input(spark):
    d = fx.dirty_ticks(ticks(spark, SF))
    assert quality.quality_filter(d).count() + quality.quality_rejects(d).count() == d.count()


def test_null_volume_is_rejected(spark):
    df = spark.createDataFrame([("A", 1.0, None)], "symbol string, price double, volume bigint")
    assert quality.quality_filter(df).count() == 0
    assert quality.quality_rejects(df).first().reasons == ["bad_volume"]


def test_several_reasons(spark):
    df = spark.createDataFrame([(None, 0.0, -1)], "symbol string, price double, volume bigint")
    assert quality.quality_rejects(df).first().reasons == ["null_symbol", "bad_price", "bad_volume"]


def test_dedup_keeps_earliest_delivery(spark):
    t = dt.datetime(2024, 1, 1, 9, 0)
    rows = [
        ("A", t, "s", 1.0, dt.datetime(2024, 1, 1, 9, 2), 0, 7),
        ("A", t, "s", 1.0, dt.datetime(2024, 1, 1, 9, 1), 1, 9),
        ("A", t, "s", 1.0, dt.datetime(2024, 1, 1, 9, 1), 0, 8),
    ]
    df = spark.createDataFrame(
        rows, "symbol string, event_time timestamp, source string, price double, kafka_timestamp timestamp, partition int, offset long"
    )
    out = quality.dedup(df).collect()
    assert len(out) == 1 and out[0].offset == 8


def test_dedup_hot_key(spark):
    """One key holding most rows: result is one row, the earliest offset."""
    base = spark.range(50_000).select(
        F.lit("HOT").alias("symbol"),
        F.lit(dt.datetime(2024, 1, 1)).alias("event_time"),
        F.lit("s").alias("source"),
        F.lit(1.0).alias("price"),
        F.lit(dt.datetime(2024, 1, 1)).alias("kafka_timestamp"),
        F.lit(0).alias("partition"),
        (F.lit(1_000_000) - F.col("id")).alias("offset"),
    )
    out = quality.dedup(base.repartition(8)).collect()
    assert len(out) == 1 and out[0].offset == 1_000_000 - 49_999


def test_silver_is_unique_on_keys(spark):
    from candela.plans.catalog import silver

    s = silver(spark, SF)
    assert s.groupBy("symbol", "event_time", "source").count().filter("count > 1").count() == 0
