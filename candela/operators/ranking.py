"""Distributed total ordering with a dense 1..N position.

``row_number()`` over an un-partitioned window moves every row into one task.
Here the rows are range-partitioned on the sort key (sampled boundaries), each
range is numbered locally, and a per-range offset — one row per range, so its
size is bounded by the partition count — is added back. There is one algorithm
for every input size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.session import shared_dir


def with_position(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """1..N position of each row in ``order`` (ties must be broken by ``order``).

    Range boundaries are drawn from a sample, so two evaluations of the same
    plan may cut differently. The rows are therefore written to the shared
    checkpoint folder together with the range they were assigned to, and both
    the range sizes and the local positions are read from that one assignment.
    """
    spark = df.sparkSession
    shared_dir(spark)  # make sure a checkpoint folder is set (tests/local runs)
    base = df.checkpoint(eager=True)  # sampling reads the input once more
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = base.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    local = ranged.withColumn("_pos", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    # offsets has one row per range partition: a proven bound for the broadcast.
    return (
        local.join(F.broadcast(offsets), "_range")
        .withColumn(out, (F.col("_offset") + F.col("_pos")).cast("bigint"))
        .drop("_range", "_pos", "_offset")
    )
