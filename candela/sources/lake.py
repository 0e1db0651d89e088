"""Lake tables: format-parameterised scans, partitioned writes, registration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from candela.session import session_conf

DEFAULT_FORMAT = "parquet"
#: Tasks a core that list a table's folders.
LISTING_TASKS = 4


def scan(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT, schema: StructType | None = None) -> DataFrame:
    """Batch read of a bronze/silver/gold location; ``fmt`` is parquet or delta.

    Filters and projections applied afterwards reach the scan (PushedFilters,
    ReadSchema, PartitionFilters on the partition column).

    By default Spark lists a folder a task, up to 10,000 tasks, each of which
    takes longer to start than its folder to list; here a few tasks a core share
    the folders.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    tasks = LISTING_TASKS * spark.sparkContext.defaultParallelism
    with session_conf(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}):
        return reader.load(path)


def read_partitioned(spark: SparkSession, path: str, schema: StructType, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Read ``col=value`` folders back with an explicit schema, so the partition
    column keeps its declared type (inference would turn numeric-looking
    symbols into integers and an all-NULL partition into void)."""
    return scan(spark, path, fmt, schema)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("symbol",),
    fmt: str = DEFAULT_FORMAT,
    mode: str = "overwrite",
    overwrite_schema: bool = True,
) -> None:
    """Partitioned write that avoids both tiny files and one giant task.

    The REBALANCE hint clusters rows by the partition columns, and adaptive
    execution splits a skewed cluster (a hot symbol) over several tasks and
    coalesces small ones. ``overwriteSchema`` only means something to delta;
    a plain parquet overwrite replaces the schema anyway.
    """
    writer = df.hint("rebalance", *partition_by).write.format(fmt).mode(mode).partitionBy(*partition_by)
    if fmt == "delta" and overwrite_schema and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def write_partitions_dynamic(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = DEFAULT_FORMAT) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite)."""
    (
        df.hint("rebalance", *partition_by)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    partition_by: Sequence[str] = ("symbol",),
    fmt: str = DEFAULT_FORMAT,
) -> str:
    """CREATE TABLE IF NOT EXISTS … USING fmt LOCATION path, then recover partitions."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt} "
        + (f"PARTITIONED BY ({parts}) " if partition_by else "")
        + f"LOCATION '{path}'"
    )
    if partition_by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, by: str = "symbol", order: str = "trade_date") -> None:
    """A table of ``buckets`` buckets by ``by``, each one file sorted by (``by``, ``order``).

    Windows and joins keyed by the bucket column read it without an exchange, and
    with one file a bucket also without a sort (``bucket_order`` settings).
    """
    rows = df.repartition(buckets, by)
    writer = rows.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, by).sortBy(by, order).saveAsTable(name)


#: Session settings under which a scan of one file a bucket keeps the buckets and their order.
BUCKET_ORDER = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
