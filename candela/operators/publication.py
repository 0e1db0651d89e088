"""Atomic publication of the serving table: fresh folders per touched date, one switch in the catalog.

A publication writes the touched dates into a folder of its own version,
``root/v=N/trade_date=D``, and registers a table ``name__vN`` whose partitions lie there
or, for untouched dates, where the version before has them. Readers use the view
``name``; replacing it is the one step that makes the new version visible, so a
failure anywhere leaves the old table or the new one. The version before stays
readable until the next publication, for queries that began on it.

Only the catalog's own statements are used (tables, partition locations, a
view); one job publishes at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.operators.serving import assert_constraints, delete_day, stamp, upsert
from candela.schema import GOLD_KEYS, SERVING, SERVING_COLS
from candela.session import remove_path, scratch_path
from candela.sources.lake import write_partitioned

_COLS = [*SERVING_COLS, "loaded_at"]


def published_version(spark: SparkSession, name: str) -> int | None:
    """The version that the view ``name`` shows (None: nothing published)."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {name} ('candela.version')").collect()
    return int(rows[0]["value"])


def date_versions(spark: SparkSession, name: str, version: int) -> dict[str, int]:
    """The folder version of each date of a published version (one row a calendar day; file names only)."""
    rows = spark.table(f"{name}__v{version}").select(
        F.col("trade_date").cast("string").alias("d"), F.regexp_extract(F.input_file_name(), r"/v=([0-9]+)/trade_date=", 1).cast("int").alias("v")
    )
    return {r.d: r.v for r in rows.distinct().collect()}


def _create(spark: SparkSession, name: str, root: str, version: int, dates: dict[str, int]) -> None:
    table = f"{name}__v{version}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SERVING.fields)
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet PARTITIONED BY (trade_date) LOCATION '{root}/v={version}'")
    places = [f"PARTITION (trade_date = DATE'{d}') LOCATION '{root}/v={v}/trade_date={d}'" for d, v in sorted(dates.items())]
    for at in range(0, len(places), 200):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(places[at : at + 200])}")


def publish_dates(rows: DataFrame, touched: list[str], name: str, root: str) -> int:
    """Publish ``rows`` as the whole content of the ``touched`` dates; returns the new version."""
    spark = rows.sparkSession
    old = published_version(spark, name)
    kept = date_versions(spark, name, old) if old is not None else {}
    new = 0 if old is None else old + 1
    folder = f"{root}/v={new}"
    write_partitioned(rows.select(*_COLS), folder, ["trade_date"])  # replaces what a failed attempt left
    written = spark.read.schema(SERVING).parquet(folder)
    assert_constraints(written)
    own = [r.d for r in written.select(F.col("trade_date").cast("string").alias("d")).distinct().collect()]  # calendar days
    dates = {d: v for d, v in kept.items() if d not in touched} | dict.fromkeys(own, new)
    _create(spark, name, root, new, dates)
    # The switch.
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('candela.version' = '{new}') AS SELECT * FROM {name}__v{new}")
    _retire(spark, name, root, kept, dates, old)
    return new


def _retire(spark: SparkSession, name: str, root: str, before: dict[str, int], now: dict[str, int], old: int | None) -> None:
    """Drop the version before the last one, and the folders that neither of the two refers to."""
    if old is None or old == 0 or not spark.catalog.tableExists(f"{name}__v{old - 1}"):
        return
    gone = date_versions(spark, name, old - 1)
    spark.sql(f"DROP TABLE {name}__v{old - 1}")
    for d, v in gone.items():
        if before.get(d) != v and now.get(d) != v:
            remove_path(spark, f"{root}/v={v}/trade_date={d}")


def publish_upsert(
    source: DataFrame, name: str, root: str, delete_date: str | None = None, removed_keys: DataFrame | None = None
) -> int:
    """Keyed upsert into the published table: only touched dates are read, merged and written."""
    spark = source.sparkSession
    staging = scratch_path(spark, "publication_staging")
    write_partitioned(source.select(*SERVING_COLS), staging, ["trade_date"])
    src = spark.read.schema(SERVING).parquet(staging).select(*SERVING_COLS)
    dates = src.select("trade_date")
    gone = removed_keys.select(*GOLD_KEYS).distinct() if removed_keys is not None else None
    if gone is not None:
        dates = dates.unionByName(gone.select("trade_date"))
    touched = {str(r.trade_date) for r in dates.distinct().collect()}  # calendar days of one batch
    if delete_date is not None:
        touched.add(delete_date)
    if published_version(spark, name) is None:
        merged = stamp(src)
    else:
        current = spark.table(name).filter(F.col("trade_date").isin([F.lit(d).cast("date") for d in sorted(touched)]))
        if delete_date is not None:
            current = delete_day(current, delete_date)
        if gone is not None:
            current = current.join(gone, GOLD_KEYS, "left_anti")
        merged = upsert(current, src)
    version = publish_dates(merged, sorted(touched), name, root)
    remove_path(spark, staging)
    return version
