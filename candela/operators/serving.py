"""Serving table: projection, bounded types, constraints and idempotent loads.

The serving table is keyed by (symbol, trade_date) and stored partitioned by
trade_date, so a nightly upsert of recent days rewrites only those partitions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.schema import (
    CURRENCY_MAX_LEN,
    GOLD_KEYS,
    SERVING,
    SERVING_COLS,
    SERVING_TYPES,
    SOURCE_MAX_LEN,
    STAGING_COLS,
    STAGING_TICK_TYPES,
    SYMBOL_MAX_LEN,
)


def serving_projection(gold: DataFrame) -> DataFrame:
    """Gold → the 11 serving columns in their fixed order (prev_close dropped)."""
    return gold.select(*SERVING_COLS)


def _to_decimal(c: str, t) -> Column:
    # The cast rounds half away from zero at the target scale and is NULL on overflow.
    return F.col(c).try_cast(t)


def serving_typed(gold: DataFrame) -> DataFrame:
    """Serving columns cast to the bounded decimal types; overflow → NULL."""
    return serving_projection(gold).withColumns({c: _to_decimal(c, t) for c, t in SERVING_TYPES.items()})


def overflow_rejects(gold: DataFrame) -> DataFrame:
    """(symbol, trade_date, column) for each value that does not fit its decimal type."""
    checks = [
        F.when(F.col(c).isNotNull() & _to_decimal(c, t).isNull(), F.lit(c)) for c, t in SERVING_TYPES.items()
    ]
    return (
        gold.select("symbol", "trade_date", F.explode(F.array_compact(F.array(*checks))).alias("column"))
    )


def fits_serving_types() -> Column:
    """True when every serving value fits its decimal type (NULL fits)."""
    cond = F.lit(True)
    for c, t in SERVING_TYPES.items():
        cond = cond & (F.col(c).isNull() | _to_decimal(c, t).isNotNull())
    return cond


def serving_cast(gold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit every serving type, cast; the overflow rejects).

    Overflow is a property of the row, so both outputs are row-level filters
    of the same input: no join, no shuffle.
    """
    return serving_typed(gold.filter(fits_serving_types())), overflow_rejects(gold)


def constraint_violations(serving: DataFrame) -> DataFrame:
    """One row per constraint kind with its count (0 when satisfied).

    Per-key counts first (partial aggregation bounds a hot key), then one
    global aggregate over the key groups.
    """
    per_key = serving.groupBy(*GOLD_KEYS).agg(F.count(F.lit(1)).alias("_n"))
    totals = per_key.agg(
        F.count(F.when(F.col("_n") > 1, 1)).alias("duplicate_key"),
        F.coalesce(F.sum(F.when(F.col("symbol").isNull(), F.col("_n"))), F.lit(0)).alias("null_symbol"),
        F.coalesce(F.sum(F.when(F.col("trade_date").isNull(), F.col("_n"))), F.lit(0)).alias("null_trade_date"),
        F.coalesce(F.sum(F.when(F.length("symbol") > SYMBOL_MAX_LEN, F.col("_n"))), F.lit(0)).alias(
            "symbol_too_long"
        ),
    )
    kinds = ("duplicate_key", "null_symbol", "null_trade_date", "symbol_too_long")
    return totals.select(
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("violation"), F.col(k).cast("bigint").alias("n")) for k in kinds])
        ).alias("v")
    ).select("v.*")


def assert_constraints(serving: DataFrame) -> None:
    bad = constraint_violations(serving).filter(F.col("n") > 0).collect()  # ≤ 4 rows
    if bad:
        raise ValueError(f"serving constraints violated: {[(r.violation, r.n) for r in bad]}")


def stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("loaded_at", F.current_timestamp())


def upsert(target: DataFrame, source: DataFrame, keys=GOLD_KEYS) -> DataFrame:
    """ON CONFLICT (keys) DO UPDATE: source rows replace all metric columns and get a
    fresh loaded_at; unmatched target rows are kept. An incoming NULL overwrites."""
    src = stamp(source.select(*SERVING_COLS))
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(src, allowMissingColumns=True)


def append_guarded(target: DataFrame, source: DataFrame, keys=GOLD_KEYS) -> DataFrame:
    """Append only keys the target lacks (a blind append would break the primary key)."""
    new = source.select(*SERVING_COLS).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(stamp(new), allowMissingColumns=True)


def delete_day(target: DataFrame, day: Column | str | date) -> DataFrame:
    d = F.lit(day).cast("date") if not isinstance(day, Column) else day
    return target.filter((F.col("trade_date") != d) | F.col("trade_date").isNull())


def replace_day(target: DataFrame, source: DataFrame, run_date: str | date) -> DataFrame:
    """Pre-copy delete of the run date's previous day, then the keyed upsert."""
    yesterday = F.date_sub(F.lit(run_date).cast("date"), 1)
    return upsert(delete_day(target, yesterday), source)


def _staging_projection(ticks: DataFrame) -> DataFrame:
    """Raw-tick staging projection: open → open_price, id = offset."""
    return ticks.select(
        F.col("offset").alias("id"),
        "symbol",
        "price",
        F.col("open").alias("open_price"),
        "day_high",
        "day_low",
        "prev_close",
        "volume",
        "currency",
        "event_time",
        "source",
    )


def staging_reasons() -> Column:
    """Why the staging table refuses a raw tick: a value over its decimal type, a NULL, a text too long."""
    overflow = [
        F.when(F.col(c).isNotNull() & _to_decimal(c, t).isNull(), F.lit(f"overflow_{c}")) for c, t in STAGING_TICK_TYPES.items()
    ]
    null = [F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in ("symbol", "price", "event_time")]
    limits = (("symbol", SYMBOL_MAX_LEN), ("currency", CURRENCY_MAX_LEN), ("source", SOURCE_MAX_LEN))
    long = [F.when(F.length(c) > n, F.lit(f"{c}_too_long")) for c, n in limits]
    return F.array_compact(F.array(*overflow, *null, *long))


def staging_load(ticks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(raw ticks in staging types with ``inserted_at``, the refused ones with their reasons)."""
    rows = _staging_projection(ticks).withColumn("reasons", staging_reasons())
    ok = rows.filter(F.size("reasons") == 0).withColumns({c: _to_decimal(c, t) for c, t in STAGING_TICK_TYPES.items()})
    return ok.select(*STAGING_COLS).withColumn("inserted_at", F.current_timestamp()), rows.filter(F.size("reasons") > 0)


def staging_raw_ticks(ticks: DataFrame) -> DataFrame:
    """The raw ticks that the staging table accepts, in its types."""
    return staging_load(ticks)[0].select(*STAGING_COLS)


def _read_or_none(spark, path: str, fmt: str):
    try:
        if not spark.read.format(fmt).load(path).columns:
            return None
    except Exception as e:  # first load: no table yet
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    return spark.read.format(fmt).schema(SERVING).load(path)


def touched_partitions(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target rows on the dates the source touches.

    The date span of the source (a one-row aggregate) becomes a static
    partition filter, so the scan lists and reads only that span whatever the
    optimizer estimates; the semi join then keeps exactly the touched dates.
    """
    span = source.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi")).first()
    if span is None or span.lo is None:
        return target.limit(0)
    ranged = target.filter(F.col("trade_date").between(F.lit(span.lo), F.lit(span.hi)))
    return ranged.join(source.select("trade_date").distinct(), "trade_date", "left_semi")


def upsert_table(
    source: DataFrame,
    table_path: str,
    staging_path: str,
    fmt: str = "parquet",
    delete_date: str | None = None,
    removed_keys: DataFrame | None = None,
) -> None:
    """Keyed upsert into a serving table stored partitioned by trade_date.

    Only the dates of ``source``, of ``removed_keys`` (keys whose new row was
    refused: their old row must not stay) and ``delete_date`` are read, merged,
    staged, checked against the constraints and swapped in with a dynamic
    partition overwrite. A date that the merge leaves empty loses its folder.
    Other dates are left untouched. Staging keeps every write off the path
    being read and is deleted after success; re-running gives the same table.
    """
    from candela.session import remove_path
    from candela.sources.lake import write_partitions_dynamic, write_partitioned

    spark = source.sparkSession
    # Used for the merge, the dates and the keys: typed once.
    batch_path = f"{staging_path}/batch"
    write_partitioned(source.select(*SERVING_COLS), batch_path, ["trade_date"], fmt)
    src = spark.read.format(fmt).schema(SERVING).load(batch_path).select(*SERVING_COLS)
    dates = src.select("trade_date")
    gone = removed_keys.select(*GOLD_KEYS).distinct() if removed_keys is not None else None
    if gone is not None:
        dates = dates.unionByName(gone.select("trade_date"))
    if delete_date is not None:
        dates = dates.unionByName(spark.range(1).select(F.lit(delete_date).cast("date").alias("trade_date")))
    dates = dates.distinct()
    target = _read_or_none(spark, table_path, fmt)
    if target is None:
        merged = stamp(src)
    else:
        current = touched_partitions(target, dates)
        if delete_date is not None:
            current = delete_day(current, delete_date)
        if gone is not None:
            current = current.join(gone, GOLD_KEYS, "left_anti")
        merged = upsert(current, src)
    cols = [*SERVING_COLS, "loaded_at"]
    merged_path = f"{staging_path}/merged"
    write_partitioned(merged.select(*cols), merged_path, ["trade_date"], fmt)
    staged = spark.read.format(fmt).schema(SERVING).load(merged_path).select(*cols)
    assert_constraints(staged)
    if target is None or not staged.isEmpty():
        write_partitions_dynamic(staged, table_path, ["trade_date"], fmt)
    if target is not None:
        emptied = dates.join(staged.select("trade_date").distinct(), "trade_date", "left_anti")
        for row in emptied.collect():  # calendar days of one batch
            if row.trade_date is not None:
                remove_path(spark, f"{table_path}/trade_date={row.trade_date.isoformat()}")
    remove_path(spark, staging_path)
