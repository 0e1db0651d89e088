"""Silver rules: quality filter, reject reasons and deterministic deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from candela.schema import DEDUP_KEYS, LINEAGE_COLS, TICK_COLS


def quality_predicate() -> Column:
    """symbol present, price > 0, volume >= 0 (a NULL volume fails)."""
    return F.col("symbol").isNotNull() & (F.col("price") > 0) & (F.col("volume") >= 0)


def quality_filter(df: DataFrame) -> DataFrame:
    return df.filter(quality_predicate())


def reject_reasons(columns: Sequence[str]) -> Column:
    """Why silver refuses a row (empty: it doesn't); key columns count where the input has them."""
    ok = lambda c: F.coalesce(c, F.lit(False))
    return F.array_compact(
        F.array(
            F.when(F.col("symbol").isNull(), F.lit("null_symbol")),
            F.when(~ok(F.col("price") > 0), F.lit("bad_price")),
            F.when(~ok(F.col("volume") >= 0), F.lit("bad_volume")),
            *[F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in ("event_time", "source") if c in columns],
        )
    )


def silver_predicate(columns: Sequence[str]) -> Column:
    """What batch and streaming silver accept: exactly the rows without a reject reason."""
    accepted = quality_predicate()
    for c in ("event_time", "source"):
        if c in columns:
            accepted = accepted & F.col(c).isNotNull()
    return F.coalesce(accepted, F.lit(False))


def with_reject_reasons(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", reject_reasons(df.columns))


def quality_rejects(df: DataFrame) -> DataFrame:
    """Rows silver drops, each with its (possibly several) reasons."""
    return with_reject_reasons(df.filter(~silver_predicate(df.columns)))


def reject_counts(df: DataFrame) -> DataFrame:
    return (
        quality_rejects(df)
        .select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def silver_accounting(bronze_df: DataFrame) -> DataFrame:
    """Where every bronze row went: (kind, n) with input = silver + duplicate + rejected, and rejected rows by reason.

    One pass: copies are counted per key (partial aggregation), rejects per set of reasons.
    """
    reasons = reject_reasons(bronze_df.columns)
    accepted = silver_predicate(bronze_df.columns)
    keys = [F.when(accepted, F.col(c)).alias(c) for c in DEDUP_KEYS]
    per_key = bronze_df.select(*keys, F.when(accepted, F.array().cast("array<string>")).otherwise(reasons).alias("reasons"))
    per_key = per_key.groupBy(*DEDUP_KEYS, "reasons").agg(F.count(F.lit(1)).alias("n"))
    rejected = F.size("reasons") > 0
    kinds = F.concat(
        F.array(F.struct(F.lit("input").alias("kind"), F.col("n").alias("n"))),
        F.when(rejected, F.array(F.struct(F.lit("rejected").alias("kind"), F.col("n").alias("n")))).otherwise(
            F.array(
                F.struct(F.lit("silver").alias("kind"), F.lit(1).cast("bigint").alias("n")),
                F.struct(F.lit("duplicate").alias("kind"), (F.col("n") - 1).alias("n")),
            )
        ),
        F.transform("reasons", lambda r: F.struct(F.concat(F.lit("reject:"), r).alias("kind"), F.col("n").alias("n"))),
    )
    return per_key.select(F.inline(kinds)).groupBy("kind").agg(F.sum("n").alias("n"))


REASONS = ("null_symbol", "bad_price", "bad_volume", "null_event_time", "null_source")


def judged(bronze_df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Bronze rows with their reject reasons (empty: accepted), counted on the way by ``observation``.

    One pass: whatever is written from this has been read once, and the metrics
    (``input``, ``rejected``, and each reason) come with that write.
    """
    rows = with_reject_reasons(bronze_df)
    if observation is None:
        return rows
    by_reason = [F.count_if(F.array_contains("reasons", r)).alias(f"reject:{r}") for r in REASONS]
    return rows.observe(observation, F.count(F.lit(1)).alias("input"), F.count_if(F.size("reasons") > 0).alias("rejected"), *by_reason)


def accounting_rows(metrics: dict[str, int], silver_rows: int) -> list[tuple[str, int]]:
    """(kind, n) as ``silver_accounting`` gives them, from the metrics of one pass and the number of silver rows."""
    accepted = metrics["input"] - metrics["rejected"]
    rows = [("input", metrics["input"]), ("silver", silver_rows), ("duplicate", accepted - silver_rows)]
    rows += [(k, n) for k, n in metrics.items() if k == "rejected" or k.startswith("reject:")]
    return [(k, n) for k, n in rows if n > 0 or k in ("input", "silver", "duplicate")]


def dedup(
    df: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    order_by: Sequence[str] | None = LINEAGE_COLS,
) -> DataFrame:
    """Keep, per key, the copy that sorts first by ``order_by`` (earliest delivery).

    Written as an aggregation (min_by over a struct of the remaining columns),
    not a row_number window: partial aggregation collapses copies on the map
    side, so even a key holding a third of all rows reaches the shuffle as one
    row per map task.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    order_cols = [c for c in (order_by or []) if c in df.columns] or others
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order_cols)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def silver(bronze_df: DataFrame, keep_lineage: bool = False) -> DataFrame:
    """Bronze → silver: quality rules, keys present, one row per (symbol, event_time, source)."""
    clean = bronze_df.filter(silver_predicate(bronze_df.columns))
    return dedup_accepted(clean, keep_lineage)


def dedup_accepted(clean: DataFrame, keep_lineage: bool = False) -> DataFrame:
    """Accepted rows → silver columns, one row per (symbol, event_time, source)."""
    cols = TICK_COLS + (LINEAGE_COLS if keep_lineage else [])
    if "_ingested_at" in clean.columns:
        cols = cols + ["_ingested_at"]
    # Project before the dedup shuffle: the raw payload never leaves the map side.
    lineage = [c for c in LINEAGE_COLS if c in clean.columns]
    narrow = clean.select(*dict.fromkeys(cols + lineage))
    return dedup(narrow).select(*cols)
