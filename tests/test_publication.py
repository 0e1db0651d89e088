"""Publication of serving dates: one switch, whatever fails before or after it."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candela.operators import publication as P
from candela.schema import SERVING, SERVING_COLS
from candela.session import scratch_path


def rows(spark, *items):
    """(symbol, day, close) in serving types."""
    values = [(s, dt.date(2024, 1, d), Decimal(c)) for s, d, c in items]
    df = spark.createDataFrame(values, "symbol string, trade_date date, close_price decimal(12,4)")
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(SERVING[c].dataType).alias(c) for c in SERVING_COLS])


def content(spark, name):
    return sorted((r.symbol, r.trade_date.day, int(r.close_price)) for r in spark.table(name).collect())


@pytest.fixture
def published(spark):
    root, name = scratch_path(spark, "publication"), "serving_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    P.publish_upsert(rows(spark, ("A", 1, 10), ("B", 1, 20), ("A", 2, 11), ("A", 3, 12)), name, root)
    yield name, root
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for v in range(9):
        spark.sql(f"DROP TABLE IF EXISTS {name}__v{v}")


def test_upsert_delete_and_refused_keys(spark, published):
    name, root = published
    P.publish_upsert(rows(spark, ("A", 2, 99), ("C", 4, 5)), name, root)
    assert content(spark, name) == [("A", 1, 10), ("A", 2, 99), ("A", 3, 12), ("B", 1, 20), ("C", 4, 5)]
    P.publish_upsert(rows(spark, ("D", 4, 6)), name, root, delete_date="2024-01-03", removed_keys=rows(spark, ("B", 1, 0)))
    assert content(spark, name) == [("A", 1, 10), ("A", 2, 99), ("C", 4, 5), ("D", 4, 6)]
    # Untouched dates stay in the folders they were first written to.
    assert P.date_versions(spark, name, 2) == {"2024-01-01": 2, "2024-01-02": 1, "2024-01-04": 2}
    assert P.published_version(spark, name) == 2 and not spark.catalog.tableExists(f"{name}__v0")


def test_a_failure_leaves_the_old_or_the_new_table(spark, published, monkeypatch):
    """Every statement in turn fails once; the view shows one version whole, and the next run finishes the job."""
    name, root = published
    session, plain = type(spark), type(spark).sql
    old, at = content(spark, name), 0
    while True:
        at += 1
        calls = {"n": 0}

        def sql(self, text, *args, calls=calls, at=at, **kwargs):
            calls["n"] += 1
            if calls["n"] == at:
                raise RuntimeError("stopped here")
            return plain(self, text, *args, **kwargs)

        new = [("A", 1, 10), ("A", 2, 40 + at), ("A", 3, 12), ("B", 1, 20), ("Z", 5, at)]
        source = rows(spark, ("A", 2, 40 + at), ("Z", 5, at))
        monkeypatch.setattr(session, "sql", sql)
        try:
            P.publish_upsert(source, name, root)
            failed = False
        except RuntimeError:
            failed = True
        finally:
            monkeypatch.setattr(session, "sql", plain)
        now = content(spark, name)
        assert now in (old, new), (at, now)
        P.publish_upsert(source, name, root)
        old = content(spark, name)
        assert old == new
        if not failed:
            break
    assert at > 5


def test_a_broken_batch_is_not_published(spark, published):
    name, root = published
    before = content(spark, name)
    with pytest.raises(ValueError):
        P.publish_dates(rows(spark, ("A", 1, 1), ("A", 1, 2)).withColumn("loaded_at", F.current_timestamp()), ["2024-01-01"], name, root)
    assert content(spark, name) == before


def test_serve_job_publishes(spark):
    from candela.operators import gold as G
    from candela.plans import jobs
    from candela.plans.catalog import ticks

    root = scratch_path(spark, "lake")
    gold = G.gold_daily(ticks(spark, "/root/testdata/sf0.001"))
    gold.write.partitionBy("symbol").parquet(f"{root}/gold")
    argv = ["serve", "--input-path", f"{root}/gold", "--serving-path", f"{root}/serving", "--publish", "served_by_job"]
    try:
        for _ in range(2):
            jobs.run_serve(spark, jobs.parse_args(argv))
            rejects = spark.read.parquet(f"{root}/serving_rejects").select("symbol", "trade_date").distinct().count()
            assert spark.table("served_by_job").count() + rejects == gold.count()
        assert P.published_version(spark, "served_by_job") == 1
    finally:
        spark.sql("DROP VIEW IF EXISTS served_by_job")
        for v in range(2):
            spark.sql(f"DROP TABLE IF EXISTS served_by_job__v{v}")
