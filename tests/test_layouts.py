"""Bucketed gold without exchange or sort; distinct symbols from stored sketches."""

import pytest
from pyspark.sql import functions as F

from candela.operators import gold as G
from candela.operators import indicators as I
from candela.operators import symbol_sketch as K
from candela.plans.catalog import canon, ticks
from candela.session import scratch_path, session_conf
from candela.sources.lake import BUCKET_ORDER, write_bucketed

SF = "/root/testdata/sf0.001"


def test_bucketed_indicators_need_no_exchange_or_sort(spark):
    gold = G.gold_daily(ticks(spark, SF, "user"))
    path = scratch_path(spark, "gold_bucketed")
    write_bucketed(gold, "gold_bucketed_test", path, 4)
    try:
        with session_conf(spark, BUCKET_ORDER):
            stored = spark.table("gold_bucketed_test").select(*gold.columns)
            for compute in (lambda d: I.with_sma(d, 5), lambda d: I.with_rsi_strict(d, 14), lambda d: G.with_prev_close(d.drop("prev_close"))):
                plan = compute(stored)._jdf.queryExecution().executedPlan().toString()
                assert "Window" in plan and "Exchange" not in plan and "Sort " not in plan
                assert sorted(map(str, canon(compute(stored)).collect())) == sorted(map(str, canon(compute(gold)).collect()))
    finally:
        spark.sql("DROP TABLE gold_bucketed_test")


@pytest.mark.parametrize("symbols", [50, 200_000])
def test_sketches_are_within_their_error(spark, symbols):
    rows = spark.range(symbols * 2).select(
        F.concat(F.lit("S"), F.col("id") % symbols).alias("symbol"), F.expr("date_add(DATE'2024-01-01', cast(id % 10 as int))").alias("trade_date")
    )
    sketches = K.daily_symbol_sketches(rows).checkpoint()
    spans = [(None, None), ("2024-01-03", "2024-01-05"), ("2024-01-09", None)]
    for low, high in spans:
        own = rows.filter((F.col("trade_date") >= (low or "1900-01-01")) & (F.col("trade_date") <= (high or "2100-01-01")))
        exact = own.select("symbol").distinct().count()
        assert abs(K.distinct_symbols(sketches, low, high).first()[0] - exact) <= 0.05 * exact
    exact = {r.trade_date: r.n for r in rows.groupBy("trade_date").agg(F.countDistinct("symbol").alias("n")).collect()}
    got = {r.trade_date: r.n_symbols for r in K.distinct_symbols_trailing(sketches, 1).collect()}
    assert got.keys() == exact.keys() and all(abs(got[d] - exact[d]) <= 0.05 * exact[d] for d in exact)
    assert K.distinct_symbols(sketches, "2030-01-01").first()[0] == 0
