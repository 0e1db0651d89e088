"""Serving loads: upsert semantics, idempotence, guards, bounded types."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from candela.operators import serving
from candela.schema import SERVING_COLS

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
SCHEMA = (
    "symbol string, trade_date date, open_price double, high_price double, low_price double, "
    "close_price double, total_volume bigint, avg_price double, volatility double, pct_change double, rsi_14 double"
)


def _row(sym, d, close, pct=1.0):
    return (sym, d, 1.0, 2.0, 0.5, close, 10, 1.2, 0.1, pct, 50.0)


def _keyed(df):
    return {(r.symbol, r.trade_date): r for r in df.collect()}


def test_upsert_replaces_and_keeps(spark):
    tgt = serving.stamp(spark.createDataFrame([_row("A", D1, 1.0), _row("A", D2, 2.0)], SCHEMA))
    src = spark.createDataFrame([_row("A", D2, 9.0, None), _row("A", D3, 3.0)], SCHEMA)
    out = _keyed(serving.upsert(tgt, src))
    assert set(out) == {("A", D1), ("A", D2), ("A", D3)}
    assert out[("A", D2)].close_price == 9.0
    assert out[("A", D2)].pct_change is None  # an incoming NULL overwrites
    assert out[("A", D1)].close_price == 1.0


def test_upsert_idempotent(spark):
    tgt = serving.stamp(spark.createDataFrame([_row("A", D1, 1.0), _row("A", D2, 2.0)], SCHEMA))
    src = spark.createDataFrame([_row("A", D2, 9.0), _row("B", D3, 3.0)], SCHEMA)
    once = serving.upsert(tgt, src).select(*SERVING_COLS)
    twice = serving.upsert(serving.upsert(tgt, src), src).select(*SERVING_COLS)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_append_guarded_never_duplicates(spark):
    tgt = serving.stamp(spark.createDataFrame([_row("A", D1, 1.0)], SCHEMA))
    src = spark.createDataFrame([_row("A", D1, 5.0), _row("A", D2, 2.0)], SCHEMA)
    out = serving.append_guarded(tgt, src)
    assert out.count() == 2
    assert _keyed(out)[("A", D1)].close_price == 1.0
    viol = {r.violation: r.n for r in serving.constraint_violations(out).collect()}
    assert viol["duplicate_key"] == 0


def test_blind_append_is_caught(spark):
    a = spark.createDataFrame([_row("A", D1, 1.0)], SCHEMA)
    viol = {r.violation: r.n for r in serving.constraint_violations(a.unionByName(a)).collect()}
    assert viol["duplicate_key"] == 1


def test_replace_day_deletes_yesterday(spark):
    tgt = serving.stamp(spark.createDataFrame([_row("A", D1, 1.0), _row("A", D2, 2.0)], SCHEMA))
    src = spark.createDataFrame([_row("A", D3, 3.0)], SCHEMA)
    out = _keyed(serving.replace_day(tgt, src, "2024-01-03"))
    assert set(out) == {("A", D1), ("A", D3)}


def test_decimal_cast_rounds_half_up_and_rejects_overflow(spark):
    g = spark.createDataFrame([_row("A", D1, 1.23455, 12345.0), _row("B", D1, 2.0, 1.0)], SCHEMA)
    ok, rejects = serving.serving_cast(g)
    assert [(r.symbol, r.column) for r in rejects.collect()] == [("A", "pct_change")]
    rows = ok.collect()
    assert len(rows) == 1 and rows[0].close_price == Decimal("2.0000")
    typed = serving.serving_typed(g).filter(F.col("symbol") == "A").first()
    assert typed.close_price == Decimal("1.2346") and typed.pct_change is None


def test_staging_projection(spark):
    t = spark.createDataFrame(
        [(7, "A", 1.5, 1.0, None, None, None, 3, "USD", dt.datetime(2024, 1, 1), "s")],
        "offset long, symbol string, price double, open double, day_high double, day_low double, "
        "prev_close double, volume bigint, currency string, event_time timestamp, source string",
    )
    r = serving.staging_raw_ticks(t).first()
    assert r.id == 7 and r.open_price == Decimal("1.0000") and r.price == Decimal("1.5000")


def test_decimals_round_half_away_from_zero_once(spark):
    values = [(-0.03125, "-0.0313"), (0.00004999999996, "0.0000"), (-0.00005, "-0.0001"), (0.00005, "0.0001"), (1.00005, "1.0001")]
    g = spark.createDataFrame([_row(str(i), D1, 1.0, v) for i, (v, _) in enumerate(values)], SCHEMA)
    got = {r.symbol: r.pct_change for r in serving.serving_typed(g).collect()}
    assert got == {str(i): Decimal(w) for i, (_, w) in enumerate(values)}


def _load(spark, path, rows, **options):
    from candela.session import scratch_path

    ok, rejects = serving.serving_cast(spark.createDataFrame(rows, SCHEMA))
    serving.upsert_table(ok, path, scratch_path(spark, "staging"), removed_keys=rejects, **options)
    from candela.schema import SERVING

    return {(r.symbol, r.trade_date): r.close_price for r in spark.read.schema(SERVING).parquet(path).collect()}


def test_table_load_leaves_no_stale_row_and_takes_an_empty_batch(spark):
    from candela.session import scratch_path

    path = scratch_path(spark, "serving")
    assert len(_load(spark, path, [_row("A", D1, 1.0), _row("A", D2, 5.0), _row("B", D2, 6.0)])) == 3
    # the new row of (A, D2) overflows: its old row goes too
    assert set(_load(spark, path, [_row("A", D2, 500.0, 50000.0)])) == {("A", D1), ("B", D2)}
    # every row refused, and the day is left empty
    assert set(_load(spark, path, [_row("A", D1, 1.0, 50000.0)])) == {("B", D2)}
    assert set(_load(spark, path, [])) == {("B", D2)}


def test_table_load_enforces_the_constraints(spark):
    import pytest

    from candela.session import scratch_path

    path = scratch_path(spark, "serving")
    _load(spark, path, [_row("A", D1, 1.0)])
    for bad in ([_row("A", D1, 2.0), _row("A", D1, 3.0)], [_row("WAYTOOLONGSYMBOL", D1, 1.0)], [_row(None, D1, 1.0)]):
        with pytest.raises(ValueError, match="constraints"):
            _load(spark, path, bad)
        assert set(_load(spark, path, [])) == {("A", D1)}


def test_delete_day_touches_no_other_date(spark):
    import os

    from candela.session import scratch_path

    path = scratch_path(spark, "serving")
    _load(spark, path, [_row("A", D1, 1.0), _row("A", D2, 2.0), _row("A", D3, 3.0)])
    local = path.removeprefix("file:")
    before = {d: sorted(os.listdir(f"{local}/{d}")) for d in os.listdir(local) if d.startswith("trade_date")}
    assert set(_load(spark, path, [_row("B", D3, 4.0)], delete_date="2024-01-02")) == {("A", D1), ("A", D3), ("B", D3)}
    after = {d: sorted(os.listdir(f"{local}/{d}")) for d in os.listdir(local) if d.startswith("trade_date")}
    assert set(before) - set(after) == {"trade_date=2024-01-02"}
    assert after["trade_date=2024-01-01"] == before["trade_date=2024-01-01"]


def test_staging_refuses_what_does_not_fit(spark):
    schema = (
        "offset long, symbol string, price double, open double, day_high double, day_low double, "
        "prev_close double, volume bigint, currency string, event_time timestamp, source string"
    )
    t0 = dt.datetime(2024, 1, 1)
    rows = [
        (1, "A", 1e9, None, None, None, None, 1, "USD", t0, "s"),
        (2, None, 1.0, None, None, None, None, 1, "USD", t0, "s"),
        (3, "A", 1.0, 1e12, None, None, None, 1, "US DOLLARS", None, "s" * 40),
        (4, "A", 1.0, None, None, None, None, 1, "USD", t0, "s"),
    ]
    ok, refused = serving.staging_load(spark.createDataFrame(rows, schema))
    assert [r.id for r in ok.collect()] == [4] and "inserted_at" in ok.columns
    assert {r.id: r.reasons for r in refused.collect()} == {
        1: ["overflow_price"],
        2: ["null_symbol"],
        3: ["overflow_open_price", "null_event_time", "currency_too_long", "source_too_long"],
    }
