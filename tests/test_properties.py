"""Property tests: window indicators vs a direct restatement of the scalar spec."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from candela.operators import gold as G
from candela.operators import indicators as I

prices = st.lists(st.integers(min_value=1, max_value=500).map(float), min_size=1, max_size=30)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


# Plain restatements of the indicator definitions, used only as test expectations.
def sma(ps, n):
    return None if n <= 0 or len(ps) < n else sum(ps[-n:]) / n


def rsi(ps, period):
    if len(ps) < period + 1:
        return None
    w = ps[-(period + 1):]
    d = [b - a for a, b in zip(w, w[1:])]
    g = sum(max(x, 0) for x in d) / period
    lo = sum(max(-x, 0) for x in d) / period
    return 100.0 if lo == 0 else 100 - 100 / (1 + g / lo)


def pop_vol(ps):
    if len(ps) < 2:
        return None
    m = sum(ps) / len(ps)
    return math.sqrt(sum((p - m) ** 2 for p in ps) / len(ps))


def _frame(spark, ps):
    d0 = dt.date(2024, 1, 1)
    rows = [("P", d0 + dt.timedelta(days=i), p) for i, p in enumerate(ps)]
    return spark.createDataFrame(rows, "symbol string, trade_date date, close_price double")


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@SETTINGS
@given(ps=prices, n=st.integers(min_value=0, max_value=6), period=st.integers(min_value=2, max_value=14))
def test_indicators_match_spec_at_every_row(spark, ps, n, period):
    df = I.with_volatility_rolling(I.with_rsi_strict(I.with_sma(_frame(spark, ps), n), period), 5)
    rows = df.orderBy("trade_date").collect()
    for i, r in enumerate(rows):
        hist = ps[: i + 1]
        assert _close(r.sma, sma(hist, n))
        assert _close(r.rsi, rsi(hist, period))
        assert _close(r.volatility, pop_vol(hist[-5:]))


@SETTINGS
@given(ps=prices)
def test_pipeline_rsi_bounds_and_agreement(spark, ps):
    rows = I.with_rsi_strict(G.with_rsi(G.with_prev_close(_frame(spark, ps))), 14).orderBy("trade_date").collect()
    for r in rows:
        assert 0 <= r.rsi_14 <= 100
        if r.rsi is not None:
            assert math.isclose(r.rsi, r.rsi_14, rel_tol=1e-9, abs_tol=1e-9)


@SETTINGS
@given(ps=prices)
def test_pct_change_matches_spec(spark, ps):
    rows = G.with_pct_change(G.with_prev_close(_frame(spark, ps))).orderBy("trade_date").collect()
    for i, r in enumerate(rows):
        want = None if i == 0 or ps[i - 1] == 0 else (ps[i] - ps[i - 1]) / ps[i - 1] * 100
        assert _close(r.pct_change, want)


# ---- JSON contract: Spark validation vs a direct restatement of the schema rules
from candela.schema import FIELD_JSON_TYPES, REQUIRED_FIELDS  # noqa: E402

_values = st.one_of(
    st.text(max_size=5),
    st.integers(min_value=-(10**6), max_value=10**6),
    st.floats(allow_nan=False, allow_infinity=False, width=32),
    st.booleans(),
    st.none(),
    st.lists(st.integers(), max_size=2),
)
_ticks = st.dictionaries(
    st.sampled_from(sorted(FIELD_JSON_TYPES) + ["extra"]), _values, max_size=len(FIELD_JSON_TYPES) + 1
)


def _json_type(v):
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, (int, float)):
        return "number"
    if isinstance(v, str):
        return "string"
    if v is None:
        return "null"
    return "array"


def _expected_errors(obj):
    errs = []
    for key, want in FIELD_JSON_TYPES.items():
        if key in REQUIRED_FIELDS and key not in obj:
            errs.append(f"missing:{key}")
        if key in obj and _json_type(obj[key]) != want:
            errs.append(f"type:{key}")
    return errs


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(batch=st.lists(_ticks, min_size=1, max_size=25))
def test_validation_matches_schema_rules(spark, batch):
    import json

    from candela.operators import ingest

    df = spark.createDataFrame([(json.dumps(o), i) for i, o in enumerate(batch)], "json_value string, offset long")
    got = {r.offset: r.errors for r in ingest.validate(df).collect()}
    for i, o in enumerate(batch):
        assert got[i] == _expected_errors(o), (o, got[i])
