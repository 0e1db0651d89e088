import math
import random

import duckdb
import numpy as np
import pytest

from candela.llm import hard_negatives as H
from candela.llm.common import table
from llm_corpora import SF_ORACLE, SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, mark string, score double, vector string"


def brute(rows, k=5):
    taken = set()
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        taken.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = []
    for a, label, v in taken:
        if a % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), i, other) for i, other, w in taken if i != a]  # noqa: B905 - shorter ones end in zeros
        scored.sort()
        for s, p, _ in [r for r in scored if r[2] == label][:k]:
            window = [(i, -n) for n, i, other in scored if other != label and -80 * s <= -100 * n <= -100 * s]
            out += [(a, p, rank, i, -s, n) for rank, (i, n) in enumerate(window[:k], 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


@pytest.fixture()
def make_rows(spark):
    return lambda rows: spark.createDataFrame([(i, v, label, "m", 1.0, "v") for i, v, label in rows], SCHEMA)


def corpus(seed, n, dims, labels=10, hot=False):
    """Clustered vectors with ties, repeats, nulls, non-finite components and short vectors."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        v = [x + rng.gauss(0, 0.3) for x in c]
        if hot and i % 3 == 0:
            v = centres[0]  # a third of all rows are one vector
        rows.append((i, v, rng.randrange(labels)))
    rows += [rows[0], rows[5], (n + 1, None, 1), (n + 2, [], 2), (None, rows[0][1], 3), (n + 4, rows[1][1], None)]
    rows += [(n + 5, [math.nan] * dims, 1), (n + 6, [math.inf] * dims, 1), (n + 7, [None] + [0.1] * (dims - 1), 1), (n + 8, [0.5] * (dims - 1), 1)]
    return rows


@pytest.mark.parametrize("seed,n,dims,block,sample,hot", [(1, 900, 24, 8192, 2048, False), (2, 700, 40, 3, 20, False), (3, 900, 8, 4, 1, True)])
def test_negatives_match_brute_force(make_rows, seed, n, dims, block, sample, hot):
    rows = corpus(seed, n, dims, hot=hot)
    got = rows_of(H.hard_negatives(make_rows(rows), anchor_block=block, sample_rows=sample))
    assert got == brute(rows) and len({a for a, *_ in got}) > 4


def test_few_rows_of_a_label(make_rows):
    """Anchors with fewer positives than five, none, only negative scores, and zero vectors."""
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 2), (2, [0.5, 0.5], 2), (100, [-1.0, 0.0], 4), (101, [1.0, 0.0], 4), (200, [0.0, 0.0], 5), (201, [1.0, 1.0], 5), (3, [0.0, 0.0], 6)]
    assert rows_of(H.hard_negatives(make_rows(rows))) == brute(rows)


def test_given_tables_match_the_sql(spark):
    for sf in (SF_SMALL, SF_ORACLE):
        con = duckdb.connect()
        con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
        rows = con.sql(H.hard_negatives_sql()).fetchall()
        assert rows and rows_of(H.hard_negatives(table(spark, sf, "embeddings"))) == sorted(rows)


def test_reaching_loses_nothing():
    rng = np.random.default_rng(4)
    for dims in (1, 5, 33):
        a, x = (rng.normal(0, 50, (n, dims)).astype(np.int64).astype(np.float64) for n in (20, 300))
        scores = a @ x.T
        for low in (-np.inf, 0.0, scores.max() * 0.3, scores.max(), scores.max() + 5):
            lower = np.full(20, low)
            lower[::3] = scores.max() * 0.8
            q, r = H.reaching(a, lower, x, band=4)
            got = set(zip(q.tolist(), r.tolist(), strict=True))
            assert len(got) == len(q) and got >= set(zip(*(c.tolist() for c in np.nonzero(scores >= lower[:, None])), strict=True))


def test_pruning_saves_most_pairs():
    rng = np.random.default_rng(4)
    x = rng.normal(0, 30, (2000, 64)).round()
    q, r = H.reaching(x[:50], 0.95 * (x[:50] ** 2).sum(axis=1), x)
    assert {(i, i) for i in range(50)} <= set(zip(q.tolist(), r.tolist(), strict=True)) and len(q) < 50 * 2000 / 64


def test_empty_and_too_large(make_rows):
    assert H.hard_negatives(make_rows([])).collect() == []
    assert H.hard_negatives(make_rows([(1, [0.5], 1)])).collect() == []
    with pytest.raises(ValueError):
        H.hard_negatives(make_rows([(100, [3e30], 1), (1, [3e30], 1)]))
