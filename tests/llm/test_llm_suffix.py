import random
from collections import Counter

import numpy as np
import pytest

from candela.llm import suffix_dedup as S
from candela.llm.common import SpanHasher
from llm_corpora import corpus


def counted(texts, weights, length):
    seen = Counter()
    for t, w in zip(texts, weights, strict=True):
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] += w
    return seen


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = counted(texts, [1] * len(texts), length)
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        hit = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                hit[i : i + length] = [True] * length
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out.append((doc, len(t), sum(hit), spans, bytes(b for b, h in zip(t, hit, strict=True) if not h)))
    return sorted(out, key=str)


def test_repeated_starts_match_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        length, letters = rng.choice([2, 3, 5, 9, 20]), rng.choice([b"a", b"ab", b"abc", bytes(range(256))])
        base = bytes(rng.choice(letters) for _ in range(60))
        texts = []
        for _ in range(rng.randint(1, 8)):
            at = rng.randint(0, 40)
            texts.append(bytes(rng.choice(letters) for _ in range(rng.randint(0, 40))) + base[at : at + rng.randint(0, 30)])
        weights = [rng.randint(1, 2) for _ in texts]
        seen = counted(texts, weights, length)
        want = [[i for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1] for t in texts]
        assert [g.tolist() for g in S.repeated_starts(texts, weights, length)] == want


@pytest.mark.parametrize("stretch", [64, 1 << 20])
def test_every_string_has_one_anchor(monkeypatch, stretch):
    monkeypatch.setattr(S, "STRETCH", stretch)
    rng = np.random.default_rng(1)
    with np.errstate(over="ignore"):
        for size in (0, 39, 40, 41, 300):
            data = rng.integers(97, 100, size).astype(np.uint8)
            place, _, left, right, _ = S.anchors(data, SpanHasher(), 40, 12)
            starts = [s for p, a, b in zip(place, left, right, strict=True) for s in range(p - a, p + b - 40 + 1)]
            assert starts == list(range(max(0, size - 39)))


@pytest.mark.parametrize("seed,length,gram,members,shard", [(1, 40, 12, 2000, 1 << 20), (2, 60, 20, 2, 500), (3, 25, 5, 1, 1)])
def test_dedup_matches_brute_force(make_docs, seed, length, gram, members, shard):
    rows = corpus(seed, 50)
    got = S.suffix_dedup(make_docs(rows), "doc_id", length=length, gram=gram, group_members=members, shard_bytes=shard).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got), key=str) == brute(rows, length)


def test_empty_table_and_text(make_docs):
    assert S.suffix_dedup_digest(make_docs([])).count() == 0
    rows = S.suffix_dedup(make_docs([(1, "é" * 300), (2, "xé" + "é" * 300)]), "doc_id").collect()
    assert {r["doc_id"]: r["kept_text"] for r in rows} == {1: "", 2: "x"}


def test_short_texts_leave_hashes_unsigned():
    hasher = SpanHasher()
    data = np.frombuffer(random.Random(3).randbytes(900), dtype=np.uint8)
    with np.errstate(over="ignore"):
        none, some = (S.anchors(d, hasher, S.LENGTH, S.GRAM) for d in (data[:50], data))
    assert len(none[0]) == 0 < len(some[0]) and [c.dtype for c in none] == [c.dtype for c in some]


def test_many_equal_rows(spark):
    """10,000 rows of one text under one id, and as many without an id: each loses what repeats, once."""
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(1500))
    other = "".join(chr(97 + (i * i * 3 + i // 5) % 26) for i in range(900))
    same = spark.range(10_000).selectExpr("7L AS doc_id", f"'{text}' AS text")
    none = spark.range(10_000).selectExpr("CAST(NULL AS LONG) AS doc_id", f"'{other}' AS text")
    own = spark.createDataFrame([(8, "z" * 10 + text[200:700])], "doc_id long, text string")
    table = S.anchor_table(same.unionByName(none), S.LENGTH, S.GRAM)
    found = S.removed_runs(same.unionByName(none), S.LENGTH, S.GRAM, S.GROUP_MEMBERS, S.SHARD_BYTES)
    assert found.count() == 2 and found.selectExpr("max(size(runs)) AS n").first()["n"] <= table.select("place").distinct().count()
    rows = S.suffix_dedup_digest(same.unionByName(none).unionByName(own)).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count()
    assert sorted(map(tuple, rows.collect()), key=str) == [(7, 1500, 1500, 1, 10_000), (8, 510, 500, 1, 1), (None, 900, 900, 1, 10_000)]
