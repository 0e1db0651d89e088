import random

import pytest

from candela.llm import jaccard_join as J
from candela.llm.components import connected_components
from candela.llm.jaccard_join import jaccard_components
from llm_corpora import corpus


def brute(rows, size, percent):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("seed,size,percent,last", [(1, 4, 85, 1 << 19), (2, 2, 60, 5), (3, 5, 80, 0)])
def test_components_match_brute_force(make_docs, seed, size, percent, last):
    rows = corpus(seed, 90)
    got = jaccard_components(make_docs(rows), size, percent, ordered_last=last).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, size, percent)


def test_chain_of_near_copies(make_docs):
    """Neighbours are linked, the ends are not similar: the whole chain is one component."""
    words = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(30):
        rows.append((100 - k, " ".join(words)))
        words[(k * 4) % 120] = f"n{k}"
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(make_docs(rows)).collect()}
    assert got == {d: m for d, _, m in brute(rows, 4, 85)}
    assert set(got.values()) == {71}


def test_many_near_copies_of_one_text(make_docs):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for k in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(100)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    got = jaccard_components(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 4, 85)


def test_empty_table(make_docs):
    assert jaccard_components(make_docs([])).count() == 0


def test_connected_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (8, 10), (10, 11), (11, 12), (3, 2)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 8: 8, 9: 8, 10: 8, 11: 8, 12: 8}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_buckets_follow_the_text(spark, make_docs, monkeypatch):
    """More text, more buckets; the result doesn't depend on them."""
    rows = corpus(6, 40)
    few = sorted(map(tuple, J.jaccard_components(make_docs(rows)).collect()), key=str)
    monkeypatch.setattr(J, "BUCKET_TEXT", 1)
    assert J.bucket_bits(make_docs(rows)) > 12
    assert sorted(map(tuple, J.jaccard_components(make_docs(rows)).collect()), key=str) == few


def test_workers_that_cannot_import_the_package(tmp_path):
    """Tasks need no candela on their path: the driver puts it on its own path only."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import os, sys
os.environ.pop("PYTHONPATH", None)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
def importable(_):
    try:
        import candela
        yield 1
    except ImportError:
        yield 0
sys.path.insert(0, {repo!r})
assert sum(spark.sparkContext.parallelize([0, 1], 2).mapPartitions(importable).collect()) == 0
from candela.llm.jaccard_join import jaccard_components
docs = spark.createDataFrame([(i, "a b c d e f g " + "x" * (i % 2)) for i in range(6)], "doc_id long, text string")
assert {{r["component_id"] for r in jaccard_components(docs).collect()}} == {{0, 1}}
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
