import hashlib
import random
import re

import pytest

from candela.llm.decontamination import contamination, contamination_digest
from llm_corpora import corpus

ITEMS = "item_id long, text string, n_words long, shard string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def fixture(seed):
    rng = random.Random(seed)
    rows = corpus(seed, 60)
    items = []
    for k in range(12):
        source = words(rng.choice([t for _, t in rows if t and len(t) > 100]))
        at = rng.randrange(max(1, len(source) - 20))
        text = " ".join(source[at : at + rng.choice([5, 13, 18])]).upper().replace(" ", rng.choice([" ", "--", "\n"]))
        items.append((k, text if rng.random() < 0.7 else text + " unseen " + text))
    rows += [(500 + k, f"some words {items[k][1]}") for k in range(3)]
    return rows, [*items, (90, None), (91, "?!"), (92, ""), (3, items[3][1]), (None, items[1][1]), (100, items[2][1])]


def brute(rows, items, window=13):
    wanted = {}
    for i, text in items:
        w = words(text)
        n = min(window, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            if i is not None:
                wanted.setdefault(tuple(w[at : at + n]), set()).add(str(i))
    out = []
    for doc, text in rows:
        w = words(text)
        hit, found = set(), set()
        for gram, names in wanted.items():
            for at in range(len(w) - len(gram) + 1):
                if tuple(w[at : at + len(gram)]) == gram:
                    hit |= set(range(at, at + len(gram)))
                    found |= names
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, make_docs, seed):
    rows, items = fixture(seed)
    benchmark = spark.createDataFrame([(*i, 3, "x") for i in items], ITEMS)
    got = contamination_digest(make_docs(rows), benchmark).collect()
    want = brute(rows, items)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert any(w[-1] for w in want)


def test_blocks_of_items_give_the_same(spark, make_docs):
    rows, items = fixture(3)
    benchmark = spark.createDataFrame([(*i, 3, "x") for i in items], ITEMS)
    one, many = (contamination(make_docs(rows), benchmark, block_items=b).drop("near_items").collect() for b in (1000, 3))
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_near_matches_in_any_order(spark, make_docs):
    docs = make_docs([(1, "a " * 30 + "delta beta gamma x alpha"), (2, "alpha " + "b " * 50 + "beta gamma delta"), (3, "alpha beta gamma delta")])
    benchmark = spark.createDataFrame([(7, "Alpha beta-gamma delta", 3, "x")], ITEMS)
    got = {r["doc_id"]: (r["items"], r["near_items"]) for r in contamination(docs, benchmark, near=8).collect()}
    assert got == {1: ([], ["7"]), 2: ([], []), 3: (["7"], ["7"])}


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], ITEMS)
    assert contamination_digest(make_docs([]), none).count() == 0
    assert [r["n_hit"] for r in contamination_digest(make_docs([(1, "a b")]), none).collect()] == [0]


@pytest.mark.parametrize("block_items", [1000, 1])
def test_items_without_an_id_count_in_the_hit_words(spark, make_docs, block_items):
    own = " ".join(f"own{i}" for i in range(15))
    benchmark = spark.createDataFrame([(None, own, 15, "x"), (7, "seven words stand in this item alone", 7, "x")], ITEMS)
    docs = make_docs([(1, f"before {own} after"), (2, f"{own} seven words stand in this item alone"), (3, "clean")])
    rows = contamination(docs, benchmark, block_items=block_items).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["near_items"], r["contaminated"]) for r in rows}
    assert got == {1: (17, 15, [], [], True), 2: (22, 22, ["7"], ["7"], True), 3: (1, 0, [], [], False)}


def test_one_python_step_a_stage(spark, make_docs):
    """What matches is written before it is summed up: chained Python steps would take two workers a core."""
    rows, items = fixture(1)
    benchmark = spark.createDataFrame([(*i, 3, "x") for i in items], ITEMS)
    for options in ({}, {"block_items": 5}):
        plan = contamination(make_docs(rows), benchmark, **options)._jdf.queryExecution().executedPlan().toString()
        stages = re.split("Exchange", plan)
        assert all(len(re.findall("MapInPandas|FlatMapGroupsInPandas", s)) < 2 for s in stages) and "MapInPandas" in plan
