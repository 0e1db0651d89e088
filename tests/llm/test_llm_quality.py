import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from candela.llm.common import SpanHasher, table
from candela.llm.pu_classifier import pu_quality
from candela.llm.quality_rules import Forest, calibrated, quality_rules, statistics
from llm_corpora import SF_ORACLE, corpus

LABELS = "doc_id long, quality int, toxic int"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n")]
    seen, dup = set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


@pytest.mark.parametrize("seed", [1, 2])
def test_statistics_match_brute_force(seed):
    texts = [t for _, t in corpus(seed)] + ["a\na\n a\nb\n\n\n", "# é|< é", "x y z x y z", "\x1c a b\x85"]
    hasher = SpanHasher()
    with np.errstate(over="ignore"):
        for t in texts:
            assert statistics(t or "", hasher)[:5] == plain(t), t


def test_quality_rules_defined_results(spark, make_docs):
    good = " ".join(f"word{i}" for i in range(60))
    docs = make_docs([(1, None), (2, ""), (3, good), (3, good), (None, good), (2**60 + 1, "ab " * 100)])
    rows = quality_rules(docs, spark.createDataFrame([], LABELS), "doc_id").collect()
    assert sorted((r["doc_id"] or -1, r["base_failed"], r["kept"]) for r in rows) == [
        (-1, False, True), (1, True, False), (2, True, False), (3, False, True), (3, False, True), (2**60 + 1, True, False),
    ]
    assert quality_rules(make_docs([]), spark.createDataFrame([(1, 1, 0)], LABELS), "doc_id").count() == 0


def test_forest_finds_what_is_odd():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(400, 3)), rng.normal(size=(8, 3)) + 9])
    score = Forest(x, 50, 128, 1).score(x)
    assert score[400:].min() > np.quantile(score[:400], 0.99)
    cut = calibrated(score, np.arange(408) < 400, 5.0)
    assert ((score > cut) == (np.arange(408) >= 400)).mean() > 0.98


def test_quality_rules_on_labels(spark):
    labels = table(spark, SF_ORACLE, "labels")
    rows = quality_rules(table(spark, SF_ORACLE, "documents"), labels, "doc_id").join(labels, "doc_id").collect()
    inner = [r for r in rows if not r["base_failed"]]
    assert np.mean([r["kept"] for r in inner if r["quality"] == 1]) > 0.95
    assert np.mean([r["kept"] for r in inner if r["quality"] == 0]) < 0.2


def test_pu_held_out_accuracy(spark):
    labels = table(spark, SF_ORACLE, "labels")
    rows = pu_quality(table(spark, SF_ORACLE, "documents"), labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_pu_ignores_held_out_labels(spark):
    docs, labels = table(spark, SF_ORACLE, "documents"), table(spark, SF_ORACLE, "labels")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id AS string)) % 4 = 2, 1 - quality, quality) AS quality", "toxic")
    a, b = (dict(pu_quality(docs, x).select("doc_id", "score").collect()) for x in (labels, turned))
    assert a == b


def test_pu_defined_results(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (None, "some words"), (2, "")])
    rows = pu_quality(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(rows) == 4 and {r["score"] for r in rows} == {0.5}
    assert pu_quality(docs, spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, 0)], LABELS)).count() == 4
    assert pu_quality(make_docs([]), spark.createDataFrame([], LABELS)).count() == 0


def test_repeated_ids_give_one_training_row(spark, make_docs):
    """A labelled id on very many rows sends one of them to the driver."""
    from candela.llm.quality_rules import sample_labelled

    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text)] * 3000 + [(1, "z " + text), (2, text + " x")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (1, 1, 0)], LABELS)
    sample = sample_labelled(make_docs(rows), labels, 20_000)
    assert len(sample) == 2 and sorted(sample["quality"]) == [0, 1]
    scored = pu_quality(make_docs(rows), labels)
    assert scored.count() == len(rows)


def test_sums_over_a_tree_of_tasks(spark, make_docs, monkeypatch):
    """The fit is the same whether tasks send their sums or a tree of tasks adds them first."""
    from candela.llm import pu_classifier

    rows = [(i, t) for i, (_, t) in enumerate(corpus(4, 80))]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], LABELS)
    docs = make_docs(rows).repartition(5)
    direct = {r["doc_id"]: r["score"] for r in pu_quality(docs, labels).collect()}
    monkeypatch.setattr(pu_classifier, "DIRECT_TASKS", 0)
    tree = {r["doc_id"]: r["score"] for r in pu_quality(docs, labels).collect()}
    assert direct.keys() == tree.keys() and max(abs(direct[i] - tree[i]) for i in direct) < 1e-6


@pytest.mark.parametrize("reject_cost", [0.2, 5.0])
def test_cut_over_all_scores(spark, reject_cost):
    """The distributed search finds the cut of the plain one, ties of scores and both ends included."""
    from candela.llm.quality_rules import calibrated_cut

    def cut(score, good):
        rows = spark.createDataFrame([(float(s), int(g), int(not g)) for s, g in zip(score, good)], "score double, good long, bad long")
        return calibrated_cut(rows.groupBy("score").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), reject_cost)

    rng = np.random.default_rng(3)
    score = rng.uniform(0.3, 0.9, 500)
    score[100:120] = score[:20]
    assert cut(score, good := score + rng.normal(0, 0.1, 500) < 0.6) == calibrated(score, good, reject_cost)
    assert cut(score[:50], score[:50] > 0.6) == calibrated(score[:50], score[:50] > 0.6, reject_cost)
    assert cut(score[:50], score[:50] > 0) == float("inf") == cut(score[:50], score[:50] > 1)


def test_threshold_comes_from_every_labelled_row(spark, make_docs, monkeypatch):
    """Each labelled document moves the threshold, also when the trees draw from fewer."""
    from candela.llm import quality_rules as Q

    monkeypatch.setattr(Q, "TREES", 2)
    monkeypatch.setattr(Q, "SUBSAMPLE", 8)
    monkeypatch.setattr(Q, "SAMPLE_ROWS", 16, raising=False)
    rows = [(i, " ".join(f"w{j * (i % 7 + 1) % (60 + i)}" for j in range(60 + i))) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(120)], LABELS)
    docs = make_docs(rows)
    seen = []
    found = Q.calibrated_cut
    monkeypatch.setattr(Q, "calibrated_cut", lambda counts, cost: seen.append(counts.agg(F.sum("good"), F.sum("bad")).first()) or found(counts, cost))
    forest, threshold = Q.fit(docs, labels)
    passing = Q.document_statistics(docs, "doc_id").filter(~Q.base_failed())
    assert sum(seen[0]) == passing.count() > 16
    x = passing.join(labels, "doc_id").select("features", "quality").toPandas()
    score, good = forest.score(np.array(x["features"].tolist())), x["quality"].to_numpy() == 1
    assert threshold == calibrated(score, good, 5.0)
