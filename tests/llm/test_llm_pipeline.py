import os
import random
import time
from collections import Counter

import corpus_pipeline as C
import test_llm_decontamination as test_decontamination
import test_llm_jaccard as test_jaccard
import test_llm_packing as test_packing
from candela.llm import common
from candela.llm.common import stored, table
from llm_corpora import SF_SMALL


def test_stages_match_brute_force(spark):
    """Each stage on its own input, which is what its predecessor returned."""
    docs = table(spark, SF_SMALL, "documents")
    rows = {}
    for name, stage in C.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_SMALL), "test-stage")
        assert docs.columns == list(C.COLUMNS)
        rows[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    quality, unique, cut, clean = rows.values()
    assert 0 < len(quality) < table(spark, SF_SMALL, "documents").count()
    components = test_jaccard.brute(quality, C.SHINGLE_WORDS, C.SIMILAR_PERCENT)
    assert {d for d, _ in unique} == {d for d, _, least in components if d == least} and len(unique) == len({c for *_, c in components})
    kept = without_repeats(unique)
    assert {d: t.split() for d, t in cut} == {d: kept[d] for d, t in unique if kept[d] or not t.split()}
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    bad = {d for d, *_, flag in test_decontamination.brute(cut, items) if flag}
    assert {d for d, _ in clean} == {d for d, _ in cut} - bad
    packed = C.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {r["doc_id"] for r in packed} == {d for d, _ in clean}
    test_packing.check_places(packed, 2048)


def test_odd_rows(spark, make_docs):
    """Null ids, repeated rows, null and empty texts, clashing columns and an empty table."""
    text = " ".join(f"word{i}" for i in range(80))
    other = " ".join(f"else{i}" for i in range(80))
    docs = make_docs([(1, text), (1, text), (None, other), (2, None), (3, "")])
    kept = C.keep_one_of_near_copies(spark, docs, SF_SMALL)
    assert sorted((r["doc_id"], r["text"]) for r in kept.filter("doc_id is not null").collect()) == [(1, text), (2, None), (3, "")]
    assert [r["text"] for r in kept.filter("doc_id is null").collect()] == [other]
    for _, stage in C.STAGES:
        stage(spark, docs, SF_SMALL).collect()
        assert stage(spark, make_docs([]), SF_SMALL).count() == 0


def without_repeats(rows, least=51):
    """Brute force: the words that no repeated string of ``least`` words covers."""
    words = [t.split() for _, t in rows]
    seen = Counter(tuple(w[i : i + least]) for w in words for i in range(len(w) - least + 1))
    out = {}
    for (doc, _), w in zip(rows, words, strict=True):
        gone = {k for i in range(len(w) - least + 1) if seen[tuple(w[i : i + least])] > 1 for k in range(i, i + least)}
        out[doc] = [x for k, x in enumerate(w) if k not in gone]
    return out


def test_passages_of_more_than_fifty_words_are_cut(spark, make_docs):
    def words(name, n, width=1):
        return [f"{name}{i}".ljust(width, "x") for i in range(n)]

    short, long, wide = words("a", 51), words("b", 60, 9), words("c", 50, 30)
    unspaced = "".join(chr(0x4E00 + i) for i in range(60))
    rows = [
        (1, " ".join(words("p", 9) + short + words("q", 9))),
        (2, " ".join([*words("r", 30), *short]) + "\n"),
        (3, " ".join(words("s", 5) + long + words("t", 70))),
        (4, " ".join(long[:30]) + "\n" + " ".join(long[30:] + words("u", 3))),
        (5, " ".join(words("v", 5) + wide + words("w", 5))),
        (6, " ".join(wide + short[1:] + ["y"])),
        (7, f"é {unspaced} ü"),
        (8, unspaced),
        (9, f"{unspaced[:50]} z"),
        (10, " ".join(words("only", 200))),
    ]
    got = {r["doc_id"]: r["text"] for r in C.cut_repeated_passages(spark, make_docs(rows), SF_SMALL).collect()}
    want = without_repeats(rows[:6] + rows[9:])
    assert {d: got[d].split() for d in want} == want
    assert [len(want[d]) for d in (1, 2, 3, 4, 5, 6, 10)] == [18, 30, 75, 3, 60, 101, 200]
    assert got[1] == " ".join(words("p", 9)) + "  " + " ".join(words("q", 9)) and got[5] == rows[4][1]
    assert 8 not in got and (got[7], got[9]) == ("é  ü", rows[8][1])


def test_passages_of_the_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").filter("text is not null").collect()]
    got = C.cut_repeated_passages(spark, table(spark, SF_SMALL, "documents").filter("text is not null"), SF_SMALL).collect()
    want = without_repeats(rows)
    assert {r["doc_id"]: r["text"].split() for r in got} == {d: w for d, w in want.items() if w or not dict(rows)[d].split()}


def files_under(*folders):
    return {os.path.join(at, name) for top in folders for at, _, names in os.walk(top.removeprefix("file://")) for name in names}


def test_passages_are_found_without_a_second_copy_of_the_texts(spark, make_docs, monkeypatch):
    sizes, remove = [], common.remove_path

    def weighed(spark, path):
        sizes.append(sum(os.path.getsize(f) for f in files_under(path)))
        remove(spark, path)

    monkeypatch.setattr(common, "remove_path", weighed)
    draw = random.Random(7)
    rows = [(i, " ".join("".join(draw.choices("abcdefghijklmnop", k=5)) for _ in range(1000))) for i in range(200)]
    rows += [(1000, " ".join(rows[0][1].split()[:60]) + " end"), (1001, "short")]
    got = {r["doc_id"]: r["text"].split() for r in C.cut_repeated_passages(spark, make_docs(rows), SF_SMALL).collect()}
    assert got == without_repeats(rows) and got[1000] == ["end"] and len(got[0]) == 940
    assert 0 < sum(sizes) < 0.5 * sum(len(t) for _, t in rows)


def test_a_written_table_leaves_no_shuffle_files(spark):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    before = files_under(*folders)
    counts = stored(spark.range(20_000).selectExpr("id % 100 AS k").groupBy("k").count(), "test-counts")
    for _ in range(50):
        left = {f for f in files_under(*folders) - before if "shuffle_" in f}
        if not left:
            break
        time.sleep(0.1)
    assert not left and counts.count() == 100


def test_stages_after_the_cut_match_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    for _, stage in C.STAGES[:2]:
        docs = stage(spark, docs, SF_SMALL)
    docs = stored(docs, "test-unique")
    cut = stored(C.cut_repeated_passages(spark, docs, SF_SMALL), "test-stage")
    unique, rows = ([(r["doc_id"], r["text"]) for r in df.collect()] for df in (docs, cut))
    want = without_repeats(unique)
    assert {d: t.split() for d, t in rows} == {d: want[d] for d, t in unique if want[d] or not t.split()}
    clean = stored(C.keep_uncontaminated(spark, cut, SF_SMALL), "test-stage")
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    bad = {d for d, *_, flag in test_decontamination.brute(rows, items) if flag}
    assert bad and {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows} - bad
    packed = C.packed(spark, clean, SF_SMALL).collect()
    test_packing.check_places(packed, 2048)
