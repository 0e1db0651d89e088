import random
import zlib

import numpy as np
import pytest

from candela.llm import packing as P
from llm_corpora import corpus


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_packing(make_docs):
    from tokenizers import Tokenizer

    rows = corpus(4) + [(900, "word " * 5000), (901, "<|endoftext|> It's 12   x\x85\x1c é İ ß…"), (902, "́a ́b")]
    tokenizer = Tokenizer.from_file(P.tokenizer_path())
    want = []
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((doc, k, at, len(part), zlib.crc32(part.tobytes())))
    got = P.best_fit_packing(make_docs(rows)).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    bins = check_places(got, 2048)
    assert bins <= sum(w[3] for w in want) / 2048 * 1.1 + 1


@pytest.mark.parametrize("per_task", [10_000, 300])
def test_rounds_join_underfull_bins(spark, per_task):
    rng = random.Random(2)
    sizes = [rng.choice([rng.randint(1, 100), rng.randint(1, 60), 100]) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, length long").repartition(8)
    rows = P.pack(items, 100, fan_in=2, items_per_task=per_task).collect()
    assert len(rows) == 3000 and sorted(r["length"] for r in rows) == sorted(sizes)
    assert check_places(rows, 100) <= sum(sizes) / 100 * 1.03 + 2


def test_unjoinable_bins_end(spark):
    items = spark.range(2000).selectExpr("id AS item", "60L AS length")
    rows = P.pack(items, 100, items_per_task=500).collect()
    assert check_places(rows, 100) == 2000


def test_best_fit_takes_the_fullest_bin():
    bins, offsets, fill = P.best_fit(np.array([60, 50, 40, 30, 20]), 100)
    assert fill.tolist() == [100, 100] and bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 60, 50, 80]


def test_empty_table(make_docs):
    assert P.best_fit_packing(make_docs([])).count() == 0
