import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from candela.llm import spelling as S
from candela.llm.common import table
from llm_corpora import SF_SMALL

LOWER = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute(rows):
    """Partners by the words less one letter, each pair checked letter by letter."""
    n = counted(rows)
    less = defaultdict(set)
    for w in n:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            less[key].add(w)
    partners = defaultdict(set)
    for group in less.values():
        for a in group:
            partners[a] |= {b for b in group if b != a and b not in partners[a] and near(a, b)}
    form = {}
    for w in n:
        best = min(partners[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(partners[w]), n.get(form[w])))
    return sorted(out)


def rows_of(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def words_corpus(seed):
    """Few letters and many edits, chains of forms, runs of one letter, accents, capitals, nulls and repeated rows."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("aabé") for _ in range(rng.randint(6, 10))) for _ in range(30)] + ["aaaaaaa", "aaaaaaaa", "ÀÉÎÕÜÿ×÷", "àéîõüÿ×÷"]

    def edited(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abé") + w[i:], w[:i] + rng.choice("abéç") + w[i + 1 :]])

    rows = []
    for i in range(120):
        words = []
        for _ in range(60):
            w = rng.choice(base[:4] if rng.random() < 0.7 else base)
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                w = edited(w)
            words.append(w.upper() if w.isascii() and rng.random() < 0.2 else w)
        rows.append((i, rng.choice([" ", ", ", "\n", "9"]).join(words)))
    long = "ab" * 4000
    rows += [(500, None), (501, ""), (502, " 12 ,"), (None, rows[0][1]), (3, rows[3][1]), (503, f"{long} {long} {long}b {long}b {long[1:]}")]
    return rows


@pytest.mark.parametrize("letters,chunk", [(S.GROUP_LETTERS, S.CHUNK_LETTERS), (40, 300), (1, 1)])
def test_variants_match_brute_force(make_docs, letters, chunk):
    rows = words_corpus(7)
    got = rows_of(S.spelling_variants(make_docs(rows), group_letters=letters, chunk_letters=chunk))
    want = brute(rows)
    assert got == want
    forms = {w: f for w, f, *_ in want}
    assert any(f and forms[f] for f in forms.values()), "the corpus has chains of forms"


def test_given_documents_match_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert len(want) > 1000 and rows_of(S.spelling_variants(docs)) == want


def test_composition_matches_all_pairs():
    """Every pair once, in forward and backward partitions of all small sizes."""
    rng = random.Random(5)
    for _ in range(200):
        short = [rng.choice([0, 1, 2, 3, 4]) for _ in range(3)]
        backward = [rng.random() < 0.5 for _ in short]
        rows = []
        for g, size in enumerate(short):
            gaps = {bytes(rng.choice(b"abc") for _ in range(size + rng.randint(0, 1))) for _ in range(rng.randint(1, 25))}
            rows += [(g, w) for w in sorted(gaps, key=lambda w: rng.random())]
        got = Counter()
        group = np.array([g for g, _ in rows])
        for i, j in S.one_edit_pairs([w for _, w in rows], group, np.array(short), np.array(backward)):
            got.update((min(p), max(p)) for p in zip(i.tolist(), j.tolist(), strict=True))
        want = Counter()
        for x, (g, a) in enumerate(rows):
            for y, (other, b) in enumerate(rows[:x]):
                a_, b_ = sorted((a, b), key=len)
                end = backward[g] and len(a_) < len(b_) and b_[:-1] == a_
                if g == other and near(a, b) and len(a_) == short[g] and not end:
                    want[y, x] += 1
        assert got == want


def test_empty_table(make_docs):
    assert S.spelling_variants(make_docs([])).collect() == []
    assert S.spelling_variants(make_docs([(1, None), (2, "short words only")])).collect() == []
