"""Spelling variants by finite-state composition.

The vocabulary acceptor A is composed with a one-edit transducer T and with A
again; what A o T o A accepts are the pairs of words one edit apart. The machine
is never built whole. Its start is parted into initial states: two words one
edit apart agree before the edit and after it, so they agree in the first half
of the shorter word, or in its last half. A forward partition starts A in the
state that a common first half leads to; a backward partition ends it in the
state that a common last half comes from. What is left of a word between the
two is its gap, and a partition composes the minimised acceptor of its gaps.
The length of the shorter word belongs to the partition, so both words know
which letters they must share.

Tasks stream through their partitions in key order and build one minimised
acceptor, with an initial state for each partition, over a chunk of them. The
composition is enumerated breadth first, one letter a step, over arrays of
configurations (state, edits, state); counts of accepted words on the
transitions turn a path into the number of its word. Each pair is accepted once:
an inserted letter counts as the last of its run, and a backward partition leaves
insertions at the end of its gaps to the forward one.

A partition of more than ``group_letters`` letters is parted again by halves of
its gaps, down to gaps of one letter, whose number the alphabet bounds. So no task
gathers an unbounded group, and no pairs of a group are compared that the
machine doesn't lead to.

States are merged by 64-bit hashes of their languages; accepted pairs are exact
words of the vocabulary and an exact distance check follows.

Defined results: null and empty texts and texts without letters give no words;
repeated rows count as often as they stand; a null doc_id is written as the
empty text before the colon; runs of any length are words; ties between near
words of equal n go to the smallest in code-point order; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import mix64, partitions, stored, text_or_empty

MIN_LENGTH = 7
MIN_COUNT = 2
#: One (document, run) in so many loses a letter.
DELETE_ONE_IN = 31
#: A form is at least so many times as frequent as its word.
TIMES = 10
#: Distinct words that a task counts before it sends them on.
HELD_WORDS = 300_000
#: Letters of the gaps that one partition, and one chunk of partitions, may hold.
GROUP_LETTERS = 250_000
CHUNK_LETTERS = 400_000

ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n) over all rows; runs too short to be words are never sent."""
    letters = re.compile(r"[a-zÀ-ÿ]{%d,}" % min_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                start = zlib.crc32(f"{doc}:".encode())
                for word, n in Counter(letters.findall(text.encode().translate(ASCII_LOWER).decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % DELETE_ONE_IN == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_length:
                            continue
                    counts[word] += n
            if len(counts) >= HELD_WORDS:
                yield flush()
                counts = Counter()
        yield flush()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), text_or_empty().alias("_text"))
    sent = rows.mapInArrow(run, "word string, n long")
    return sent.groupBy("word").agg(F.sum("n").alias("n"))


def in_partitions(words: DataFrame) -> DataFrame:
    """Each row (word, n, short, lo, hi) under the keys of its two halves.

    ``short`` is the length of the partition's shorter words; the first ``lo`` and last ``hi`` letters are shared, the
    gap between them is cut in halves.
    """
    gap = F.col("short") - F.col("lo") - F.col("hi")
    half = F.floor(gap / 2).cast("int")
    ends = F.array(
        F.struct((F.col("lo") + half).alias("lo"), F.col("hi").alias("hi")),
        F.struct(F.col("lo").alias("lo"), (F.col("short") - F.col("lo") - half).alias("hi")),
    )
    rows = words.withColumn("_end", F.explode(ends)).select("word", "n", "short", "_end.lo", "_end.hi")
    shared = F.concat_ws("*", "short", F.expr("left(word, lo)"), F.expr("right(word, hi)"))
    return rows.withColumn("key", shared)


def partitioned(vocabulary: DataFrame, min_length: int, group_letters: int) -> DataFrame:
    """(key, word, n, short, lo, hi): every word in the partitions it may have a partner in."""
    size = F.length("word")
    shorts = F.when(size > min_length, F.array(size, size - 1)).otherwise(F.array(size))
    start = vocabulary.select("word", "n", F.explode(shorts).alias("short"), F.lit(0).alias("lo"), F.lit(0).alias("hi"))
    rows, ready = in_partitions(start), None
    while True:
        gap = F.length("word") - F.col("lo") - F.col("hi")
        sizes = rows.groupBy("key").agg(F.sum(gap).alias("letters"), F.max(F.col("short") - F.col("lo") - F.col("hi")).alias("gap"))
        large = stored(sizes.filter(f"letters > {group_letters} AND gap > 1").select("key"), "large")
        if large.isEmpty():
            return rows if ready is None else ready.unionByName(rows)
        small = rows.join(large, "key", "left_anti")
        ready = small if ready is None else ready.unionByName(small)
        rows = stored(in_partitions(rows.join(large, "key", "left_semi")), "parted")


class Acceptor:
    """Minimised acceptor of the gaps of several partitions, each with its own initial state.

    ``gaps`` are byte strings without zero bytes, ``group`` their ascending partition numbers; gaps of a partition are distinct.
    """

    def __init__(self, gaps: list[bytes], group: np.ndarray) -> None:
        n = len(gaps)
        lengths = np.array([len(g) for g in gaps])
        width = max(1, int(lengths.max()))
        text = np.array(gaps, dtype=f"S{width}")
        order = np.argsort(text, kind="stable")
        self.order = order = order[np.argsort(group[order], kind="stable")]
        letters = text[order].view(np.uint8).reshape(n, width)
        lengths, group = lengths[order], group[order]
        common = np.full(n, -1, dtype=np.int64)  # letters shared with the gap before, -1: a new partition
        together = group[1:] == group[:-1]
        common[1:] = np.where(together, np.logical_and.accumulate(letters[1:] == letters[:-1], axis=1).sum(axis=1), -1)
        # Nodes by depth: the gaps that begin a node, and each gap's node.
        node = np.full((width + 1, n), -1, dtype=np.int64)
        heads, total = [], 0
        for depth in range(width + 1):
            new = (common < depth) & (lengths >= depth)
            heads.append(np.flatnonzero(new))
            node[depth] = total + np.cumsum(new) - 1
            total += len(heads[-1])
        language = np.zeros(total, dtype=np.uint64)
        self_words = np.zeros(total, dtype=np.int64)
        final = np.zeros(total, dtype=bool)
        least = np.full(total, 1 << 40, dtype=np.int64)
        most = np.full(total, -1, dtype=np.int64)
        parent, label, child = [], [], []
        with np.errstate(over="ignore"):
            for depth in range(width, -1, -1):
                ends = np.flatnonzero(lengths == depth)
                ends = node[depth, ends]
                final[ends] = True
                self_words[ends] += 1
                language[ends] += np.uint64(0xD6E8FEB86659FD93)
                least[ends] = 0
                most[ends] = np.maximum(most[ends], 0)
                if depth < width:
                    below = heads[depth + 1]  # children, those of one node next to each other
                    if len(below):
                        of, to, by = node[depth, below], node[depth + 1, below], letters[below, depth]
                        first = np.flatnonzero(np.diff(of, prepend=-1))
                        step = mix64(language[to] + by.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                        language[of[first]] += np.add.reduceat(step, first)
                        self_words[of[first]] += np.add.reduceat(self_words[to], first)
                        least[of[first]] = np.minimum(least[of[first]], np.minimum.reduceat(least[to], first) + 1)
                        most[of[first]] = np.maximum(most[of[first]], np.maximum.reduceat(most[to], first) + 1)
                        parent.append(of)
                        label.append(by)
                        child.append(to)
        _, chosen, state = np.unique(language, return_index=True, return_inverse=True)
        self.final, self.least, self.most, words = final[chosen], least[chosen], most[chosen], self_words[chosen]
        self.first_gap = heads[0]
        self.start = state[node[0, heads[0]]]
        # Transitions of the chosen node of each state, by state and letter; ``skip`` counts the words accepted before.
        parent, label, child = (np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in (parent, label, child))
        kept = np.zeros(total, dtype=bool)
        kept[chosen] = True
        kept = kept[parent]
        source, label, target = state[parent[kept]], label[kept].astype(np.int64), state[child[kept]]
        self.key = source * 256 + label
        by = np.argsort(self.key)
        self.key, source, self.label, self.target = self.key[by], source[by], label[by], target[by]
        self.begin = np.searchsorted(source, np.arange(len(chosen)))
        self.degree = np.searchsorted(source, np.arange(len(chosen)), side="right") - self.begin
        before = np.concatenate(([0], np.cumsum(words[self.target])))
        self.skip = before[:-1] - before[self.begin[source]] + self.final[source]

    def has(self, state: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether words of ``length`` more letters may be accepted (a partition has two lengths next to each other)."""
        return (self.least[state] <= length) & (length <= self.most[state])

    def steps(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every transition of every listed state: the place in the list, the transition."""
        many = self.degree[state]
        of = np.repeat(np.arange(len(state)), many)
        within = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        return of, self.begin[state][of] + within


#: Configurations expanded at once.
EXPANDED = 1 << 20


def one_edit_pairs(gaps: list[bytes], group: np.ndarray, short: np.ndarray, backward: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in ``gaps`` one edit apart, the first of ``short[group]`` letters, the second of as many or one more.

    Breadth first through A o T o A. ``backward`` partitions accept no insertion at the end of a gap.
    """
    a = Acceptor(gaps, group)
    ids = np.arange(len(a.start))
    same = (a.start, a.first_gap, ids)  # no edit yet: both words are in one state
    edited = tuple(np.zeros(0, dtype=np.int64) for _ in range(6))  # left, right, their words, letters left, banned letter
    depth = 0
    while len(same[0]) or len(edited[0]):
        parts = []
        if len(edited[0]):  # after the edit both sides read the same letter
            for at in range(0, len(edited[0]), EXPANDED):
                left, right, i, j, room, banned = (c[at : at + EXPANDED] for c in edited)
                of, step = a.steps(left)
                key = right[of] * 256 + a.label[step]
                other = np.minimum(np.searchsorted(a.key, key), len(a.key) - 1)
                ok = (a.key[other] == key) & (a.label[step] != banned[of])
                of, step, other = of[ok], step[ok], other[ok]
                parts.append((a.target[step], a.target[other], i[of] + a.skip[step], j[of] + a.skip[other], room[of] - 1, np.zeros(len(of), dtype=np.int64)))
        nexts = []
        for at in range(0, len(same[0]), EXPANDED // 8):
            state, i, g = (c[at : at + EXPANDED // 8] for c in same)
            of, step = a.steps(state)
            to, word, room = a.target[step], i[of] + a.skip[step], short[g[of]] - depth
            # An inserted letter: the shorter word stays where it is.
            ok = a.has(state[of], room) & a.has(to, room) & ~((room == 0) & backward[g[of]])
            parts.append((state[of][ok], to[ok], i[of][ok], word[ok], room[ok], a.label[step][ok]))
            # A replaced letter: two transitions of one state, the smaller letter first.
            ok = a.has(to, room - 1)
            low, many = np.flatnonzero(ok), np.zeros(len(of) + 1, dtype=np.int64)
            many[1:] = np.cumsum(ok)
            later = many[np.searchsorted(of, of[low], side="right")] - np.arange(1, len(low) + 1)  # eligible siblings after each
            first = np.repeat(np.arange(len(low)), later)
            second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(later) - later, later)
            x, y = low[first], low[second]
            parts.append((to[x], to[y], word[x], word[y], room[x] - 1, np.zeros(len(x), dtype=np.int64)))
            nexts.append((to, word, g[of]))
        edited = tuple(np.concatenate(c) for c in zip(*parts, strict=True))
        same = tuple(np.concatenate(c) for c in zip(*nexts, strict=True)) if nexts else tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
        depth += 1
        done = edited[4] == 0
        accepted = done & a.final[edited[0]] & a.final[edited[1]]
        if accepted.any():
            yield a.order[edited[2][accepted]], a.order[edited[3][accepted]]
        edited = tuple(c[~done] for c in edited)


def near_pairs(vocabulary: DataFrame, min_length: int = MIN_LENGTH, group_letters: int = GROUP_LETTERS, chunk_letters: int = CHUNK_LETTERS) -> DataFrame:
    """(word, near, near_n): both directions of every pair of words of ``vocabulary`` (word, n) one edit apart."""

    def chunk(rows: pa.RecordBatch | pa.Table) -> Iterator[pa.RecordBatch]:
        words, lo, hi = rows.column("word").to_pylist(), rows.column("lo").to_numpy(), rows.column("hi").to_numpy()
        keys = rows.column("key").to_pylist()
        gaps = [w.encode("latin-1")[a : len(w) - b] for w, a, b in zip(words, lo, hi, strict=True)]
        new = np.array([True, *(x != y for x, y in zip(keys[1:], keys[:-1], strict=True))])
        at = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        short = (rows.column("short").to_numpy() - lo - hi)[at].astype(np.int64)
        for i, j in one_edit_pairs(gaps, group, short, hi[at] > 0):
            one, other = pa.array(np.concatenate((i, j))), pa.array(np.concatenate((j, i)))
            word, near, near_n = rows.column("word").take(one), rows.column("word").take(other), rows.column("n").take(other)
            yield from pa.table([word, near, near_n], names=["word", "near", "near_n"]).combine_chunks().to_batches(1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if not rows.num_rows:
                continue
            keys = rows.column("key").to_pylist()
            heads = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1])]
            size = np.array([len(w) for w in rows.column("word").to_pylist()]) - rows.column("lo").to_numpy() - rows.column("hi").to_numpy()
            at, letters, widest = 0, 0, 0
            for begin, end in zip(heads, [*heads[1:], len(keys)], strict=True):
                own, wide = int(end - begin), int(size[begin:end].max())
                if begin > at and (letters + own) * max(widest, wide) > chunk_letters:
                    yield from chunk(rows.slice(at, begin - at))
                    at, letters, widest = begin, 0, 0
                letters, widest = letters + own, max(widest, wide)
            held = rows.slice(at)
        if held is not None and held.num_rows:
            yield from chunk(held)

    rows = partitioned(vocabulary, min_length, group_letters).select("key", "word", "n", "short", "lo", "hi")
    dealt = rows.repartition(partitions(rows), "key").sortWithinPartitions("key")
    pairs = dealt.mapInArrow(run, "word string, near string, near_n long")
    return pairs.filter(F.levenshtein("word", "near") == 1)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form: the last word that following forms leads to.

    Each step follows twice as many forms; a form is ``TIMES`` as frequent as its word, so chains are short.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        beyond = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = reached.join(beyond, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        step = stored(step, "roots")
        reached = step.select("word", "root")
        if step.filter("_moved").isEmpty():
            return reached


def spelling_variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = TIMES, group_letters: int = GROUP_LETTERS,
    chunk_letters: int = CHUNK_LETTERS,
) -> DataFrame:
    """Per word: n, form (its much more frequent near word), root, n_near and form_n."""
    vocabulary = stored(word_counts(docs, min_length).filter(F.col("n") >= min_count), "vocabulary")
    pairs = near_pairs(vocabulary, min_length, group_letters, chunk_letters)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    large = -F.col("best.n") >= times * F.col("n")
    judged = vocabulary.join(near, "word", "left").select(
        "word", F.when(large, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(large, -F.col("best.n")).alias("form_n"),
    )
    judged = stored(judged, "forms")
    last = roots(judged.filter("form IS NOT NULL"))
    joined = judged.join(last, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
