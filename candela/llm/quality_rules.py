"""Quality rules: an isolation forest over per-document rule statistics.

Base rules reject very short and very repetitive texts. For the rest, an
isolation forest (random axis-parallel splits on small subsamples; a document
isolated by few splits is an anomaly) scores the rule statistics. Its
threshold is calibrated on all labelled rows: it minimises the share of bad rows
kept plus ``reject_cost`` times the share of good rows rejected.

Defined results: a null or empty text has no words, so the base rule rejects
it; null ids pass through; repeated rows are scored alike; extra columns are
ignored; an empty table gives an empty result; without labelled rows of both
classes only the base rules reject.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import SpanHasher, stored, temporary_tables, text_or_empty, word_spans

# The symbols counted by the rules and the ASCII white space between words.
SYMBOLS = b"#*$%&|<>"
SPACE = b"\t\n\x0b\x0c\r "
#: Bytes that rarely begin or end a word of prose.
ODD = np.isin(np.arange(256), list(SYMBOLS + b"!?@^~=+"))

MIN_WORDS = 50
#: Trees, and rows of each: an isolation forest's trees grow on small subsamples.
TREES, SUBSAMPLE = 100, 256
#: Ranges of the score (0 to 1) whose running sums the threshold's search starts from.
SCORE_RANGES = 4096
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "upper_share", "digit_share", "punctuation_share", "log_line_words", "top_word_share", "odd_word_share",
)


def statistics(text: str, hasher: SpanHasher) -> tuple[int, int, int, int, int, list[float]]:
    """Words, code points in words, symbols, duplicate lines, repeated words; then the forest's features."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    continuation = int(counts[0x80:0xC0].sum())
    word_chars = len(data) - continuation - int(counts[list(SPACE)].sum())
    n_symbols = int(counts[list(SYMBOLS)].sum())
    seen: set[bytes] = set()
    dup = lines = 0
    for line in data.split(b"\n"):
        if line.strip(SPACE):
            lines += 1
            if line in seen:
                dup += 1
            seen.add(line)
    repeat = odd = 0
    if n:
        joined = np.frombuffer(b" ".join(words), dtype=np.uint8)
        starts, ends = word_spans(joined)
        odd = int((ODD[joined[starts]] | ODD[joined[ends - 1]]).sum())
    if n >= 3:
        grams = hasher.spans(hasher.prefix(joined), starts[:-2], ends[2:])
        order = np.argsort(grams)
        same = np.diff(grams[order]) == 0
        hit = np.zeros(n, dtype=bool)
        for at in (order[:-1][same], order[1:][same]):
            for offset in range(3):
                hit[at + offset] = True
        repeat = int(hit.sum())
    vocabulary = Counter(words)
    letters = int(counts[97:123].sum() + counts[65:91].sum()) + continuation
    punctuation = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    per_word, per_char = max(n, 1), max(word_chars, 1)
    features = [
        float(np.log1p(n)), word_chars / per_word, n_symbols / per_char, dup / max(lines, 1), repeat / per_word,
        len(vocabulary) / per_word, int(counts[65:91].sum()) / max(letters, 1), int(counts[48:58].sum()) / per_char,
        punctuation / per_char, float(np.log1p(n / max(lines, 1))), max(vocabulary.values(), default=0) / per_word,
        odd / per_word,
    ]
    return n, word_chars, n_symbols, dup, repeat, features


class Forest:
    """Isolation forest as flat arrays, one row per tree."""

    def __init__(self, rows: np.ndarray, trees: int, subsample: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        size = min(subsample, len(rows))
        self.depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
        nodes = 2 ** (self.depth + 1)
        self.feature = np.zeros((trees, nodes), dtype=np.int32)
        self.split = np.full((trees, nodes), np.inf)
        self.length = np.zeros((trees, nodes))
        for t in range(trees):
            self._grow(rng, t, rows[rng.choice(len(rows), size, replace=False)], 1, 0)
        self.norm = max(self.rest(size), 1e-9)

    @staticmethod
    def rest(n: int) -> float:
        """Mean path length of an unsuccessful search among ``n`` rows."""
        return 0.0 if n < 2 else 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else 1.0

    def _grow(self, rng, t: int, rows: np.ndarray, node: int, depth: int) -> None:
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(1), np.zeros(1))
        wide = np.flatnonzero(high > low)
        self.length[t, node] = depth + self.rest(len(rows))
        if depth >= self.depth or len(wide) == 0:
            return
        f = int(rng.choice(wide))
        at = rng.uniform(low[f], high[f])
        left = rows[:, f] < at
        if left.all() or not left.any():
            return
        self.feature[t, node], self.split[t, node], self.length[t, node] = f, at, -1.0
        self._grow(rng, t, rows[left], 2 * node, depth + 1)
        self._grow(rng, t, rows[~left], 2 * node + 1, depth + 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1), higher is odder."""
        total = np.zeros(len(x))
        at = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.ones(len(x), dtype=np.int64)
            for _ in range(self.depth):
                inner = self.length[t, node] < 0
                step = 2 * node + (x[at, self.feature[t, node]] >= self.split[t, node])
                node = np.where(inner, step, node)
            total += self.length[t, node]
        return 2.0 ** (-total / len(self.feature) / self.norm)


def document_statistics(docs: DataFrame, *carried: str, judge=None) -> DataFrame:
    """One row per document: the carried columns, the base counts and the forest's features.

    ``judge`` turns a batch's feature matrix into anomaly scores, in place of the features.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = [statistics(t, hasher) for t in batch.column("_text").to_pylist()]
                added = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))]
                features = [r[5] for r in rows]
                if judge is None:
                    added.append(pa.array(features, pa.list_(pa.float64())))
                else:
                    added.append(pa.array(judge(np.array(features, dtype=float).reshape(len(rows), len(FEATURES)))))
                names = [c for c in batch.schema.names if c != "_text"]
                columns = [batch.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, *added], [*names, *COUNTS, last.split()[0]])

    kept = docs.select(*carried, text_or_empty().alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.drop("_text").schema]
    last = "features array<double>" if judge is None else "anomaly double"
    return kept.mapInArrow(run, ", ".join([*fields, *(f"{c} long" for c in COUNTS), last]))


def base_failed(min_words: int = MIN_WORDS):
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def labelled_statistics(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every labelled document that passes the base rules: doc_id, quality and features."""
    marks = labels.filter("quality is not null and doc_id is not null").select("doc_id", F.col("quality").cast("int"))
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = docs.select("doc_id", "text").join(marks, "doc_id")
    # One row an id, however often it is repeated: its smallest text.
    joined = joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
    return document_statistics(joined, "doc_id", "quality").filter(~base_failed()).select("doc_id", "quality", "features")


def drawn(labelled: DataFrame, rows: int) -> pd.DataFrame:
    """``rows`` of the labelled documents (all, if fewer), drawn from all of them by a fixed hash order."""
    return labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("quality", "features").toPandas()


def sample_labelled(docs: DataFrame, labels: DataFrame, sample_rows: int) -> pd.DataFrame:
    """At most ``sample_rows`` labelled documents that pass the base rules, with features."""
    return drawn(labelled_statistics(docs, labels), sample_rows)


def calibrated(score: np.ndarray, good: np.ndarray, reject_cost: float) -> float:
    """The cut between two neighbouring scores with the least cost; rows above it go."""
    order = np.argsort(score, kind="stable")
    kept_bad = np.concatenate(([0], np.cumsum(~good[order]))) / max((~good).sum(), 1)
    lost_good = 1.0 - np.concatenate(([0], np.cumsum(good[order]))) / max(good.sum(), 1)
    at = int(np.argmin(kept_bad + reject_cost * lost_good))
    ranked = score[order]
    if at == 0:
        return float(ranked[0] - 1e-9)
    return float(ranked[at - 1]) if at == len(ranked) else float((ranked[at - 1] + ranked[at]) / 2)


def score_counts(labelled: DataFrame, forest: Forest) -> DataFrame:
    """Good and bad labelled documents at each distinct anomaly score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("features").to_pylist(), dtype=float).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([pa.array(forest.score(x)), batch.column("quality")], ["score", "quality"])

    scored = labelled.select("features", "quality").mapInArrow(run, "score double, quality int")
    good = F.col("quality") == 1
    return scored.groupBy("score").agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))


def calibrated_cut(counts: DataFrame, reject_cost: float) -> float:
    """``calibrated`` over the counts at each distinct score; infinite without both classes.

    A running sum over all scores in two steps: over the ranges of the scores (at
    most ``SCORE_RANGES`` + 1 rows), then, from there on, inside each range.
    """
    counts = counts.withColumn("range", F.floor(F.col("score") * SCORE_RANGES))
    upto, every = Window.orderBy("range"), Window.partitionBy()
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.groupBy("range").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"), F.min("score").alias("lowest"))
    ranges = ranges.select(
        "range",
        F.coalesce(F.sum("g").over(before), F.lit(0)).alias("good_before"),
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bad_before"),
        F.lead("lowest").over(upto).alias("beyond"),
        F.sum("g").over(every).alias("all_good"),
        F.sum("b").over(every).alias("all_bad"),
    )
    inside = Window.partitionBy("range").orderBy("score")
    kept_good = F.col("good_before") + F.sum("good").over(inside)
    kept_bad = F.col("bad_before") + F.sum("bad").over(inside)
    cuts = counts.join(F.broadcast(ranges), "range").select(
        (kept_bad / F.col("all_bad") + reject_cost * (1.0 - kept_good / F.col("all_good"))).alias("cost"),
        "score",
        F.coalesce(F.lead("score").over(inside), "beyond").alias("next"),
        "all_good",
        "all_bad",
    )
    found = cuts.filter("all_good > 0 and all_bad > 0").agg(
        F.min(F.struct("cost", "score", "next")).alias("best"), F.min("score").alias("lowest")
    ).first()
    if found.best is None:
        return float("inf")
    if found.best.cost >= reject_cost:  # the cost of keeping none, the first cut of all
        return found.lowest - 1e-9
    return found.best.score if found.best.next is None else (found.best.score + found.best.next) / 2


def fit(docs: DataFrame, labels: DataFrame, reject_cost: float = 5.0, seed: int = 7) -> tuple[Forest | None, float]:
    """The forest and the calibrated anomaly threshold (infinite if it can't be calibrated).

    The threshold is that of all labelled documents. A tree's subsample, which
    is what isolates, is drawn from all of them too; the trees together need no
    more than ``TREES * SUBSAMPLE`` rows.
    """
    with temporary_tables(docs.sparkSession):
        labelled = stored(labelled_statistics(docs, labels), "quality-labelled")
        pool = drawn(labelled, TREES * SUBSAMPLE)
        if len(pool) == 0:
            return None, float("inf")
        order = pool["features"].map(tuple).sort_values(kind="stable").index
        forest = Forest(np.array(pool.loc[order, "features"].tolist()), TREES, SUBSAMPLE, seed)
        return forest, calibrated_cut(stored(score_counts(labelled, forest), "quality-scores"), reject_cost)


def quality_rules(docs: DataFrame, labels: DataFrame, *carried: str, **options) -> DataFrame:
    """Rule statistics, anomaly score and verdict per document."""
    forest, threshold = fit(docs, labels, **options)
    judge = forest.score if forest is not None else lambda x: np.zeros(len(x))
    stats = document_statistics(docs, *carried, judge=judge).withColumn("base_failed", base_failed())
    return stats.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= F.lit(threshold)))
