"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of class 1; the unlabelled set is the whole
document table. The score is a logistic function over one-hot quantile bins of
the rule statistics. With class prior p, it minimises

    p * R_pos(+) + max(0, R_unl(-) - p * R_pos(-))

(R(+), R(-): mean logistic loss when called positive, negative). The unlabelled
risk, gradient and curvature are summed over all documents by Spark, task by task
and then over a tree of tasks. Each Newton step is tried at its full length, a
half, a quarter and an eighth; the best that lowers the risk and keeps the
estimated negative risk from going below zero is taken, and the fit ends where
none does.

The class prior is assumed, not learnt from unlabelled texts: it is the positive
share among the labelled training rows, of which both classes are read for this
alone. Labels are read from at most ``sample_rows`` training rows, in a fixed hash order;
bin edges come from the same rows.

Defined results: null and empty texts get the score of their (zero)
statistics; null ids pass through; repeated rows are scored alike; of rows that
share a labelled id the one of the smallest text is learnt from; extra columns are ignored; an empty table gives an empty result; without labelled
positives every score is the prior 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import SpanHasher, stored, text_or_empty
from candela.llm.quality_rules import FEATURES, statistics

SAMPLE_ROWS = 20_000
BINS = 8
STEPS = 12
RIDGE = 0.02
#: Up to so many tasks send their sums to the driver themselves.
DIRECT_TASKS = 64


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def statistic_matrix(texts: pd.Series, hasher: SpanHasher) -> np.ndarray:
    rows = [statistics(t, hasher)[5] for t in texts]
    return np.array(rows, dtype=float).reshape(len(rows), len(FEATURES))


class Bins:
    """Quantile bins of each statistic; a row is the set of its bins (one a statistic) and a constant."""

    def __init__(self, x: np.ndarray, bins: int) -> None:
        quantiles = np.linspace(0, 1, bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, f], quantiles)) for f in range(x.shape[1])]
        self.start = np.concatenate(([0], np.cumsum([len(e) + 1 for e in self.edges])))
        self.width = int(self.start[-1]) + 1

    def codes(self, x: np.ndarray) -> np.ndarray:
        out = [np.searchsorted(e, x[:, f], side="right") + self.start[f] for f, e in enumerate(self.edges)]
        return np.stack([*out, np.full(len(x), self.width - 1)], axis=1).astype(np.int32)

    def margin(self, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return weights[codes].sum(axis=1)

    def dense(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), self.width))
        out[np.arange(len(codes))[:, None], codes] = 1.0
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def coded(docs: DataFrame, bins: Bins) -> DataFrame:
    """Bin codes of every document, stored once for the passes of the optimiser."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = SpanHasher()
        with np.errstate(over="ignore"):
            for batch in batches:
                codes = bins.codes(statistic_matrix(batch["_text"], hasher)).astype("<i2")
                yield pd.DataFrame({"doc_id": batch["doc_id"], "codes": [row.tobytes() for row in codes]})

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("_text"))
    return stored(rows.mapInPandas(run, "doc_id string, codes binary"), "pu-codes")


def decode(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<i2").reshape(len(column), -1).astype(np.int32)


def unlabelled_sums(codes: DataFrame, bins: Bins, candidates: np.ndarray) -> list[tuple[float, float, np.ndarray, np.ndarray]]:
    """For each weight vector: rows, summed negative loss, gradient and curvature over all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = bins.width
        total = np.zeros((len(candidates), 2 + width + width * width))
        for batch in batches:
            c = decode(batch["codes"])
            distinct, times = np.unique(c, axis=0, return_counts=True)
            x = bins.dense(distinct)
            for k, w in enumerate(candidates):
                z = x @ w
                p = sigmoid(z)
                total[k, 0] += times.sum()
                total[k, 1] += float(times @ np.logaddexp(0.0, z))
                total[k, 2 : 2 + width] += x.T @ (times * p)
                total[k, 2 + width :] += ((x * (times * p * (1 - p))[:, None]).T @ x).ravel()
        yield pd.DataFrame({"sums": [total.astype("<f8").tobytes()]})

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for sums in batch["sums"]:
                part = np.frombuffer(sums, dtype="<f8")
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"sums": [total.astype("<f8").tobytes()]})

    # A tree of sums: tasks, then their square root of them, then the driver, one row at a time.
    tasks, parts = codes.rdd.getNumPartitions(), codes.select("codes").mapInPandas(run, "sums binary")
    if tasks > DIRECT_TASKS:
        parts = parts.repartition(math.isqrt(tasks)).mapInPandas(added, "sums binary")
    width, out = bins.width, None
    for row in parts.toLocalIterator():
        part = np.frombuffer(row.sums, dtype="<f8").reshape(len(candidates), -1)
        out = part.copy() if out is None else out + part
    if out is None:
        out = np.zeros((len(candidates), 2 + width + width * width))
    return [(t[0], t[1], t[2 : 2 + width], t[2 + width :].reshape(width, width)) for t in out]


def fit(codes: DataFrame, bins: Bins, positives: np.ndarray, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights of least non-negative risk."""
    x = bins.dense(positives)
    mean = x.mean(axis=0)
    weights = np.zeros(bins.width)
    weights[-1] = np.log(prior / (1 - prior))
    penalty = np.full(bins.width, RIDGE)
    penalty[-1] = 0.0

    def risk(w: np.ndarray, sums) -> tuple[float, float]:
        z = x @ w
        negative = sums[1] / sums[0] - prior * float(np.logaddexp(0.0, z).mean())
        return prior * float(np.logaddexp(0.0, -z).mean()) + max(0.0, negative) + 0.5 * float(penalty @ w**2), negative

    (sums,) = unlabelled_sums(codes, bins, weights[None])
    if not sums[0]:
        return weights
    value, _ = risk(weights, sums)
    for _ in range(steps):
        gradient = sums[2] / sums[0] - prior * mean + penalty * weights
        curvature = sums[3] / sums[0] + np.diag(penalty + 1e-6)
        step = np.linalg.solve(curvature, gradient)
        tries = np.stack([weights - step * 0.5**k for k in range(4)])
        tried = unlabelled_sums(codes, bins, tries)
        best = None
        for w, s in zip(tries, tried, strict=True):
            now, negative = risk(w, s)
            if negative >= 0 and (best is None or now < best[0]):
                best = (now, w, s)
        if best is None or best[0] > value - 1e-6:
            break
        value, weights, sums = best
    return weights


def pu_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Score in [0, 1] and prediction per document."""
    marks = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = SpanHasher()
        with np.errstate(over="ignore"):
            for batch in batches:
                x = statistic_matrix(batch["_text"], hasher)
                yield pd.DataFrame({"quality": batch["quality"], "x": [row.astype("<f8").tobytes() for row in x]})

    joined = docs.select("doc_id", text_or_empty().alias("_text")).join(F.broadcast(marks), "doc_id")
    # One row an id, however often it is repeated: its smallest text.
    joined = joined.groupBy("doc_id").agg(F.min("_text").alias("_text"), F.min("quality").alias("quality"))
    sample = joined.mapInPandas(measure, "quality int, x binary").toPandas()
    sample = sample.sort_values(["x", "quality"], kind="stable")
    matrix = np.frombuffer(b"".join(sample["x"]), dtype="<f8").reshape(len(sample), len(FEATURES))
    good = sample["quality"].to_numpy() == 1
    bins = Bins(matrix if len(matrix) else np.zeros((1, len(FEATURES))), BINS)
    codes = coded(docs, bins)
    weights = np.zeros(bins.width)
    if good.any():
        prior = float(np.clip(good.mean(), 0.01, 0.99))
        weights = fit(codes, bins, bins.codes(matrix[good]), prior)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["score"] = sigmoid(bins.margin(decode(batch.pop("codes")), weights)) if len(batch) else 0.0
            yield batch

    scored = codes.mapInPandas(score, "doc_id string, score double")
    return scored.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
