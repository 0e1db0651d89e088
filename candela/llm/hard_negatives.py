"""Hard-negative mining by threshold joins over an inverted index (after L2AP).

Every anchor is a query. Its positives are the best rows of its label; each
positive opens a window of scores, and the best rows of other labels inside it
are the hard negatives. Rows are integer vectors, scores inner products.

A join finds the rows that reach a threshold of their query. A task holds a
stretch of rows and indexes them by dimension, the dimensions with most weight
first: a row stands in the lists of its leading dimensions only, as long as the
norm of what follows, times the largest norm of the queries' own rest, could
still reach the least threshold. Partial scores are accumulated list by list
(``BAND`` dimensions at a time); after each band a candidate goes whose partial
score plus the product of the remaining norms stays below the query's threshold.
What is left is scored exactly in integers.

Thresholds start high and are lowered until the windows fill. For positives they
begin between the best score that the norms allow and the anchor's best in a
sample, then go to that best, to the sample's ``k``-th best (which ``k`` rows are
known to reach) and, for anchors without so many, to any score. For negatives
they begin just below the positive's score and go down to the window's end by
growing steps. A round only asks for what lies between its threshold and that of
the round before, for windows that aren't full. The sample, of at most
``SAMPLE_ROWS`` rows, steers the rounds and never the result.

Queries come in blocks of about ``ANCHOR_BLOCK`` anchors, whose vectors, thresholds
and window counts pass through the driver, block by block; each round of a block
is one pass over the rows, of which a task keeps the best ``k`` a window. All
results stay in tables.

Defined results: rows without a vec_id can't be named and take no part; rows
alike in vec_id, label and vector are one row; different rows of one vec_id are
different rows, of which ties are decided by a hash. Vectors of different lengths
are compared as if the shorter one went on with zeros. Windows of a negative
positive score are empty. Extra columns are ignored; an empty table gives an empty
result. Scores that may exceed a long are refused with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import stored
from candela.session import scratch_path

#: Positives an anchor, and negatives a window.
K = 5
#: A window reaches down to so many hundredths of the positive's score.
FLOOR_PERCENT = 80
ANCHOR_BLOCK = 8192
SAMPLE_ROWS = 2048
#: Where the first thresholds for positives lie between the sample's best and the most the norms allow.
HEADROOM = (0.5, 0.2, 0.0)
#: Parts of a window that the rounds for negatives go down to.
DEPTHS = (1 / 64, 1 / 16, 1 / 4, 1.0)
BAND = 16
#: Scores that a task holds at once.
SCORES = 1 << 22

NO_BOUND = 1 << 62
ROW = "vec_id long, mark long, label int, vector array<long>"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(embeddings: DataFrame) -> DataFrame:
    """(vec_id, mark, label, vector) of the rows that take part; mark tells rows of one vec_id apart."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = embeddings.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(finite)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), vector.alias("vector"))
    rows = rows.withColumn("mark", F.xxhash64("label", "vector"))
    return rows.groupBy("vec_id", "mark").agg(F.any_value("label").alias("label"), F.any_value("vector").alias("vector"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of integers, ended with zeros up to ``width``."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))
    out = np.zeros((len(column), width), dtype=np.int64)
    if len(flat) == out.size:
        return flat.reshape(out.shape)
    for i, (begin, end) in enumerate(zip(np.concatenate(([0], ends[:-1])), ends, strict=True)):
        out[i, : end - begin] = flat[begin:end]
    return out


def dimension_weights(rows: DataFrame) -> DataFrame:
    """(dim, weight, largest): the sum of squares and the largest absolute value of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, largest = np.zeros(0), np.zeros(0, dtype=np.int64)
        for batch in batches:
            column = batch.column("vector")
            if not len(column):
                continue
            width = int(pa.compute.max(pa.compute.list_value_length(column)).as_py())
            x = matrix(column, width)
            grow = max(width, len(weight))
            weight, largest = np.resize(np.append(weight, np.zeros(grow)), grow), np.resize(np.append(largest, np.zeros(grow, dtype=np.int64)), grow)
            weight[:width] += (x.astype(np.float64) ** 2).sum(axis=0)
            largest[:width] = np.maximum(largest[:width], np.abs(x).max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(weight))), pa.array(weight), pa.array(largest)], ["dim", "weight", "largest"])

    sums = rows.select("vector").mapInArrow(run, "dim long, weight double, largest long")
    return sums.groupBy("dim").agg(F.sum("weight").alias("weight"), F.max("largest").alias("largest"))


def rest_norms(x: np.ndarray, cuts: list[int]) -> np.ndarray:
    """For each row and cut the norm of the dimensions from the cut on."""
    squares = np.concatenate((np.cumsum((x**2)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(x), 1))), axis=1)
    return np.sqrt(squares[:, cuts])


def reaching(a: np.ndarray, lower: np.ndarray, x: np.ndarray, band: int = BAND) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (query, row): all pairs whose inner product is ``lower[query]`` or more, and few others."""
    cuts = [*range(0, a.shape[1], band), a.shape[1]]
    rest_a, rest_x = rest_norms(a, cuts), rest_norms(x, cuts)
    most = rest_a.max(axis=0)
    slack = 0.5 + 1e-9 * most[0] * rest_x[:, 0].max(initial=0.0)  # rounding of sums and norms
    lower = lower - slack
    # A row stands in the lists of a band while its rest could still reach the least threshold.
    listed = most * rest_x >= lower.min(initial=np.inf)
    score = np.zeros((len(a), len(x)))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    open_rows = np.arange(len(x))
    for b, (begin, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        ended = open_rows[~listed[open_rows, b]]  # no longer listed: what is accumulated plus the norms decides
        if len(ended) and b:
            q, r = np.nonzero(score[:, ended] + rest_a[:, b, None] * rest_x[None, ended, b] >= lower[:, None])
            found.append((q, ended[r]))
        open_rows = open_rows[listed[open_rows, b]]
        if not len(open_rows):
            break
        score[:, open_rows] += a[:, begin:end] @ x[open_rows, begin:end].T
        alive = score[:, open_rows] + rest_a[:, b + 1, None] * rest_x[None, open_rows, b + 1] >= lower[:, None]
        if end == a.shape[1] or np.count_nonzero(alive) * 64 < alive.size:
            q, r = np.nonzero(alive)
            found.append((q, open_rows[r]))
            break
        open_rows = open_rows[alive.any(axis=0)]
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def exact_scores(a: np.ndarray, x: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    out = np.empty(len(q), dtype=np.int64)
    for at in range(0, len(q), 1 << 15):
        out[at : at + (1 << 15)] = np.einsum("ij,ij->i", a[q[at : at + (1 << 15)]], x[r[at : at + (1 << 15)]])
    return out


def best_of(window: np.ndarray, score: np.ndarray, vec_id: np.ndarray, mark: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each window: highest score, smallest vec_id."""
    by = np.lexsort((mark, vec_id, -score, window))
    own = window[by]
    first = np.flatnonzero(np.diff(own, prepend=-1))
    rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
    return by[rank < k]


def joined(rows: DataFrame, queries: dict[str, np.ndarray], order: np.ndarray, k: int) -> DataFrame:
    """(window, vec_id, mark, score): of each stretch of rows the first ``k`` of each window.

    ``queries`` has per window its number ``window``, ``anchor`` (its place among the vectors), ``low``, ``high``, and ``same`` (rows of the
    anchor's label, without itself, or of the others); and per anchor ``vector``, ``label``, ``vec_id``, ``mark``.
    """
    sc = rows.sparkSession.sparkContext
    anchors, own = np.unique(queries["anchor"], return_inverse=True)
    least = np.full(len(anchors), NO_BOUND, dtype=np.int64)
    np.minimum.at(least, own, queries["low"])
    alike = np.argsort(least, kind="stable")  # queries of like thresholds side by side
    place = np.empty(len(anchors), dtype=np.int64)
    place[alike] = np.arange(len(anchors))
    by = np.argsort(place[own], kind="stable")
    sent = {
        "vector": queries["vector"][anchors[alike]][:, order], "least": least[alike],
        **{c: queries[c][anchors[alike]] for c in ("label", "vec_id", "mark")},
        "of": place[own][by], **{c: queries[c][by] for c in ("window", "low", "high")}, "same": bool(queries["same"]),
    }
    shared = sc.broadcast(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        a = s["vector"].astype(np.float64)
        # Windows of each anchor stand side by side.
        begin, end = np.searchsorted(s["of"], np.arange(len(a))), np.searchsorted(s["of"], np.arange(len(a)), side="right")
        lower = np.where(s["least"] == -NO_BOUND, -np.inf, s["least"].astype(np.float64))
        for batch in batches:
            vec_id, mark, label = (batch.column(c).to_numpy() for c in ("vec_id", "mark", "label"))
            x = matrix(batch.column("vector"), len(order))[:, order]
            held = []
            step = min(len(a), 1024)
            for low in range(0, len(a), step):
                width = max(1, SCORES // step)
                for at in range(0, len(x), width):
                    q, r = reaching(a[low : low + step], lower[low : low + step], x[at : at + width].astype(np.float64))
                    q, r = q + low, r + at
                    ok = label[r] == s["label"][q]
                    ok = ok & ((vec_id[r] != s["vec_id"][q]) | (mark[r] != s["mark"][q])) if s["same"] else ~ok
                    q, r = q[ok], r[ok]
                    score = exact_scores(s["vector"], x, q, r)
                    many = (end - begin)[q]
                    pair = np.repeat(np.arange(len(q)), many)
                    w = np.repeat(begin[q], many) + np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
                    ok = (s["low"][w] <= score[pair]) & (score[pair] <= s["high"][w])
                    w, pair = w[ok], pair[ok]
                    held.append((s["window"][w], vec_id[r[pair]], mark[r[pair]], score[pair]))
            if held:
                window, ids, marks, scores = (np.concatenate(c) for c in zip(*held, strict=True))
                keep = best_of(window, scores, ids, marks, k)
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (window, ids, marks, scores)], ["window", "vec_id", "mark", "score"])

    return rows.mapInArrow(run, "window long, vec_id long, mark long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("window").orderBy(F.col("score").desc(), "vec_id", "mark")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def filled(rows: DataFrame, queries: dict[str, np.ndarray], ladder: np.ndarray, order: np.ndarray, k: int) -> DataFrame:
    """The first ``k`` rows of each window, thresholds lowered along ``ladder`` (steps x windows) until it is full."""
    windows = len(queries["anchor"])
    active, high, count, parts = np.arange(windows), queries["high"].copy(), np.zeros(windows, dtype=np.int64), []
    for low in ladder:
        asked = active[low[active] <= high[active]]
        if len(asked):
            own = {**queries, "window": asked, "anchor": queries["anchor"][asked], "low": low[asked], "high": high[asked]}
            parts.append(stored(ranked(joined(rows, own, order, k), k).drop("rank"), "reached"))
            for window, n in parts[-1].groupBy("window").count().collect():  # the windows of one block
                count[window] += n
            high[asked] = low[asked] - 1
        active = active[count[active] < k]
        if not len(active):
            break
    out = rows.sparkSession.createDataFrame([], "window long, vec_id long, mark long, score long")
    for part in parts:
        out = out.unionByName(part)
    return ranked(out, k)


def collected(rows: DataFrame, width: int) -> dict[str, np.ndarray]:
    """Rows of one block or of the sample, in order of vec_id, on the driver."""
    t = rows.orderBy("vec_id", "mark").toArrow().combine_chunks()
    columns = {c: t.column(c).to_numpy() for c in ("vec_id", "mark", "label")}
    vector = t.column("vector").chunk(0) if t.num_rows else pa.array([], pa.list_(pa.int64()))
    return {**columns, "vector": matrix(vector, width)}


def positive_ladder(block: dict[str, np.ndarray], sample: dict[str, np.ndarray], largest_norm: float, k: int) -> np.ndarray:
    """Thresholds of each anchor from the norms and a sample's scores, the last one below any score."""
    scores = block["vector"].astype(np.float64) @ sample["vector"].astype(np.float64).T
    own = (block["vec_id"][:, None] == sample["vec_id"]) & (block["mark"][:, None] == sample["mark"])
    scores[(block["label"][:, None] != sample["label"]) | own] = -np.inf
    scores = -np.sort(-np.concatenate((scores, np.full((len(scores), k), -np.inf)), axis=1), axis=1)[:, :k]
    best, known = scores[:, 0], scores[:, k - 1]
    most = np.linalg.norm(block["vector"].astype(np.float64), axis=1) * largest_norm
    base = np.where(np.isfinite(best), best, 0.0)
    steps = [base + part * (most - base) for part in HEADROOM] + [known, np.full(len(best), -np.inf)]
    return np.stack([np.where(np.isfinite(s), np.floor(np.where(np.isfinite(s), s, 0.0)), -NO_BOUND).astype(np.int64) for s in steps])


def hard_negatives(
    embeddings: DataFrame, anchor: Column | None = None, k: int = K, floor_percent: int = FLOOR_PERCENT, anchor_block: int = ANCHOR_BLOCK,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """For each anchor and positive the ranked hard negatives. ``anchor`` picks the anchors (vec_id divisible by 100)."""
    spark = embeddings.sparkSession
    rows = stored(quantised(embeddings), "vectors")
    weights = dimension_weights(rows).orderBy("dim").collect()  # one row a dimension
    width = len(weights)
    if sum(w["largest"] ** 2 for w in weights) >= 1 << 62:
        raise ValueError("components are too large: scores may exceed a long")
    order = np.argsort([-w["weight"] for w in weights], kind="stable").astype(np.int64)
    anchors = rows.filter(F.col("vec_id") % 100 == 0 if anchor is None else anchor)
    total = anchors.count()
    empty = spark.createDataFrame([], RESULT)
    if not total:
        return empty
    sample = collected(rows.orderBy(F.xxhash64("vec_id", "mark")).limit(sample_rows), width)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    largest_norm = rows.agg(F.max(F.sqrt(square))).first()[0]
    blocks = -(-total // anchor_block)
    path = scratch_path(spark, "hard-negatives")
    for b in range(blocks):
        block = collected(anchors.filter(F.pmod(F.xxhash64("vec_id", "mark"), F.lit(blocks)) == b), width)
        if not len(block["vec_id"]):
            continue
        many = np.arange(len(block["vec_id"]))
        queries = {**block, "anchor": many, "high": np.full(len(many), NO_BOUND), "same": True}
        ladder = positive_ladder(block, sample, largest_norm, k)
        positives = filled(rows, queries, ladder, order, k).select("window", "vec_id", "mark", "score").toArrow()
        of, positive, score = (positives.column(c).to_numpy() for c in ("window", "vec_id", "score"))
        end = -(-floor_percent * score // 100)
        ladder = np.stack([np.maximum(end, np.floor(score - depth * (score - end)).astype(np.int64)) for depth in DEPTHS])
        queries = {**block, "anchor": of, "high": np.where(end <= score, score, -NO_BOUND), "same": False}
        found = filled(rows, queries, ladder, order, k)
        names = pa.table(
            [pa.array(np.arange(len(of))), pa.array(block["vec_id"][of]), pa.array(positive), pa.array(score)],
            names=["window", "anchor_id", "positive_id", "positive_score"],
        )
        found = found.join(F.broadcast(spark.createDataFrame(names)), "window").withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        found.select(*empty.columns).write.parquet(f"{path}/block={b}")
    return spark.read.schema(f"{RESULT}, block int").parquet(path).select(*empty.columns)


def hard_negatives_sql(k: int = K, floor_percent: int = FLOOR_PERCENT) -> str:
    return f"""WITH taken AS (
      SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM taken a JOIN taken b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {k})
    SELECT p.anchor_id, p.positive_id,
      CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
      n.other_id AS negative_id, p.positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
      AND {floor_percent} * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
    QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) <= {k}"""
