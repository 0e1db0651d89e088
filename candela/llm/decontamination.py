"""Benchmark decontamination by a distributed positional inverted index.

The documents' words that occur in the benchmark are stored as postings: per
shard (a run of whole documents) and term, the documents and positions where it
stands, in order, plus a table of the shard's documents and their lengths.
A query phrase is answered shard by shard: starting from its rarest term, the
offset-adjusted list (position minus offset in the phrase) is intersected with
those of the next rarer terms until one is empty or all agree, which leaves the
exact occurrences. Proximity matches keep the places of the rarest term around
which every other term stands within a distance, in any order.

The benchmark is the stated query set: it is read in blocks of about
``block_items`` items, each of which is held against the whole index; only its
vocabulary and one block's phrases are in memory at a time.

Defined results: null texts have no words; items without words are no phrase
and match nothing; an item shorter than a window is one window; documents
without words are never contaminated; repeated rows are judged each; null doc
or item ids pass through (an item without an id counts in the hit words and is
left out of the items lists, and so of ``items_sha256``); extra columns are ignored; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import stored, text_or_empty

WINDOW = 13
NEAR = 24
SHARD_WORDS = 1_000_000
BLOCK_ITEMS = 20_000

#: Letters and digits stay (A-Z as a-z), bytes from 0x80 on stay, all else parts words.
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TO_WORDS).split()


class Phrases:
    """The windows of a block of items as term numbers; ``terms`` is the vocabulary, which grows."""

    def __init__(self, items: list[tuple[object, str]], window: int, terms: dict[bytes, int]) -> None:
        rows: list[list[int]] = []
        owner: list[int] = []
        self.items = [i for i, _ in items]
        for k, (_, text) in enumerate(items):
            ids = [terms.setdefault(w, len(terms)) for w in words_of(text)]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if size else 0):
                rows.append(ids[at : at + size])
                owner.append(k)
        self.size = np.array([len(r) for r in rows], dtype=np.int64)
        self.owner = np.array(owner, dtype=np.int64)
        self.rows = np.full((len(rows), window), -1, dtype=np.int64)
        for i, r in enumerate(rows):
            self.rows[i, : len(r)] = r
        self.terms = len(terms)


def postings(docs: DataFrame, terms: dict[bytes, int], shard_words: int = SHARD_WORDS) -> DataFrame:
    """The index: shard, term (-1: the shard's documents and their lengths), docs, positions (32-bit, little-endian)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        number, size = 0, 0
        ids: list[str] = []
        lengths: list[int] = []
        where: list[tuple[int, np.ndarray]] = []

        def flush() -> pd.DataFrame:
            codes = np.concatenate([c for _, c in where]) if where else np.zeros(0, dtype=np.int64)
            owner = np.repeat([d for d, _ in where], [len(c) for _, c in where]) if where else codes
            place = np.concatenate([np.arange(len(c)) for _, c in where]) if where else codes
            held = codes >= 0
            codes, owner, place = codes[held], owner[held], place[held]
            order = np.argsort(codes, kind="stable")
            codes, owner, place = codes[order], owner[order].astype("<i4"), place[order].astype("<i4")
            cuts = np.flatnonzero(np.diff(codes, prepend=-1)) if len(codes) else np.zeros(0, dtype=np.int64)
            ends = np.append(cuts[1:], len(codes)) if len(cuts) else cuts
            return pd.DataFrame(
                {
                    "shard": task << 32 | number,
                    "term": np.concatenate(([-1], codes[cuts])).astype(np.int64),
                    "doc_ids": [ids, *[None] * len(cuts)],
                    "docs": [b"", *(owner[a:b].tobytes() for a, b in zip(cuts, ends, strict=True))],
                    "positions": [
                        np.array(lengths, dtype="<i4").tobytes(), *(place[a:b].tobytes() for a, b in zip(cuts, ends, strict=True))
                    ],
                }
            )

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["_text"], strict=True):
                words = words_of(text)
                if words:
                    where.append((len(ids), np.array([terms.get(w, -1) for w in words], dtype=np.int64)))
                ids.append(doc)
                lengths.append(len(words))
                size += len(words) + 1
                if size >= shard_words:
                    yield flush()
                    number, size, ids, lengths, where = number + 1, 0, [], [], []
        if ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("_text"))
    return rows.mapInPandas(run, "shard long, term long, doc_ids array<string>, docs binary, positions binary")


class Shard:
    """Postings of one shard as sorted numbers: document << 32 | position."""

    def __init__(self, rows: pd.DataFrame, n_terms: int) -> None:
        self.lists: dict[int, np.ndarray] = {}
        self.count = np.zeros(n_terms + 1, dtype=np.int64)
        for term, docs, positions in zip(rows["term"], rows["docs"], rows["positions"], strict=True):
            at = np.frombuffer(positions, dtype="<i4").astype(np.int64)
            if term < 0:
                self.lengths = at
                continue
            self.lists[term] = np.frombuffer(docs, dtype="<i4").astype(np.int64) << 32 | at
            self.count[term] = len(at)

    def exact(self, row: np.ndarray) -> np.ndarray:
        """Starts of the phrase ``row``: offset-adjusted lists intersected from the rarest term on."""
        order = np.argsort(self.count[row], kind="stable")
        first = int(order[0])
        starts = self.lists[row[first]] - first
        starts = starts[(starts & 0xFFFFFFFF) < 1 << 31]
        for k in order[1:].tolist():
            other = self.lists[row[k]]
            want = starts + k
            found = np.searchsorted(other, want)
            found[found == len(other)] = 0
            starts = starts[other[found] == want]
            if not len(starts):
                break
        return starts

    def near(self, row: np.ndarray, distance: int) -> np.ndarray:
        """Places of the rarest term with every other term within ``distance`` words, in any order."""
        order = np.argsort(self.count[row], kind="stable")
        at = self.lists[row[int(order[0])]]
        low, high = np.maximum(at - distance, at >> 32 << 32), at + distance
        keep = np.ones(len(at), dtype=bool)
        for k in order[1:].tolist():
            other = self.lists[row[k]]
            found = np.minimum(np.searchsorted(other, low), len(other) - 1)
            keep &= (other[found] >= low) & (other[found] <= high)
            if not keep.any():
                break
        return at[keep]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open spans as disjoint spans, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def matches(index: DataFrame, phrases: Phrases, near: int = NEAR) -> DataFrame:
    """Per document (shard, number): its words, the hit spans, and the items met exactly and nearly."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(rows, phrases.terms)
        ids = next(i for i, t in zip(rows["doc_ids"], rows["term"], strict=True) if t < 0)
        spans: dict[int, list[tuple[int, int]]] = {}
        exact: dict[int, set[int]] = {}
        nearly: dict[int, set[int]] = {}
        least = shard.count[phrases.rows]
        least[phrases.rows < 0] = np.iinfo(np.int64).max
        for w in np.flatnonzero(least.min(axis=1) > 0).tolist() if len(least) else []:
            size, item = int(phrases.size[w]), int(phrases.owner[w])
            row = phrases.rows[w, :size]
            for start in shard.exact(row).tolist():
                at = start & 0xFFFFFFFF
                spans.setdefault(start >> 32, []).append((at, at + size))
                exact.setdefault(start >> 32, set()).add(item)
            for doc in np.unique(shard.near(row, near) >> 32).tolist():
                nearly.setdefault(doc, set()).add(item)
        numbers = range(len(ids))
        united = [merged(spans.get(d, [])) for d in numbers]
        named = [None if i is None else str(i) for i in phrases.items]
        names = [[[named[i] for i in sorted(found.get(d, ())) if named[i] is not None] for d in numbers] for found in (exact, nearly)]
        return pd.DataFrame(
            {
                "shard": rows["shard"].iloc[0], "number": list(numbers), "doc_id": list(ids), "n_words": shard.lengths,
                "starts": [[a for a, _ in u] for u in united], "ends": [[b for _, b in u] for u in united],
                "items": names[0], "near": names[1],
            }
        )

    schema = (
        "shard long, number int, doc_id string, n_words long, starts array<long>, ends array<long>, "
        "items array<string>, near array<string>"
    )
    return index.groupBy("shard").applyInPandas(run, schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: int = NEAR, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """Per document: words, hit words, the items met exactly (and nearly) and the hit spans."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text_or_empty().alias("_text"))
    blocks = max(1, -(-rows.count() // block_items))
    block_of = F.pmod(F.xxhash64("item_id", "_text"), F.lit(blocks))

    def read(block: int) -> list[tuple[str | None, str]]:
        return [(r["item_id"], r["_text"]) for r in rows.filter(block_of == block).orderBy("item_id", "_text").collect()]

    terms: dict[bytes, int] = {}
    for block in range(blocks):
        first = Phrases(read(block), window, terms)
    index = stored(postings(docs, terms), "postings")
    found = None
    for block in range(blocks):
        part = matches(index, first if blocks == 1 else Phrases(read(block), window, terms), near)
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        found = found.groupBy("shard", "number").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            *[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items", "near")],
        )
    else:  # two Python steps in one stage would hold two workers a core, which stay and keep their memory
        found = stored(found, "matches")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = [merged(list(zip(a, b, strict=True))) for a, b in zip(batch["starts"], batch["ends"], strict=True)]
            items = [sorted(set(i)) for i in batch["items"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"], "n_words": batch["n_words"],
                    "n_hit": np.array([sum(b - a for a, b in s) for s in spans], dtype=np.int64),
                    "items": items, "near_items": [sorted(set(i)) for i in batch["near"]],
                    "spans": [[[a, b] for a, b in s] for s in spans],
                }
            )

    schema = "doc_id string, n_words long, n_hit long, items array<string>, near_items array<string>, spans array<array<long>>"
    kind = docs.schema["doc_id"].dataType
    flag = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return found.mapInPandas(digest, schema).withColumn("doc_id", F.col("doc_id").cast(kind)).withColumn("contaminated", flag)


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    rows = contamination(docs, benchmark)
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def contamination_sql() -> str:
    """The digest in DuckDB SQL: word positions joined with the windows' text."""

    def split(table: str, key: str) -> str:
        lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"SELECT {key}, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}"

    return f"""
WITH i AS ({split('benchmark', 'item_id')}),
windows AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n,
  array_to_string(w[p : p + least(len(w), {WINDOW}) - 1], ' ') AS key
  FROM i, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS u(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
d AS ({split('documents', 'doc_id')}),
hits AS (SELECT doc_id, p, windows.n, item_id FROM (
    SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS key
    FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(p) WHERE len(w) >= n) AS g
  JOIN windows USING (n, key)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + n)) AS u(q) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS names FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""
