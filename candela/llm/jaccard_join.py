"""N-gram Jaccard join by vertical partitioning.

A document's set holds the hashes of its distinct word shingles. Shingles have
one global order: by frequency class, then by hash. Two sets can only reach the
threshold if they share a shingle among the first few of that order (the
prefix), so prefix postings give the candidates. The order is then cut into
fragments; the overlap of a candidate pair is counted fragment by fragment and
the partial counts are summed per pair.

Groups of copies stay linear. Equal sets are one node. In every posting list
the node with the fewest shingles before the shared one is the hub, and first
only pairs with a hub are verified; lists whose members became connected are
done. What is left - pairs of different components that the length and position
bounds allow - is verified in full, so no link between different components is
lost and no pair inside a component needs checking.

Shingles and postings travel in blocks: packed arrays by bucket, the leading
bits of the hash, which are more for more partitions and for more text. Overlaps are counted on 48
bits of the hashes of two sets.

The frequency classes only steer how many candidates there are, never the
result: the ``ordered_last`` most frequent shingles are moved to the end of the
order (counted over all documents, equal sets inside a task once), the rest
counts as rare.

Defined results: null or empty texts and texts without words have an empty set
and are linked with nothing; with fewer words than a shingle the whole sequence
is the set; repeated rows are copies of each other; a null doc_id is never the
smallest of a component that has another one; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import DROP_SHUFFLES, SpanHasher, partitions, shingle_hashes, stored, temporary_tables, text_or_empty
from candela.llm.components import connected_components
from candela.session import session_conf

SIZE = 4
#: Similarity threshold in hundredths.
PERCENT = 85
FRAGMENTS = 8
#: Hash slots of a prefilter: what is broadcast is never more rows than this.
SLOTS = 1 << 18
#: Shingles that get a frequency class (9 bytes each on every worker).
ORDERED_LAST = 1 << 19
#: Bytes of text whose shingles go to one bucket, in the mean. Far smaller buckets make rows of a few postings, which
#: cost memory in every task.
BUCKET_TEXT = 1 << 24
#: Shingles, and postings, that a task holds before it sends them on in blocks.
HELD_SHINGLES = 700_000
HELD_POSTINGS = 250_000


def shingle_set(text: str, hasher: SpanHasher, size: int = SIZE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (ASCII lower case, ASCII white space)."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.unique(shingle_hashes(hasher, words, size))


def set_fingerprint(hashes: np.ndarray) -> int:
    """64-bit fingerprint of a set of well mixed hashes, as a signed number."""
    value = int(hashes.sum(dtype=np.uint64)) * 0x9E3779B97F4A7C15 + len(hashes) * 0xC2B2AE3D27D4EB4F
    value = (value ^ (value >> 29)) & 0xFFFFFFFFFFFFFFFF
    return value - (1 << 64) if value >> 63 else value


def bucket_bits(docs: DataFrame) -> int:
    """Leading bits of a bucket: buckets get more as there is more text, so none grows with the corpus."""
    total = docs.agg(F.sum(F.octet_length(text_or_empty()))).first()[0] or 0
    wanted = (total // BUCKET_TEXT).bit_length()
    return min(32, max(8, partitions(docs).bit_length() + 2, wanted))


def planes(values: np.ndarray) -> bytes:
    """The bytes of sorted numbers by significance, which compress better than number by number."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(width, -1).T).view(kind).ravel()


class Order:
    """The global order: class (0: rare), then hash. Known shingles are stored by their leading bits."""

    def __init__(self, keys: np.ndarray, classes: np.ndarray, bits: int) -> None:
        at = np.argsort(keys)
        self.keys, self.classes, self.shift = keys[at], classes[at], np.uint64(64 - bits)

    def parts(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Plain arrays: broadcasts are pickled by reference to a class, which workers may not be able to import."""
        return self.keys, self.classes, 64 - int(self.shift)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Class of each hash."""
        if not len(self.keys):
            return np.zeros(len(hashes), dtype=np.uint8)
        keys = hashes >> self.shift
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.classes[at], 0).astype(np.uint8)


def frequency_order(docs: DataFrame, size: int, ordered_last: int, bits: int) -> Order:
    """Classes of the most frequent shingles, counted over all documents.

    Tasks send sorted 32-bit remainders in blocks by bucket, so a shingle costs four bytes at most.
    """
    rest = np.uint64(64 - bits - 32)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, seen = SpanHasher(), set()
        held: list[np.ndarray] = []
        count = 0

        def flush() -> pd.DataFrame:
            keys = np.sort(np.concatenate(held) >> rest)
            bucket = (keys >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(cuts[1:], len(keys))
            low = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
            return pd.DataFrame(
                {"bucket": bucket[cuts].astype(np.int32), "keys": [planes(low[a:b]) for a, b in zip(cuts, ends, strict=True)]}
            )

        with np.errstate(over="ignore"):
            for batch in batches:
                for text in batch["_text"]:
                    hashes = shingle_set(text, hasher, size)
                    mark = set_fingerprint(hashes)
                    if not len(hashes) or mark in seen:
                        continue
                    seen.add(mark)
                    held.append(hashes)
                    count += len(hashes)
                    if count >= HELD_SHINGLES:
                        yield flush()
                        held, count = [], 0
            if held:
                yield flush()

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        keys, times = np.unique(np.concatenate([from_planes(k, "<u4") for k in rows["keys"]]), return_counts=True)
        often = times > 1
        keys, classes = keys[often], np.minimum(1 + 4 * np.log2(times[often]), 255).astype(np.uint8)
        histogram = np.bincount(classes, minlength=256).tolist()
        return pd.DataFrame(
            {"bucket": rows["bucket"].iloc[:1], "keys": [keys.tobytes()], "classes": [classes.tobytes()], "histogram": [histogram]}
        )

    texts = docs.select(text_or_empty().alias("_text"))
    sent = texts.mapInPandas(blocks, "bucket int, keys binary").groupBy("bucket")
    table = stored(sent.applyInPandas(counted, "bucket int, keys binary, classes binary, histogram array<long>"), "frequency")
    sums = table.select(F.posexplode("histogram").alias("class", "n")).groupBy("class").agg(F.sum("n").alias("n")).collect()
    total, least = 0, 256
    for row in sorted(sums, key=lambda r: -r["class"]):
        if row["n"] and total + row["n"] > ordered_last:
            break
        total, least = total + row["n"], row["class"]

    def chosen(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for bucket, keys, classes in zip(batch["bucket"], batch["keys"], batch["classes"], strict=True):
                classes = np.frombuffer(classes, dtype=np.uint8)
                often = classes >= least
                if often.any():
                    keys = np.frombuffer(keys, dtype="<u4")[often].astype(np.uint64) | np.uint64(bucket) << np.uint64(32)
                    yield pd.DataFrame({"keys": [keys.tobytes()], "classes": [classes[often].tobytes()]})

    rows = table.drop("histogram").mapInPandas(chosen, "keys binary, classes binary").toPandas()
    keys = np.frombuffer(b"".join(rows["keys"]), dtype=np.uint64)
    return Order(keys, np.frombuffer(b"".join(rows["classes"]), dtype=np.uint8), bits + 32)


PREFIX_TYPES = {
    "doc_id": pa.string(), "mark": pa.int64(), "n_shingles": pa.int64(), "bucket": pa.int32(), "keys": pa.binary(),
    "nodes": pa.binary(), "sizes": pa.binary(), "places": pa.binary(),
}


def prefix_batch(**columns) -> pa.RecordBatch:
    """Some of the prefix table's columns, the others null."""
    n = len(next(iter(columns.values())))
    held = [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in PREFIX_TYPES.items()]
    return pa.RecordBatch.from_arrays(held, list(PREFIX_TYPES))


def prefixes(docs: DataFrame, order: Order, size: int, percent: int, bits: int) -> DataFrame:
    """One row a document (doc_id, mark: set fingerprint, n_shingles) and, bucket set, blocks of prefix postings."""
    shared = docs.sparkSession.sparkContext.broadcast(order.parts())
    rest = np.uint64(64 - bits - 32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, ranks = SpanHasher(), Order(*shared.value)
        heads: list[np.ndarray] = []
        marks: list[int] = []
        sizes: list[int] = []
        seen: set[int] = set()

        def flush() -> pa.RecordBatch:
            lengths = [len(h) for h in heads]
            keys = np.concatenate(heads) >> rest
            by = np.argsort(keys, kind="stable")
            keys = keys[by]
            bucket = (keys >> np.uint64(32)).astype(np.int32)
            low = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
            node = np.repeat(np.array(marks, dtype="<i8"), lengths)[by]
            n = np.repeat(np.array(sizes, dtype="<i4"), lengths)[by]
            place = np.concatenate([np.arange(k, dtype="<i4") for k in lengths])[by]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            spans = list(zip(cuts, np.append(cuts[1:], len(keys)), strict=True))
            columns = {"keys": low, "nodes": node, "sizes": n, "places": place}
            return prefix_batch(bucket=bucket[cuts], **{c: [planes(v[a:b]) for a, b in spans] for c, v in columns.items()})

        with np.errstate(over="ignore"):
            for batch in batches:
                own_marks, own_sizes = [], []
                for text in batch.column("_text").to_pylist():
                    hashes = shingle_set(text, hasher, size)
                    n = len(hashes)
                    mark = set_fingerprint(hashes) if n else 0
                    own_marks.append(mark)
                    own_sizes.append(n)
                    if not n or mark in seen:
                        continue
                    seen.add(mark)
                    ranked = np.argsort(ranks.of(hashes), kind="stable")
                    heads.append(hashes[ranked[: n - -(-percent * n // 100) + 1]])
                    marks.append(mark)
                    sizes.append(n)
                if own_marks:
                    yield prefix_batch(doc_id=batch.column("doc_id").to_pylist(), mark=own_marks, n_shingles=own_sizes)
                if sum(map(len, heads)) >= HELD_POSTINGS:
                    yield flush()
                    heads, marks, sizes = [], [], []
            if heads:
                yield flush()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("_text"))
    schema = "doc_id string, mark long, n_shingles long, bucket int, keys binary, nodes binary, sizes binary, places binary"
    return rows.mapInArrow(run, schema)


def posting_lists(blocks: DataFrame, percent: int) -> DataFrame:
    """Postings (shingle, node, n, i) of lists of two or more nodes, if another member could be reached from there.

    i is the shingle's place in the node's set; the bound takes the least place of any other member.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        key, node, n, i = (
            np.concatenate([from_planes(v, kind) for v in rows[c]]).astype(np.int64)
            for c, kind in (("keys", "<u4"), ("nodes", "<i8"), ("sizes", "<i4"), ("places", "<i4"))
        )
        by = np.lexsort((node, i, key))
        key, node, n, i = key[by], node[by], n[by], i[by]
        # Equal sets met by several tasks have equal postings, next to each other.
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        key, node, n, i = key[new], node[new], n[new], i[new]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        length = np.diff(np.append(first, len(key)))
        head = np.repeat(first, length)
        second = np.minimum(head + 1, len(key) - 1)
        least = np.where(np.arange(len(key)) == head, i[second], i[head])
        keep = (np.repeat(length, length) > 1) & (100 * (n - i) >= percent * (n + least))
        shingle = key[keep] | np.int64(rows["bucket"].iloc[0]) << 32
        return pd.DataFrame({"shingle": shingle, "node": node[keep], "n": n[keep], "i": i[keep]})

    return blocks.groupBy("bucket").applyInPandas(run, "shingle long, node long, n long, i long")


def possible_rows(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be among ``keys``, before they are shuffled: a semi join on hash slots.

    Beyond a few hundred thousand keys more and more other rows pass; the join that follows is exact.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS)).alias("_slot")
    slots = keys.select(slot).distinct()  # SLOTS rows at most
    return rows.select("*", slot).join(F.broadcast(slots), "_slot", "left_semi").drop("_slot")


def node_sets(docs: DataFrame, source: DataFrame, order: Order, size: int, parts: int) -> DataFrame:
    """The sets of the nodes in ``source`` (node, rep, is_hub), cut along the global order; repeated rows give equal copies."""
    shared = docs.sparkSession.sparkContext.broadcast(order.parts())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, ranks = SpanHasher(), Order(*shared.value)
        width = np.uint64((1 << 64) // (parts - 1) + 1)
        with np.errstate(over="ignore"):
            for batch in batches:
                node, hub, part, held = [], [], [], []
                for i, is_hub, text in zip(batch["node"], batch["is_hub"], batch["_text"], strict=True):
                    hashes = shingle_set(text, hasher, size)
                    if set_fingerprint(hashes) != i:
                        continue  # another text under the same id
                    own = np.where(ranks.of(hashes) > 0, parts - 1, (hashes // width).astype(np.int64))
                    for p in np.unique(own).tolist():
                        node.append(i)
                        hub.append(is_hub)
                        part.append(p)
                        short = (hashes[own == p] >> np.uint64(16)).astype("<u8")
                        held.append(short.view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
                yield pd.DataFrame(
                    {"node": np.array(node, dtype=np.int64), "is_hub": np.array(hub, dtype=bool), "fragment": np.array(part, dtype=np.int32), "shingles": held}
                )

    texts = docs.select(F.col("doc_id").cast("string").alias("rep"), text_or_empty().alias("_text"))
    found = source.join(texts, source["rep"].eqNullSafe(texts["rep"])).select("node", "is_hub", "_text")
    return stored(found.mapInPandas(run, "node long, is_hub boolean, fragment int, shingles binary"), "fragments")


def common_counts(left: pd.Series, right: pd.Series) -> np.ndarray:
    """For each row how many 48-bit values two sets share; rows are told apart by the leading 16 bits."""
    out = np.zeros(len(left), dtype=np.int64)
    for at in range(0, len(left), 1 << 16):
        values = []
        for column in (left, right):
            held = column.iloc[at : at + (1 << 16)]
            counts = held.map(len).to_numpy() // 6
            wide = np.zeros((int(counts.sum()), 8), dtype=np.uint8)
            wide[:, :6] = np.frombuffer(b"".join(held), dtype=np.uint8).reshape(-1, 6)
            values.append(wide.view("<u8").ravel() | np.repeat(np.arange(len(held), dtype=np.uint64), counts) << np.uint64(48))
        both = np.sort(np.concatenate(values))
        row = (both[1:][both[1:] == both[:-1]] >> np.uint64(48)).astype(np.int64)
        found = np.bincount(row, minlength=len(held))
        out[at : at + len(found)] = found
    return out


def possible(n: str, m: str, i: str, j: str, percent: int) -> Column:
    """Whether sets of sizes n, m whose first common shingle stands at i, j can reach the threshold."""
    n, m, i, j = F.col(n), F.col(m), F.col(i), F.col(j)
    # The overlap is at most n - i, and m - j; the union at least n + j, and m + i.
    return (100 * (n - i) >= percent * (n + j)) & (100 * (m - j) >= percent * (m + i)) & (100 * (m - j) >= percent * (n + j)) & (
        100 * (n - i) >= percent * (m + i)
    )


def verified(pairs: DataFrame, hubs: DataFrame, sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The linked pairs (a among ``hubs``): overlaps counted fragment by fragment, then summed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            part = common_counts(batch.pop("_x"), batch.pop("_y"))
            yield batch.assign(part=part)

    left = hubs.select(F.col("node").alias("a"), "fragment", F.col("shingles").alias("_x"))
    right = sets.select(F.col("node").alias("b"), "fragment", F.col("shingles").alias("_y"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "fragment", "_x", "_y")
    partial = partial.mapInPandas(run, "a long, b long, fragment int, part long")
    partial = partial.groupBy("a", "b", "fragment").agg(F.max("part").alias("part"))
    overlap = partial.groupBy("a", "b").agg(F.sum("part").alias("overlap"))
    sizes = nodes.select("node", "n")
    overlap = overlap.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a")
    overlap = overlap.join(sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b")
    union = F.col("n_a") + F.col("n_b") - F.col("overlap")
    return overlap.filter(100 * F.col("overlap") >= percent * union).select("a", "b")


def jaccard_components(
    docs: DataFrame, size: int = SIZE, percent: int = PERCENT, parts: int = FRAGMENTS, ordered_last: int = ORDERED_LAST
) -> DataFrame:
    """Per document: doc_id, n_shingles and the smallest doc_id reachable by links."""
    with temporary_tables(docs.sparkSession), session_conf(docs.sparkSession, DROP_SHUFFLES):
        return stored(components(docs, size, percent, parts, ordered_last), "components", keep=True)


def components(docs: DataFrame, size: int, percent: int, parts: int, ordered_last: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType
    docs = docs.select("doc_id", "text")
    bits = bucket_bits(docs)
    order = frequency_order(docs, size, ordered_last, bits)
    written = stored(prefixes(docs, order, size, percent, bits), "prefixes")
    rows = written.filter("bucket is null").select(F.col("doc_id").cast(kind).alias("doc_id"), "mark", "n_shingles")
    full = rows.filter("n_shingles > 0")
    # One node for each distinct set.
    nodes = full.groupBy(F.col("mark").alias("node")).agg(F.min("doc_id").alias("smallest"), F.max("n_shingles").alias("n"))
    nodes = stored(nodes, "nodes")
    postings = stored(posting_lists(written.filter("bucket is not null").select("bucket", "keys", "nodes", "sizes", "places"), percent), "postings")
    labels = connected_components(linked(docs, full, nodes, postings, order, size, percent, parts))
    labelled = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("smallest").alias("component_id"))
    of_node = labelled.join(least, "component").select(F.col("node").alias("mark"), "component_id")
    empty = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    joined = full.select("doc_id", "n_shingles", "mark").join(of_node, "mark", "left").drop("mark")
    return joined.unionByName(empty)


def candidates(members: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (b: of ``members``, a: of ``others``) of a common list and different components, within the bounds."""
    others = others.select(
        "shingle", F.col("node").alias("a"), F.col("n").alias("m"), F.col("i").alias("j"), F.col("component").alias("other")
    )
    pairs = members.withColumnRenamed("node", "b").join(others, "shingle").filter(F.col("component") != F.col("other"))
    return pairs.filter(possible("n", "m", "i", "j", percent)).select("a", "b").distinct()


def linked(docs, full, nodes, postings, order, size, percent, parts) -> DataFrame:
    """All links needed to connect what is connected."""
    members = postings.withColumn("component", F.col("node"))
    hubs = members.groupBy("shingle").agg(F.min_by(F.struct("node", "n", "i", "component"), F.struct("i", "node")).alias("hub"))
    first = stored(candidates(members, hubs.select("shingle", "hub.*"), percent), "hub-pairs")
    # A node's text is that of any of its documents; the smallest id (as text) is a stable choice.
    source = full.select(F.col("mark").alias("node"), F.col("doc_id").cast("string").alias("rep"))
    source = source.join(postings.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min("rep").alias("rep"))
    hub_nodes = first.select(F.col("a").alias("node")).distinct().withColumn("is_hub", F.lit(True))
    source = source.join(hub_nodes, "node", "left").withColumn("is_hub", F.coalesce("is_hub", F.lit(False)))
    sets = node_sets(docs, source, order, size, parts)
    links = stored(verified(first, sets.filter("is_hub"), sets, nodes, percent), "hub-links")
    # Lists that still span components: every pair across them.
    members = postings.join(connected_components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    spread = members.groupBy("shingle").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    members = stored(members.join(spread.filter("_low != _high").select("shingle"), "shingle"), "open-lists")
    rest = candidates(members, members, percent).filter("a < b")
    checked = first.unionByName(first.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = stored(rest.join(checked, ["a", "b"], "left_anti"), "rest-pairs")
    # Few nodes are left to compare; only their sets should move.
    left = possible_rows(sets, rest.select(F.col("a").alias("node")), "node")
    right = possible_rows(sets, rest.select(F.col("b").alias("node")), "node")
    return links.unionByName(stored(verified(rest, left, right, nodes, percent), "rest-links"))
