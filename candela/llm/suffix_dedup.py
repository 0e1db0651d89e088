"""Suffix-array deduplication: bytes covered by a long string that also starts elsewhere.

Every string of ``length`` bytes has an anchor: the gram of ``gram`` bytes with
the least hash among those inside it, so equal strings have equal anchors at
equal places, and every start of a string belongs to one anchor. Anchors seen
once are done with. The others' neighbourhoods (the strings that belong to the
anchor) are grouped by anchor; equal ones are counted into one with a weight.

Groups are dealt to tasks by anchor and stream through them in order; a running
sum of their sizes cuts the stream into shards of whole groups, so a shard never
holds more than ``shard_bytes`` and one group. A shard sorts its suffixes up to
``length`` bytes, takes the Burrows-Wheeler transform and derives the common
prefixes of neighbouring suffixes by increasing value: breadth first, each
level extends the intervals of the level before by one byte to the left, and
an interval that falls apart marks a boundary. After ``length`` levels the
intervals still whole are exactly the strings that occur more than once; their
starts, weighed, give the bytes to remove.

A group with more members than ``group_members`` is not gathered. Its strings
are parted by where the anchor stands in them (``REFINED`` places at a time)
and regrouped by the longer core that all strings of a part share, equal parts
counted into one; groups still too large are parted down to single strings,
where equal members are one.

Defined results: null and empty texts have no bytes; texts shorter than
``length`` lose nothing; repeated rows are copies, so their strings repeat;
null ids pass through; extra columns are ignored; an empty table gives an empty
result. Removal works on bytes and may cut a character; the text given beside
the bytes leaves out what is left of such a character. Rows of equal id and text
are judged once, however many there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import SpanHasher, stored, temporary_tables, text_or_empty

LENGTH = 400
GRAM = 120
#: Distinct neighbourhoods of an anchor that one task may gather.
GROUP_MEMBERS = 1000
#: Anchor places that stay together when a large group is parted.
REFINED = 17
#: Bytes of neighbourhoods whose suffixes are sorted together; a single group may be larger (``GROUP_MEMBERS``).
SHARD_BYTES = 1 << 18
#: While more than one place in so many is new or open, a level is taken densely.
DENSE = 16
#: Texts are hashed in overlapping stretches of this size, so very long ones need bounded memory.
STRETCH = 1 << 19


PLACE_BITS = np.uint64(20)


def least_in_window(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value of each window of ``width`` values (of equals, the last), at most 2**20 places.

    Values count by their leading 44 bits; the place, counted from the end, fills the rest, so one minimum does both.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, dtype=np.int64)
    mask = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    least = (hashes & ~mask) | (mask - np.arange(n, dtype=np.uint64))
    span = 1
    while span < width:  # each step covers up to twice as many values
        step = min(span, width - span)
        least = np.minimum(least[step:], least[:-step])
        span += step
    return (mask - (least & mask)).astype(np.int64)


def anchors(data: np.ndarray, hasher: SpanHasher, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each anchor: place, gram hash, bytes to the left and right its own strings reach, and their hash.

    Long texts are taken in stretches; an anchor whose strings begin in two stretches counts as two.
    """
    n, width = len(data), length - gram + 1
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(n - length + 1, 0), STRETCH):
        begin, end = at, min(n, at + STRETCH + length - 1)
        prefix = hasher.prefix(data[begin:end])
        owner = least_in_window(hasher.raw_grams(prefix, gram), width)  # by the start of the string
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        last = np.append(first[1:], len(owner)) - 1
        place = owner[first]
        grams, around = hasher.spans(prefix, place, place + gram), hasher.spans(prefix, first, last + length)
        found.append((place + begin, grams, place - first, last + length - place, around))
    if not found:
        # Hashes stay unsigned: beside signed ones they would become floats.
        return tuple(np.zeros(0, dtype=kind) for kind in (np.int64, np.uint64, np.int64, np.int64, np.uint64))
    return found[0] if len(found) == 1 else tuple(np.concatenate(c) for c in zip(*found, strict=True))


def utf8() -> Callable[[str], bytes]:
    """The bytes that texts are judged by; a task makes its encoder once."""
    return lambda text: text.encode("utf-8", "surrogatepass")


def keyed(docs: DataFrame) -> DataFrame:
    """Rows with their text's key: equal rows have equal keys."""
    return docs.select("doc_id", text_or_empty().alias("text")).withColumn(
        "key", F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64("text").alias("mark"))
    )


def anchor_table(docs: DataFrame, length: int, gram: int, encoder: Callable = utf8, shortest: int | None = None) -> DataFrame:
    """An anchor a row: key, place, gram and neighbourhood hashes, reach.

    Texts of fewer than ``shortest`` bytes (``length`` by default) have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, encode = SpanHasher(), encoder()
        with np.errstate(over="ignore"):
            for batch in batches:
                found = [anchors(np.frombuffer(encode(t), dtype=np.uint8), hasher, length, gram) for t in batch.column("text").to_pylist()]
                if not found:
                    continue
                row = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                place, grams, left, right, around = (np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True))
                columns = [
                    batch.column("id").take(row), batch.column("mark").take(row), pa.array(place), pa.array(grams), pa.array(around),
                    pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "place", "gram", "around", "left", "right"])

    long_enough = keyed(docs).filter(F.octet_length("text") >= (shortest or length)).select("key.id", "key.mark", "text")
    schema = "id string, mark long, place long, gram long, around long, left int, right int"
    return stored(long_enough.mapInArrow(run, schema), "anchors")


def sorted_suffixes(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order by the first ``depth`` values (prefix doubling; equals by place)."""
    n = len(data)
    # Eight values of nine bits do not fit a word; seven do.
    packed = np.zeros(n, dtype=np.int64)
    padded = np.concatenate((data.astype(np.int64), np.zeros(7, dtype=np.int64)))
    for k in range(7):
        packed = packed << 9 | padded[k : k + n]
    order = np.argsort(packed, kind="stable")
    new = np.concatenate(([0], np.diff(packed[order]) != 0))
    rank = np.empty(n, dtype=np.int64)
    # A rank is the place where its run of equals begins, so only runs need sorting again.
    head = np.maximum.accumulate(np.where(new == 1, np.arange(n), 0))
    rank[order] = head
    span = 7
    while span < depth:
        alone = np.concatenate((head[1:] != head[:-1], [True])) & (head == np.arange(n))
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        own = order[at]
        after = own + span
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = head[at] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        order[at] = own[by]
        key = key[by]
        starts = np.concatenate(([True], key[1:] != key[:-1]))
        head = head.copy()
        head[at] = np.maximum.accumulate(np.where(starts, at, 0))
        rank = rank.copy()
        rank[order[at]] = head[at]
        span *= 2
    return order


def repeat_intervals(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and, for each place in it, whether its common prefix with the one before is ``depth`` or longer.

    The common prefixes come from the Burrows-Wheeler transform alone, by increasing value. ``back[i]`` is the place of
    the suffix one value longer to the left of place i. Two neighbours stay together at a level if they begin with the
    same value and nothing between their shortened suffixes fell apart on the level before.
    """
    n = len(data)
    order = sorted_suffixes(data, depth)
    transform = data[order - 1]  # the value before each suffix; the first one's is the last value
    back = np.empty(n, dtype=np.int64)
    back[np.argsort(transform, kind="stable")] = np.arange(n)
    forward = np.empty(n, dtype=np.int64)
    forward[back] = np.arange(n)
    first = data[order]
    whole = np.concatenate(([False], first[1:] == first[:-1]))
    # Neighbours i-1, i that begin with the same value: their shortened suffixes are the places low < high. They share
    # one more value if no boundary of the level before lies in (low, high].
    live = np.flatnonzero(whole)
    low, high = forward[live - 1], forward[live]
    fresh, level = np.flatnonzero(~whole), 1
    while level < depth and min(len(live), len(fresh)) > n // DENSE:
        apart = np.cumsum(~whole)
        stay = apart[high] == apart[low]
        fresh = live[~stay]
        whole[fresh] = False
        live, low, high = live[stay], low[stay], high[stay]
        level += 1
    # From here on only what the new boundaries touch: a close pair (high = low + 1) through the transform itself, the
    # other pairs by search among the new boundaries.
    close = np.zeros(n, dtype=bool)
    close[live[high - low == 1]] = True
    wide = high - low > 1
    live, low, high = live[wide], low[wide], high[wide]
    while level < depth and len(fresh):
        fresh = np.sort(fresh)
        touched = back[fresh]
        touched = touched[close[touched]]
        close[touched] = False
        hit = np.searchsorted(fresh, low, side="right") < np.searchsorted(fresh, high, side="right")
        fresh = np.concatenate((touched, live[hit]))
        whole[fresh] = False
        live, low, high = live[~hit], low[~hit], high[~hit]
        level += 1
    return order, whole


def repeated_starts(texts: list[bytes], weights: list[int], length: int) -> list[np.ndarray]:
    """For each text the places where a string of ``length`` bytes starts whose weight in all texts is two or more."""
    sizes = np.array([len(t) for t in texts])
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    data = np.zeros(int(starts[-1]), dtype=np.int16)
    owner = np.zeros(len(data), dtype=np.int64)
    for i, t in enumerate(texts):
        data[starts[i] : starts[i] + len(t)] = np.frombuffer(t, dtype=np.uint8).astype(np.int16) + 1
        owner[starts[i] : starts[i + 1]] = i
    order, whole = repeat_intervals(data, length)
    group = np.cumsum(~whole) - 1
    room = order - starts[owner[order]] + length <= sizes[owner[order]]  # the string ends inside its text
    weight = np.bincount(group, weights=np.asarray(weights)[owner[order]] * room)
    hit = room & (weight[group] >= 2)
    found, of = order[hit], owner[order[hit]]
    by = np.lexsort((found, of))
    found, of = found[by] - starts[of[by]], of[by]
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    return [found[cuts[i] : cuts[i + 1]] for i in range(len(texts))]


def covered(starts: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """The union of [s, s + length) over sorted starts, as disjoint runs."""
    if not len(starts):
        return [], []
    new = np.concatenate(([True], starts[1:] > starts[:-1] + length))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first].tolist(), (starts[last] + length).tolist()


VERDICT = "gram long, around long, lows array<int>, highs array<int>"
MEMBER = "gram long, around long, base int, weight long, data binary"


def judged(members: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Verdicts on members (gram, around, base, weight, data), whole groups in shards of bounded size.

    Runs are relative to the anchor, which stands ``base`` bytes into data. Copies of a member follow each other and
    count as one.
    """

    def shard(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        starts = repeated_starts(rows["data"].tolist(), rows["weight"].tolist(), length)
        for gram, around, base, own in zip(rows["gram"], rows["around"], rows["base"], starts, strict=True):
            lows, highs = covered(own - base, length)
            if lows:
                out.append((gram, around, lows, highs))
        return pd.DataFrame(out, columns=["gram", "around", "lows", "highs"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None  # the last group met, which may go on, and whole groups before it
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            rows = rows.drop_duplicates(["gram", "around"], ignore_index=True)
            if not len(rows):
                continue
            gram = rows["gram"].to_numpy()
            heads = np.append(np.flatnonzero(np.diff(gram, prepend=gram[0] - 1)), len(rows))
            sizes = np.concatenate(([0], np.cumsum(rows["data"].map(len).to_numpy())))
            at = 0
            for begin, end in zip(heads[:-1], heads[1:], strict=True):
                if begin > at and sizes[end] - sizes[at] > shard_bytes:
                    yield shard(rows.iloc[at:begin])
                    at = begin
            held = rows.iloc[at:]
        if held is not None and len(held):
            yield shard(held)

    dealt = members.select("gram", "around", "base", "weight", "data").repartition("gram").sortWithinPartitions("gram", "around")
    return dealt.mapInPandas(run, VERDICT)


def parted(members: DataFrame, places: int, length: int, gram: int) -> DataFrame:
    """Members parted by the anchor's place in their strings; core: what all strings of a part share, part: its bytes."""
    total = length - gram + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = SpanHasher()
        columns = ["gram", "around", "core", "part", "base", "weight", "data"]
        with np.errstate(over="ignore"):
            for batch in batches:
                out = []
                for g, around, base, weight, data in zip(
                    batch["gram"], batch["around"], batch["base"], batch["weight"], batch["data"], strict=True
                ):
                    prefix = hasher.prefix(np.frombuffer(data, dtype=np.uint8))
                    for low in range(0, total, places):
                        high = min(low + places, total) - 1  # the anchor stands ``low`` to ``high`` bytes into the string
                        begin, end = max(0, base - high), min(len(data), base - low + length)
                        if base < low or end - begin < length:
                            continue
                        spans = hasher.spans(prefix, np.array([base - low, begin]), np.array([base - high + length, end]))
                        core, part = (spans ^ np.uint64(low + 1) * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64).tolist()
                        out.append((g, around, core ^ g, part, base - begin, weight, data[begin:end]))
                    if len(out) > 5000:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
                yield pd.DataFrame(out, columns=columns)

    schema = "gram long, around long, core long, part long, base int, weight long, data binary"
    return members.select("gram", "around", "base", "weight", "data").mapInPandas(run, schema)


def grouped(distinct: DataFrame) -> DataFrame:
    """Distinct members of the groups that weigh two or more, with their group's number of members."""
    groups = distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("members"), F.sum("weight").alias("total"))
    return distinct.join(groups.filter("total > 1").select("gram", "members"), "gram")


def whole_pieces(rows: DataFrame, low, high) -> DataFrame:
    """A member that is alone in its group, and so weighs two or more, repeats as a whole."""
    return rows.filter("members = 1").select("gram", "around", F.array(low.cast("int")).alias("lows"), F.array(high.cast("int")).alias("highs"))


def resolved(members: DataFrame, levels: tuple[int, ...], length: int, gram: int, group_members: int, shard_bytes: int) -> DataFrame:
    """Verdicts on members with data in groups of two or more; large groups are parted level by level."""
    found = judged(members.filter(F.col("members") <= group_members), length, shard_bytes)
    large = members.filter(F.col("members") > group_members)
    if not levels or large.isEmpty():
        return found
    parts = stored(parted(large, levels[0], length, gram), "parts")
    distinct = parts.groupBy(F.col("core").alias("gram"), F.col("part").alias("around")).agg(
        F.sum("weight").alias("weight"), F.min("base").alias("base"), F.min("data").alias("data")
    )
    distinct = stored(grouped(distinct), "cores")
    alone = whole_pieces(distinct, -F.col("base"), F.octet_length("data") - F.col("base"))
    below = resolved(distinct.filter("members > 1"), levels[1:], length, gram, group_members, shard_bytes)
    below = alone.unionByName(below).withColumnsRenamed({"gram": "core", "around": "part"})
    return found.unionByName(parts.select("gram", "around", "core", "part").join(below, ["core", "part"]).select("gram", "around", "lows", "highs"))


def verdicts(
    docs: DataFrame, table: DataFrame, length: int, gram: int, group_members: int, shard_bytes: int, encoder: Callable = utf8
) -> DataFrame:
    """Runs to remove around each (gram, neighbourhood), relative to the anchor; several rows may add up."""
    distinct = table.groupBy("gram", "around").agg(
        F.count(F.lit(1)).alias("weight"), F.min(F.struct("id", "mark", "place", "left", "right")).alias("at")
    )
    repeated = stored(grouped(distinct), "repeated")
    alone = whole_pieces(repeated, -F.col("at.left"), F.col("at.right"))
    members = stored(with_data(docs, repeated.filter("members > 1"), encoder), "members")
    return alone.unionByName(resolved(members, (REFINED, 1), length, gram, group_members, shard_bytes))


def with_data(docs: DataFrame, rows: DataFrame, encoder: Callable = utf8) -> DataFrame:
    """``rows`` with the bytes of their neighbourhood, cut from the text of the document that stands for it."""
    wanted = rows.groupBy("at.id", "at.mark").agg(
        F.collect_list(F.struct("gram", "around", "weight", "members", "at.place", "at.left", "at.right")).alias("wanted")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["gram", "around", "base", "weight", "members", "data"]
        seen: set[tuple[str, int]] = set()
        encode = encoder()
        for batch in batches:
            out = []
            for id, mark, text, own in zip(batch["id"], batch["mark"], batch["text"], batch["wanted"], strict=True):
                if (id, mark) in seen:  # a repeated row
                    continue
                seen.add((id, mark))
                data = encode(text)
                out += [
                    (w["gram"], w["around"], w["left"], w["weight"], w["members"], data[w["place"] - w["left"] : w["place"] + w["right"]])
                    for w in own
                ]
            yield pd.DataFrame(out, columns=columns)

    texts = keyed(docs).select("key.id", "key.mark", "text")
    found = texts.join(wanted, ["id", "mark"]).select("id", "mark", "text", "wanted")
    # Repeated rows that reach several tasks give their members more than once; they weigh two already.
    return found.mapInPandas(run, f"{MEMBER}, members long")


def removed_runs(
    docs: DataFrame, length: int, gram: int, group_members: int, shard_bytes: int, encoder: Callable = utf8, shortest: int | None = None
) -> DataFrame:
    """Per text key the runs of bytes to remove, possibly overlapping; texts are judged by what ``encoder`` makes of them."""
    table = anchor_table(docs, length, gram, encoder, shortest)
    found = stored(verdicts(docs, table, length, gram, group_members, shard_bytes, encoder), "verdicts")
    joined = table.select("id", "mark", "place", "gram", "around").join(found, ["gram", "around"])
    runs = joined.select("id", "mark", "place", F.explode(F.arrays_zip("lows", "highs")).alias("run"))
    run = F.struct((F.col("place") + F.col("run.lows")).alias("low"), (F.col("place") + F.col("run.highs")).alias("high"))
    # Repeated rows have equal runs: a set keeps each once, before anything moves.
    return runs.groupBy("id", "mark").agg(F.collect_set(run).alias("runs"))


def cut_text(text: str, runs) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, maximal removed runs, and the bytes that stay."""
    data = text.encode("utf-8", "surrogatepass")
    parts, at, gone, spans, until = [], 0, 0, 0, -1
    for low, high in sorted((r["low"], r["high"]) for r in runs or ()):
        spans += low > until
        if low > at:
            parts.append(data[at:low])
        if high > at:
            gone += high - max(at, low)
            at = high
        until = max(until, high)
    parts.append(data[at:])
    return len(data), gone, spans, b"".join(parts)


def suffix_dedup(
    docs: DataFrame,
    *carried: str,
    length: int = LENGTH,
    gram: int = GRAM,
    group_members: int = GROUP_MEMBERS,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Per document the carried columns, byte counts, the number of removed runs, the bytes that stay and their text."""
    with temporary_tables(docs.sparkSession):
        runs = stored(removed_runs(docs, length, gram, group_members, shard_bytes), "runs", keep=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [cut_text(t, r) for t, r in zip(batch.column("_text").to_pylist(), batch.column("_runs").to_pylist(), strict=True)]
            added = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            added.append(pa.array([r[3] for r in rows], pa.binary()))
            added.append(pa.array([r[3].decode("utf-8", "ignore") for r in rows], pa.string()))
            names = [c for c in batch.schema.names if c not in ("_text", "_runs")]
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, *added], [*names, "n_bytes", "n_removed", "n_spans", "kept", "kept_text"])

    text = text_or_empty()
    key = (F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.xxhash64(text).alias("_mark"))
    rows = docs.select(*carried, text.alias("_text"), *key)
    own = runs.select(F.col("id").alias("_id"), F.col("mark").alias("_mark"), F.col("runs").alias("_runs"))
    joined = rows.join(own, ["_id", "_mark"], "left").drop("_id", "_mark")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name not in ("_text", "_runs")]
    return joined.mapInArrow(run, ", ".join([*fields, "n_bytes long, n_removed long, n_spans long, kept binary, kept_text string"]))


def suffix_dedup_digest(docs: DataFrame) -> DataFrame:
    rows = suffix_dedup(docs, "doc_id")
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), F.col("kept_text").alias("text"))
