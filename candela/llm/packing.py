"""Best-fit packing of token sequences by a tree of residual rounds.

Texts are tokenised, ended by id 0 and cut into pieces of at most ``capacity``
tokens. The first round deals the pieces to tasks; each task packs its own by
best fit (largest first, into the fullest sequence with room). Nearly full
sequences are emitted. The underfull ones become items of the next round, in
which fewer tasks pack them by best fit again, and so on up the tree. Rounds
end when one task has seen all underfull sequences, or when a round no longer
joins any; a task never gets more than ``items_per_task`` items.

Every round is written before the next reads it, so a lost executor repeats
its own task and ids never change.

Defined results: a null or empty text is the one id 0; repeated rows are
packed each; null ids pass through; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import partitions, stored, text_or_empty, worker_cache

CAPACITY = 2048
NEARLY_FULL = 0.995
FAN_IN = 8
ITEMS_PER_TASK = 1_000_000
#: Distinct words whose ids a worker remembers.
CACHED_WORDS = 300_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: A run of Latin letters with at most ASCII marks behind it, the shape of most words.
PLAIN_WORD = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-&(-/:-@\[-`{-~]*)")


def byte_letters() -> dict[int, int]:
    """The printable letter that byte-level models write for each byte: itself, or the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(rest)}


class WordIds(dict):
    """Little-endian unsigned 32-bit ids by word; the tokenizer drops white space, so words are independent.

    The tokenizer also parts letters from marks and ignores case, so a plain word is the ids of its lower-case letters,
    which go to the BPE model itself, and those of its marks. Any other word takes the tokenizer's full way.
    """

    def __init__(self, path: str, limit: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.parts: dict[str, bytes] = {"": b""}

    def full(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def part(self, letters: str) -> bytes:
        ids = self.parts.get(letters)
        if ids is None:
            spelled = letters.encode().decode("latin-1").translate(self.letters)
            ids = b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled))
            if len(self.parts) >= self.limit:
                self.parts.clear()
            self.parts[letters] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        plain = PLAIN_WORD.fullmatch(word)
        if plain is None:
            ids = self.full(word)
        else:
            letters, marks = plain.groups()
            ids = self.part(letters.lower())
            if marks:
                if marks not in self:
                    self[marks] = self.full(marks)
                ids += self[marks]
        if len(self) >= self.limit:
            self.clear()
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, words))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of the tokenised texts: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids."""
    doc_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache()
        if tokenizer not in cache:
            cache[tokenizer] = WordIds(tokenizer, CACHED_WORDS)
        words = cache[tokenizer]
        end = np.array([end_id], dtype="<u4").tobytes()
        width = 4 * capacity
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("_text").to_pylist()):
                data = words.encode(text) + end
                for at in range(0, len(data), width):
                    part = data[at : at + width]
                    row.append(i)
                    piece.append(at // width)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = [
                batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select("doc_id", text_or_empty().alias("_text"))
    schema = f"doc_id {doc_type.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(run, schema + (", ids binary" if with_ids else ""))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size, and the fill of each bin; best fit, largest first."""
    bins = np.zeros(len(sizes), dtype=np.int64)
    offsets = np.zeros(len(sizes), dtype=np.int64)
    fill: list[int] = []
    rooms: list[int] = []  # the residuals that occur, ascending
    open_bins: dict[int, list[int]] = {}
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = bisect.bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            stack = open_bins[room]
            b = stack.pop()
            if not stack:
                del open_bins[room], rooms[at]
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        left = room - size
        if left:
            if left not in open_bins:
                bisect.insort(rooms, left)
                open_bins[left] = []
            open_bins[left].append(b)
    return bins, offsets, np.array(fill, dtype=np.int64)


def packed_round(items: DataFrame, level: int, tasks: int, capacity: int) -> DataFrame:
    """``items`` (item, length, others) with bin, offset in it and the bin's fill, packed task by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        table = table.take(pa.compute.sort_indices(table, [("item", "ascending")]))
        sizes = table.column("length").to_numpy()
        bins, offsets, fill = best_fit(sizes, capacity)
        base = (level << 58) | (TaskContext.get().partitionId() << 34)
        table = table.append_column("bin", pa.array(bins + base, pa.int64()))
        table = table.append_column("offset", pa.array(offsets, pa.int64()))
        table = table.append_column("fill", pa.array(fill[bins], pa.int64()))
        yield from table.combine_chunks().to_batches(max_chunksize=50_000)

    dealt = items.repartition(tasks, "item")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema]
    return dealt.mapInArrow(run, ", ".join([*fields, "bin long", "offset long", "fill long"]))


def pack(
    items: DataFrame, capacity: int = CAPACITY, nearly_full: float = NEARLY_FULL, fan_in: int = FAN_IN, items_per_task: int = ITEMS_PER_TASK
) -> DataFrame:
    """``items`` (item: unique long, length: 1 to ``capacity``, others) with sequence_id and offset."""
    count = items.count()
    tasks = max(1, min(partitions(items), count // 1000), -(-count // items_per_task))
    first = stored(packed_round(items, 1, tasks, capacity), "pack-1")
    rounds, level, last = [], 1, first
    while True:
        # The piece at offset 0 stands for its bin; the id of a bin is the item of the next round.
        under = last.filter((F.col("offset") == 0) & (F.col("fill") < nearly_full * capacity))
        under = under.select(F.col("bin").alias("item"), F.col("fill").alias("length"))
        waiting = under.count()
        if tasks == 1 or waiting < 2 or level >= 15:
            break
        tasks, level = max(1, -(-tasks // fan_in), -(-waiting // items_per_task)), level + 1
        last = stored(packed_round(under, level, tasks, capacity), f"pack-{level}")
        rounds.append(last)
        left = last.filter("offset = 0").count()
        if left == waiting and tasks > 1 and tasks == -(-waiting // items_per_task):
            break
    final = None
    for level_rows in reversed(rounds):
        step = level_rows.select(F.col("item").alias("_bin"), F.col("bin").alias("_to"), F.col("offset").alias("_at"))
        if final is not None:
            up = final.select(F.col("_bin").alias("_to"), F.col("_to").alias("_up"), F.col("_at").alias("_more"))
            step = step.join(up, "_to", "left").select(
                "_bin", F.coalesce("_up", "_to").alias("_to"), (F.col("_at") + F.coalesce("_more", F.lit(0))).alias("_at")
            )
        final = step
    if final is None:
        return first.withColumnRenamed("bin", "sequence_id").drop("fill", "item")
    joined = first.withColumnRenamed("bin", "_bin").join(final, "_bin", "left")
    return joined.select(
        *[c for c in items.columns if c != "item"],
        F.coalesce("_to", "_bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("_at", F.lit(0))).alias("offset"),
    )


def best_fit_packing(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of ``docs`` with their sequence and place in it."""
    cut = pieces(docs, tokenizer or tokenizer_path(), capacity, with_ids=with_ids)
    return pack(stored(cut.withColumn("item", F.monotonically_increasing_id()), "pieces"), capacity)
