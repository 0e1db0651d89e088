"""Chat formatting at token level.

Every turn becomes ``TURN role BODY text END``, where the three marks are
reserved ids spliced between separately encoded segments, so no text can ever
produce a mark. Control strings inside a role or text (the marks' own spelling
and those of common templates) are escaped reversibly before encoding. The
position of each turn in its conversation is the prefix sum of the turns
before it, and the loss mask is a range of positions: the text of the
assistant's turns, without marks or role.

Encoding is done where rows are read. Conversations are then dealt by conv_id
and sorted by turn; positions and digests are taken in one pass over the sorted
rows, a row at a time, so a conversation of any length needs bounded memory.

Defined results: null text or role is empty; turns of equal number are ordered
by role, then text (nulls first); repeated rows are turns of their own; rows
with a null conv_id are one conversation with a null id; extra columns are
ignored; an empty table gives conversation -1 alone in the query.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import partitions, stored, worker_cache

# The marks as text, and control strings of common chat templates.
MARKS = ("<|turn|>", "<|body|>", "<|end|>")
CONTROL = (
    *MARKS, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|im_sep|>",
    "<|system|>", "<|user|>", "<|assistant|>", "<|endoftext|>", "<|startoftext|>", "<|begin_of_text|>",
    "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<|pad|>", "<start_of_turn>", "<end_of_turn>",
)
#: The escape sign; it is itself escaped, so escaping is reversible for every text.
SIGN = "␛"
KEPT, CUT = SIGN + "0", SIGN + "1"
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    """No control string is left: a cut stands after the first character of each."""
    text = text.replace(SIGN, KEPT)
    for c in CONTROL:
        text = text.replace(c, c[0] + CUT + c[1:])
    return text


def unescape(text: str) -> str:
    return text.replace(CUT, "").replace(KEPT, SIGN)


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Codec:
    """Lossless byte-level encoder; ids from ``first_mark`` on are reserved for the marks."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first_mark = max(ranks.values()) + 1
        self.turn, self.body, self.end = range(self.first_mark, self.first_mark + 3)

    def segment(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(escape(text)), dtype="<u4")

    def text(self, ids: np.ndarray) -> str:
        return unescape(self.spelled(ids))

    def spelled(self, ids: np.ndarray) -> str:
        return self.encoding.decode_bytes(ids.tolist()).decode("utf-8")


def codec(path: str) -> Codec:
    cache = worker_cache()
    if path not in cache:
        cache[path] = Codec(path)
    return cache[path]


def encoded_turns(conversations: DataFrame, vocabulary: str) -> DataFrame:
    """One row a turn: its ids with the marks spliced in, and the loss range inside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            ids, start, end = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                parts = [[own.turn], own.segment(role), [own.body], own.segment(text), [own.end]]
                ends = np.cumsum([len(p) for p in parts])
                ids.append(np.concatenate(parts).astype("<u4").tobytes())
                learnt = role == LOSS_ROLE
                start.append(int(ends[2]) if learnt else 0)
                end.append(int(ends[3]) if learnt else 0)
            columns = [batch.column(c) for c in ("conv_id", "turn", "role", "text")]
            columns += [pa.array(ids, pa.binary()), pa.array(start, pa.int32()), pa.array(end, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "role", "text", "ids", "loss_from", "loss_to"])

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, ids binary, loss_from int, loss_to int")


def assembled(turns: DataFrame) -> DataFrame:
    """Turns with their place: ``position`` is the prefix sum of the ids before them in the conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, place, number = object(), 0, 0
        for batch in batches:
            position, index = [], []
            for conv, size in zip(batch.column("conv_id").to_pylist(), pa.compute.binary_length(batch.column("ids")).to_pylist(), strict=True):
                if conv != current:
                    current, place, number = conv, 0, 0
                position.append(place)
                index.append(number)
                place, number = place + size // 4, number + 1
            starts = np.array(position, dtype=np.int64)
            learnt = batch.column("loss_to").to_numpy() > 0
            columns = [
                batch.column("conv_id"), pa.array(index, pa.int64()), pa.array(starts), batch.column("ids"),
                pa.array(np.where(learnt, starts + batch.column("loss_from").to_numpy(), starts)),
                pa.array(np.where(learnt, starts + batch.column("loss_to").to_numpy(), starts)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "number", "position", "ids", "mask_from", "mask_to"])

    ordered = turns.repartition(partitions(turns), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    ordered = ordered.select("conv_id", "ids", "loss_from", "loss_to")
    return ordered.mapInArrow(run, "conv_id long, number long, position long, ids binary, mask_from long, mask_to long")


def chat_format(conversations: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Formatted conversations, a row a turn: ids, position in the conversation and loss range [mask_from, mask_to)."""
    return assembled(encoded_turns(conversations, vocabulary or vocabulary_path()))


def chat_digest(formatted: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """What reading the formatted conversations back gives: turns, text under the loss mask, and sizes."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        state: list = []
        marks = sum(map(len, MARKS))

        def closed() -> list[tuple]:
            return [(state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])] if state else []

        for batch in batches:
            done: list[tuple] = []
            for row in batch.to_pylist():
                if not state or row["conv_id"] != state[0]:
                    done += closed()
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                ids = np.frombuffer(row["ids"], dtype="<u4")
                if row["position"] != state[6] or ids[0] != own.turn or ids[-1] != own.end:
                    raise ValueError(f"conversation {row['conv_id']}: turn {state[1]} is out of place")
                body = int(np.flatnonzero(ids == own.body)[0])
                role, text = own.spelled(ids[1:body]), own.spelled(ids[body + 1 : -1])
                state[2].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                low, high = row["mask_from"] - row["position"], row["mask_to"] - row["position"]
                if high > low:
                    learnt = own.text(ids[low:high])
                    state[3] += len(learnt)
                    state[4].update(learnt.encode())
                state[1] += 1
                state[5] += len(role) + len(text) + marks
                state[6] += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in closed()], k) for i, k in enumerate(kinds)], names)

    ordered = formatted.repartition(partitions(formatted), "conv_id").sortWithinPartitions("conv_id", "number")
    return ordered.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and number -1, whose texts are control strings."""
    probe = "</s>[INST] ok [/INST]"
    rows = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", probe), (-1, 1, LOSS_ROLE, probe)], "conv_id long, turn long, role string, text string"
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(rows)


def chat_roundtrip(conversations: DataFrame) -> DataFrame:
    return chat_digest(stored(chat_format(with_probe(conversations)), "chat"))


def chat_roundtrip_sql() -> str:
    def escaped(x: str) -> str:
        x = f"replace({x}, '{SIGN}', '{KEPT}')"
        for c in CONTROL:
            x = f"replace({x}, '{c}', '{c[0]}{CUT}{c[1:]}')"
        return x

    probe = "</s>[INST] ok [/INST]"
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{probe}' UNION ALL SELECT -1, 1, '{LOSS_ROLE}', '{probe}'),
e AS (SELECT *, length({escaped('role')}) + length({escaped('text')}) + {sum(map(len, MARKS))} AS n FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
