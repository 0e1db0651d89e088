"""Passages of more than ``WORDS - 1`` words that also stand elsewhere, cut out of their texts.

A text's words are written as codes of ``CODE`` letters each (a 48-bit hash),
without what stands between them, so a string of ``WORDS`` words is a string of
``WORDS * CODE`` bytes of the coded text, however long its words are. The
suffix-array dedup finds the repeated strings of that length; the words they
cover whole are cut, from the first letter of a run's first word to the last
letter of its last. Coded texts, larger than the texts, are made where they are
needed: for the anchors, and again for the texts that neighbourhoods are cut
from; they are neither written nor shuffled.

A word is a run of anything but white space; in scripts written without spaces
each letter counts as a word. Words are compared as they stand, the white space
between them isn't. Defined results are those of ``suffix_dedup``, but a cut
never goes through a character.
"""

from __future__ import annotations

import re
from base64 import b64encode
from collections.abc import Callable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import stored, temporary_tables, text_or_empty
from candela.llm.suffix_dedup import GROUP_MEMBERS, SHARD_BYTES, removed_runs

WORDS = 51
CODE = 8
#: Bytes of the grams that anchor strings of ``WORDS`` words.
GRAM = 15 * CODE
#: Codes that a task remembers.
KNOWN = 200_000

#: Thai, Lao, Burmese, Khmer, kana, Chinese characters.
UNSPACED = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
WORD = re.compile(rf"[{UNSPACED}]|[^\s{UNSPACED}]+")


class Codes(dict):
    """The code of a word."""

    def __missing__(self, word: str) -> bytes:
        code = b64encode(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=CODE * 6 // 8).digest())
        if len(self) < KNOWN:
            self[word] = code
        return code


def coded() -> Callable[[str], bytes]:
    """Encoder of texts as the codes of their words."""
    codes = Codes()
    return lambda text: b"".join([codes[w] for w in WORD.findall(text)])


def cut_words(text: str, runs) -> tuple[int, str]:
    """The number of words cut, and the text without the words that ``runs`` of the coded text cover whole."""
    if not runs:
        return 0, text
    spans: list[list[int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in runs):
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    places = [m.span() for m in WORD.finditer(text)]
    parts, at, gone = [], 0, 0
    for low, high in spans:
        first, last = -(-low // CODE), high // CODE
        parts.append(text[at : places[first][0]])
        at = places[last - 1][1]
        gone += last - first
    return gone, "".join(parts) + text[at:]


def without_repeated_passages(docs: DataFrame, key: str, *carried: str, words: int = WORDS) -> DataFrame:
    """The carried columns, the number of words cut and the text that stays; ``key`` tells different rows apart."""
    with temporary_tables(docs.sparkSession):
        texts = docs.select(F.col(key).alias("doc_id"), "text")
        # A word has a byte at least, so shorter texts have fewer words.
        found = removed_runs(texts, words * CODE, GRAM, GROUP_MEMBERS, SHARD_BYTES, coded, shortest=words)
        runs = stored(found, "runs", keep=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [cut_words(t, r) for t, r in zip(batch.column("_text").to_pylist(), batch.column("_runs").to_pylist(), strict=True)]
            added = [pa.array([n for n, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *added], [*carried, "n_words_cut", "kept"])

    own = runs.select(F.col("id").alias("_id"), F.col("runs").alias("_runs"))
    rows = docs.select(*carried, text_or_empty().alias("_text"), F.col(key).cast("string").alias("_id"))
    joined = rows.join(own, "_id", "left").drop("_id")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name in carried]
    return joined.mapInArrow(run, ", ".join([*fields, "n_words_cut long", "kept string"]))
