"""Table access, materialised intermediates and byte-span hashing shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.session import remove_path, scratch_path, session_conf


#: Texts differ in length by orders of magnitude, so batches sent to Python workers are bounded in bytes.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: A written table is read instead of the shuffles that led to it, so their files can go at once.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

#: Tables written in the open ``temporary_tables`` blocks.
_TEMPORARY: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` writes inside the block go at its end, when nothing may read them any more."""
    _TEMPORARY.append([])
    try:
        yield
    finally:
        for path in _TEMPORARY.pop():
            remove_path(spark, path)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors, frees its shuffles.

    ``keep`` lets the table outlive the ``temporary_tables`` block it is written in, up to the end of the one around it.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = scratch_path(spark, name)
    blocks = _TEMPORARY[:-1] if keep else _TEMPORARY
    if blocks:
        blocks[-1].append(path)
    with session_conf(spark, DROP_SHUFFLES):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions(df: DataFrame) -> int:
    """The session's shuffle width, the number of tasks a keyed exchange is dealt to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser (xor-shift-multiply) of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHasher:
    """64-bit hashes of any byte span of a text, from one prefix sum.

    A span's hash is the polynomial sum of its (randomised) bytes modulo 2**64,
    taken as a difference of prefix sums and shifted to exponent zero by the
    inverse power; equal spans have equal hashes wherever they stand. Powers
    grow on demand to the longest text met.
    """

    def __init__(self) -> None:
        with np.errstate(over="ignore"):
            self.byte = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)
        self.base = int(_BASE)
        self.inverse = pow(self.base, -1, 1 << 64)
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        def powers(b: int) -> np.ndarray:
            out = np.full(n, b, dtype=np.uint64)
            out[0] = 1
            return np.cumprod(out, dtype=np.uint64)

        self.power, self.back = powers(self.base), powers(self.inverse)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums (length n + 1) of the byte array ``data``."""
        n = len(data)
        if n + 1 > len(self.power):
            self._grow(max(n + 1, 2 * len(self.power)))
        out = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.byte[data] * self.power[:n], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the spans [start, end); the length is mixed in."""
        raw = (prefix[end] - prefix[start]) * self.back[start]
        return mix64(raw + (end - start).astype(np.uint64) * _BASE)

    def raw_grams(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Polynomial sums of all k-byte spans, by start; their leading bits are well mixed."""
        m = len(prefix) - k
        return (prefix[k:] - prefix[:m]) * self.back[:m] if m > 0 else np.zeros(0, dtype=np.uint64)


def word_spans(joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array whose words are parted by single spaces."""
    gaps = np.flatnonzero(joined == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(joined)]))
    return starts, ends


def shingle_hashes(hasher: SpanHasher, words: list[bytes], size: int) -> np.ndarray:
    """Hashes of the ``size``-word windows of ``words``, in order (repeats kept).

    A shorter, non-empty sequence is one window.
    """
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = np.frombuffer(b" ".join(words), dtype=np.uint8)
    starts, ends = word_spans(joined)
    k = min(size, len(starts))
    return hasher.spans(hasher.prefix(joined), starts[: len(starts) - k + 1], ends[k - 1 :])


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, for things read from files (tokenizers)."""
    import sys
    import types

    return vars(sys.modules.setdefault("_candela_worker_cache", types.ModuleType("_candela_worker_cache")))
