"""Bounded replays of an envelope table through a streaming query.

Records are landed chunk by chunk (by delivery time) into one folder, and the
query is restarted with ``availableNow`` from the same checkpoint after each
chunk — the way a stream sees data arrive over time, and a restart test at
every chunk boundary.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candela.session import scratch_path
from candela.streaming.sources import file_source

# Fixed chunk boundaries of the replay fixture (delivery time): days 1-7, 8-15,
# 16-23, 24-end. The outer chunks are open-ended, so every record lands once.
DAY_BOUNDS = ("2024-01-08", "2024-01-16", "2024-01-24")


def chunks(envelope: DataFrame, bounds: Sequence[str] = DAY_BOUNDS) -> list[DataFrame]:
    ts = F.col("timestamp")
    edges = [None, *bounds, None]
    out = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (ts >= F.lit(lo).cast("timestamp"))
        if hi is not None:
            cond = cond & (ts < F.lit(hi).cast("timestamp"))
        out.append(envelope.filter(cond))
    return out


def replay(
    spark: SparkSession,
    envelope: DataFrame,
    start: Callable[[DataFrame, str], StreamingQuery],
    reverse: bool = False,
    bounds: Sequence[str] = DAY_BOUNDS,
) -> None:
    """Land each chunk, then drain it with ``start(stream, checkpoint)``."""
    landing = scratch_path(spark, "landing")
    checkpoint = scratch_path(spark, "checkpoint")
    parts = chunks(envelope, bounds)
    if reverse:
        parts = parts[::-1]
    for part in parts:
        part.write.mode("append").parquet(landing)
        q = start(file_source(spark, landing), checkpoint)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"replay stream failed: {q.exception()}")
