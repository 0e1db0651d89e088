"""Deduplication with keyed state: timers bound the state, no lookup in silver.

State is kept per (symbol, bucket of event time): the dedup keys seen there. A
batch's copies are reduced to the earliest delivered one, keys already seen are
dropped, the rest is emitted and remembered. The stream's watermark lags the
latest event by ``horizon``; when it passes a bucket's end, a timer clears the
bucket, since ticks of it no longer come through. The state so never holds more
than the keys of the last ``horizon`` plus one bucket.

Exact for copies within the horizon. A tick more than ``horizon`` behind the
latest one is not judged (the engine drops it as late): ``late.start_late_split``
with the same delay keeps such ticks in a side table.

Needs the RocksDB state store (``ROCKSDB``).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from candela.operators.ingest import decode_envelope, parse_ticks
from candela.operators.quality import silver_predicate
from candela.schema import LINEAGE_COLS, TICK_COLS

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}
HORIZON = "1 day"
BUCKET = "1 hour"


def first_deliveries(columns: list[str], order: list[str]) -> StatefulProcessor:
    """The processor of one (symbol, bucket). Defined inside a function, so workers needn't import this package."""
    import pandas as pd

    class FirstDeliveries(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.seen = handle.getListState("seen", "event_time timestamp, source string")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            known = {(pd.Timestamp(t), s) for t, s in self.seen.get()} if self.seen.exists() else set()
            best: dict[tuple, tuple] = {}
            for part in rows:
                part = part.sort_values(order, kind="stable").drop_duplicates(["event_time", "source"])
                for row in part[columns].itertuples(index=False, name=None):
                    k = row[columns.index("event_time")], row[columns.index("source")]
                    rank = tuple(row[columns.index(c)] for c in order)
                    if k not in known and (k not in best or rank < best[k][0]):
                        best[k] = rank, row
            if not best:
                return
            if not known:
                self.handle.registerTimer(int(key[1].timestamp() * 1000))
            self.seen.appendList([(t.to_pydatetime(), s) for t, s in best])
            yield pd.DataFrame([row for _, row in best.values()], columns=columns)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            self.seen.clear()
            yield from ()

        def close(self) -> None:
            pass

    return FirstDeliveries()


def first_delivered(ticks: DataFrame, horizon: str = HORIZON, bucket: str = BUCKET) -> DataFrame:
    """A stream of ticks with lineage, one row per (symbol, event_time, source): the earliest delivered copy."""
    columns = [*TICK_COLS, *LINEAGE_COLS]
    rows = ticks.select(*columns).withWatermark("event_time", horizon)
    keyed = rows.withColumn("_until", F.window("event_time", bucket).end)
    schema = StructType([rows.schema[c] for c in columns])
    return keyed.groupBy("symbol", "_until").transformWithStateInPandas(
        statefulProcessor=first_deliveries(columns, LINEAGE_COLS), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )


def start_silver_dedup_state(
    envelope: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    horizon: str = HORIZON,
    bucket: str = BUCKET,
) -> StreamingQuery:
    """Silver as a stream: quality rules, then one row per key from keyed state, appended to files."""
    parsed = parse_ticks(decode_envelope(envelope)).drop("json_value")
    clean = parsed.filter(silver_predicate(parsed.columns))
    out = first_delivered(clean, horizon, bucket).withColumn("event_date", F.to_date("event_time"))
    w = out.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(**(trigger or {"processingTime": "15 seconds"}))
    return w.format("parquet").partitionBy("event_date").option("path", path).start()
