"""Stored daily states: gold brought up to date by merging partial aggregates, without reading old ticks.

The state log holds, per batch of ticks, one mergeable state a (symbol,
trade_date): first and last price with their times, extremes, count, sum and M2.
The state of a day is the merge of what all batches say of it. A batch writes
only its own folder (overwritten as a whole), so running it again changes
nothing, and a late tick is just a small state of an old day.

Layout: ``path/gen=G/batch_id=B/trade_date=D``. A generation counts once Spark has
written its ``_SUCCESS`` file, which is its last step, so a rebuild or a compaction
is seen whole or not at all; older generations are removed after that. One job
writes the log at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from candela.functions.indicators import RSI_PERIOD
from candela.operators.gold import (
    DEFAULT_TICK_ORDER,
    STATE_COLS,
    gold_from_daily,
    merge_states,
    ohlcv,
    partial_days,
    recomputed_rows,
)
from candela.schema import DAILY_STATE
from candela.session import remove_path

LOG_SCHEMA = StructType([*DAILY_STATE.fields, StructField("batch_id", StringType(), True)])
BASE_BATCH = "base"


def daily_states(ticks: DataFrame) -> DataFrame:
    """One state per (symbol, trade_date) of the given ticks."""
    return merge_states(partial_days(ticks, *DEFAULT_TICK_ORDER))


def generations(spark: SparkSession, path: str) -> list[int]:
    """Complete generations of a state log, ascending (empty: no log)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    numbers = [int(n.removeprefix("gen=")) for n in names if n.startswith("gen=")]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(g for g in numbers if fs.exists(done(f"{path}/gen={g}/batch_id={BASE_BATCH}/_SUCCESS")))


def write_generation(states: DataFrame, path: str) -> None:
    """A new generation with ``states`` as its only batch; older ones go once it is complete."""
    spark = states.sparkSession
    old = generations(spark, path)
    new = old[-1] + 1 if old else 0
    write_batch(states, f"{path}/gen={new}", BASE_BATCH)
    for g in old:
        remove_path(spark, f"{path}/gen={g}")


def write_batch(states: DataFrame, generation: str, batch: str) -> None:
    """A batch's states, replacing what an earlier run of the same batch wrote."""
    rows = states.select(*STATE_COLS).hint("rebalance", "trade_date")
    rows.write.mode("overwrite").partitionBy("trade_date").parquet(f"{generation}/batch_id={batch}")


def state_log(spark: SparkSession, path: str) -> DataFrame:
    """All states of the current generation, several a day; ``trade_date`` filters prune folders."""
    current = generations(spark, path)
    if not current:
        raise FileNotFoundError(f"no complete state log at {path}")
    return spark.read.schema(LOG_SCHEMA).parquet(f"{path}/gen={current[-1]}")


def append_batch(ticks: DataFrame, path: str, batch: str) -> DataFrame:
    """Write the states of new ticks under ``batch`` and return them."""
    spark = ticks.sparkSession
    if batch == BASE_BATCH:
        raise ValueError(f"{BASE_BATCH!r} names the rebuilt batch")
    current = f"{path}/gen={generations(spark, path)[-1]}"
    write_batch(daily_states(ticks), current, batch)
    return spark.read.schema(DAILY_STATE).parquet(f"{current}/batch_id={batch}")


def compact(spark: SparkSession, path: str) -> None:
    """Fold all batches into one state a day, as a new generation.

    Run it when no earlier batch will be run again: their folders are gone.
    """
    write_generation(merge_states(state_log(spark, path).select(*STATE_COLS)), path)


def gold_from_states(states: DataFrame) -> DataFrame:
    """Full gold from a state log: ticks aren't read."""
    return gold_from_daily(ohlcv(merge_states(states.select(*STATE_COLS))))


def gold_changes(
    gold_prev: DataFrame, path: str, batch: DataFrame, period: int = RSI_PERIOD
) -> tuple[DataFrame, DataFrame] | None:
    """(recomputed gold rows, first touched day per symbol) after ``batch`` (its states, already in the log).

    Reads the batch's own days of the log, a partition filter; None for an empty batch.
    """
    spark = gold_prev.sparkSession
    touched = batch.select("symbol", "trade_date")
    days = [r.trade_date for r in touched.select("trade_date").distinct().collect()]  # calendar days of one batch
    if not days:
        return None
    log = state_log(spark, path).filter(F.col("trade_date").isin(days)).select(*STATE_COLS)
    redo = ohlcv(merge_states(log.join(touched, ["symbol", "trade_date"], "left_semi")))
    return recomputed_rows(gold_prev, redo, touched, period)
