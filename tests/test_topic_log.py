"""Offsets of the landed topic log and commits of the message log."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from candela.operators.window_stats import stats_json, window_stats
from candela.plans.catalog import ticks
from candela.session import scratch_path
from candela.sources import fixtures as fx
from candela.streaming import queries as P
from candela.streaming import topic_log as T
from candela.streaming.replay import chunks
from candela.streaming.sources import file_source

SF = "/root/testdata/sf0.001"
BOUNDED = {"availableNow": True}


@pytest.fixture(scope="module")
def parts(spark):
    return [c.checkpoint() for c in chunks(fx.envelope_from_ticks(ticks(spark, SF)))]


def drain(stream, out, checkpoint):
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(**BOUNDED).start()
    q.awaitTermination()
    assert q.exception() is None


def offsets(df):
    return sorted((r["partition"], r["offset"], bytes(r["value"]), r["timestamp"]) for r in df.select("partition", "offset", "value", "timestamp").collect())


def test_positions_survive_restarts(spark, parts):
    root, out, ck = (scratch_path(spark, n) for n in ("topic", "out", "ck"))
    for part in parts:
        T.append_segment(part, root)
        drain(T.topic_log(spark, root, "earliest", True, 7), out, ck)
    want = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    assert offsets(spark.read.parquet(out)) == offsets(want)


def test_starting_offsets(spark, parts):
    root = scratch_path(spark, "topic")
    T.append_segment(parts[0], root)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "ck")
    drain(T.topic_log(spark, root, "latest"), out, ck)
    T.append_segment(parts[1], root)
    drain(T.topic_log(spark, root, "latest"), out, ck)
    assert offsets(spark.read.parquet(out)) == offsets(parts[1])
    out = scratch_path(spark, "out")
    middle = {r["partition"]: r["o"] for r in parts[0].groupBy("partition").agg(F.percentile_approx("offset", 0.5).alias("o")).collect()}
    start = "{" + ", ".join(f'"{p}": {o}' for p, o in middle.items()) + "}"
    drain(T.topic_log(spark, root, start), out, scratch_path(spark, "ck"))
    got = spark.read.parquet(out).groupBy("partition").agg(F.min("offset").alias("o")).collect()
    assert {r["partition"]: r["o"] for r in got} == middle


def test_expired_offsets_stop_or_pass(spark, parts):
    root, ck, out = (scratch_path(spark, n) for n in ("topic", "ck", "out"))
    T.append_segment(parts[0], root)
    drain(T.topic_log(spark, root, "earliest"), out, ck)
    for part in parts[1:]:
        T.append_segment(part, root)
    T.expire_segments(spark, root, keep=1)  # two segments go before they are read
    with pytest.raises(StreamingQueryException, match="expired"):
        drain(T.topic_log(spark, root, "earliest", True), out, ck)
    drain(T.topic_log(spark, root, "earliest", False), out, ck)
    assert offsets(spark.read.parquet(out)) == offsets(parts[0].unionByName(parts[3]))
    # A new query that begins at the earliest record has lost nothing.
    fresh = scratch_path(spark, "out")
    drain(T.topic_log(spark, root, "earliest", True), fresh, scratch_path(spark, "ck"))
    assert offsets(spark.read.parquet(fresh)) == offsets(parts[3])


def test_an_epoch_commits_once(spark, parts):
    landing, root, ck = (scratch_path(spark, n) for n in ("landing", "messages", "ck"))
    for part in parts[:2]:
        part.write.mode("append").parquet(landing)
        q = T.start_message_log(stats_json(window_stats(P.clean_ticks(file_source(spark, landing)))), root, ck, BOUNDED)
        q.awaitTermination()
        assert q.exception() is None
    before = sorted(map(tuple, T.committed_messages(spark, root).collect()))
    assert len(before) > 100
    # The same epochs again, as after a stop between the sink's commit and the checkpoint's.
    q = T.start_message_log(stats_json(window_stats(P.clean_ticks(file_source(spark, landing)))), root, scratch_path(spark, "ck"), BOUNDED)
    q.awaitTermination()
    assert sorted(map(tuple, T.committed_messages(spark, root).collect())) == before
