"""A landed topic log with offsets: a stream source with positions and loss detection, a sink with commits.

Log: envelope records landed in segments, ``root/segment=N/partition=P/*.parquet``,
and an index, ``root/index/segment=N``, with the offsets each file holds. Segments
may expire; ``root/expired/segment=N`` then keeps the last offsets that are gone.

Source ``topic_log`` (options ``path``, ``startingOffsets``: earliest, latest or
{"partition": next offset} as JSON; ``failOnDataLoss``; ``minPartitions``): positions
are the next offset of each partition and live in the query's checkpoint. If
offsets from the position on have expired, the query stops with
``failOnDataLoss``, and without it goes on at the first offset there is.

Sink ``message_log`` (option ``path``): tasks write files aside; the commit of an
epoch is one small manifest that names them, put in place by a rename. Messages
count once their epoch has its manifest, and an epoch run again keeps the first.

Both are defined inside functions: Spark ships them to its Python workers by
value, so these need pyarrow but not this package.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.schema import ENVELOPE
from candela.session import remove_path

INDEX = "file string, partition int, first_offset bigint, last_offset bigint, segment bigint"


def _segments(spark: SparkSession, root: str, kind: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{kind}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.removeprefix("segment=")) for n in names if n.startswith("segment="))


def append_segment(envelope: DataFrame, root: str) -> int:
    """Land records as the log's next segment; readers see it once its index stands."""
    spark = envelope.sparkSession
    done = _segments(spark, root, "index") + _segments(spark, root, "expired")
    n = max(done, default=-1) + 1
    data = f"{root}/segment={n}"
    envelope.withColumn("_p", F.col("partition")).hint("rebalance", "_p").write.mode("overwrite").partitionBy("_p").parquet(data)
    files = spark.read.schema(ENVELOPE).parquet(data).groupBy(F.input_file_name().alias("file"), "partition")
    index = files.agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{root}/index/segment={n}")
    return n


def expire_segments(spark: SparkSession, root: str, keep: int) -> None:
    """Drop all but the last ``keep`` segments, remembering up to which offset each partition lost records."""
    old = _segments(spark, root, "index")
    for n in old[: max(0, len(old) - keep)]:
        rows = spark.read.schema(INDEX).parquet(f"{root}/index/segment={n}")
        gone = rows.groupBy("partition").agg(F.max("last_offset").alias("last_offset"))
        gone.coalesce(1).write.mode("overwrite").parquet(f"{root}/expired/segment={n}")
        remove_path(spark, f"{root}/index/segment={n}")
        remove_path(spark, f"{root}/segment={n}")


def topic_log_source() -> type:
    from collections.abc import Iterator

    import pyarrow as pa
    import pyarrow.dataset as ds
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    columns = ["key", "value", "topic", "partition", "offset", "timestamp"]
    types = [pa.string(), pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.timestamp("us", "UTC")]

    class Range(InputPartition):
        def __init__(self, files: list[str], low: int, high: int) -> None:
            self.files, self.low, self.high = files, low, high

    class Reader(DataSourceStreamReader):
        def __init__(self, options: dict[str, str]) -> None:
            self.root = options["path"].rstrip("/")
            self.start = options.get("startingoffsets", "latest")
            self.strict = options.get("failondataloss", "false").lower() == "true"
            self.tasks = int(options.get("minpartitions", "0"))

        def table(self, kind: str) -> list[dict]:
            from pyarrow import fs as pafs

            fs, path = pafs.FileSystem.from_uri(f"{self.root}/{kind}") if "://" in self.root or self.root.startswith("file:") else (pafs.LocalFileSystem(), f"{self.root}/{kind}")
            if fs.get_file_info(path).type == pafs.FileType.NotFound:
                return []
            files = [f.path for f in fs.get_file_info(pafs.FileSelector(path, recursive=True)) if f.path.endswith(".parquet")]
            return ds.dataset(files, filesystem=fs, format="parquet").to_table().to_pylist() if files else []

        def latestOffset(self) -> dict:  # noqa: N802
            ends: dict[str, int] = {}
            for row in self.table("expired") + self.table("index"):
                p = str(row["partition"])
                ends[p] = max(ends.get(p, 0), row["last_offset"] + 1)
            return ends

        def initialOffset(self) -> dict:  # noqa: N802
            if self.start == "latest":
                return self.latestOffset()
            return {} if self.start == "earliest" else {str(p): int(o) for p, o in json.loads(self.start).items()}

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            index, explicit = self.table("index"), self.start not in ("earliest", "latest")
            lost = {}
            for row in self.table("expired"):
                p = str(row["partition"])
                # A query that began at the earliest record never asked for what had gone before.
                if row["last_offset"] >= start.get(p, 1 << 62 if not explicit else 0):
                    lost[p] = max(lost.get(p, -1), row["last_offset"])
            if lost and self.strict:
                raise RuntimeError(f"records have expired before they were read: partition -> last offset gone {lost}")
            out = []
            for p, high in sorted(end.items()):
                low = start.get(p, 0)
                own = sorted((r for r in index if str(r["partition"]) == p and r["last_offset"] >= low and r["first_offset"] < high), key=lambda r: r["first_offset"])
                if own:
                    out.append((low, high, own))
            split = max(1, -(-self.tasks // max(1, len(out))))
            ranges: list[InputPartition] = []
            for low, high, own in out:
                first, last = max(low, own[0]["first_offset"]), min(high, max(r["last_offset"] for r in own) + 1)
                width = max(1, -(-(last - first) // split))
                for at in range(first, last, width):
                    until = min(at + width, last)
                    files = [r["file"] for r in own if r["last_offset"] >= at and r["first_offset"] < until]
                    if files:
                        ranges.append(Range(files, at, until))
            return ranges

        def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
            from urllib.parse import unquote

            from pyarrow import fs as pafs

            offset = ds.field("offset")
            for file in partition.files:
                fs, path = pafs.FileSystem.from_uri(unquote(file))
                rows = ds.dataset(path, filesystem=fs, format="parquet").scanner(columns=columns, filter=(offset >= partition.low) & (offset < partition.high))
                for batch in rows.to_batches():
                    cast = [
                        batch.column(c).cast(pa.timestamp("us")).cast(t) if c == "timestamp" and batch.column(c).type.tz is None else batch.column(c).cast(t)
                        for c, t in zip(columns, types, strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(cast, columns)

        def commit(self, end: dict) -> None:
            pass

    class TopicLog(DataSource):
        @classmethod
        def name(cls) -> str:
            return "topic_log"

        def schema(self) -> str:
            return "key string, value binary, topic string, partition int, offset bigint, timestamp timestamp"

        def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
            return Reader({k.lower(): v for k, v in self.options.items()})

    return TopicLog


def topic_log(
    spark: SparkSession, root: str, starting_offsets: str = "latest", fail_on_data_loss: bool = False, min_partitions: int | None = None
) -> DataFrame:
    """The landed log as a stream of envelope records; arguments as those of ``kafka_source``."""
    spark.dataSource.register(topic_log_source())
    reader = spark.readStream.format("topic_log").option("path", root).option("startingOffsets", starting_offsets)
    return reader.option("failOnDataLoss", str(fail_on_data_loss).lower()).option("minPartitions", str(min_partitions or 0)).load()


def message_log_sink() -> type:
    from collections.abc import Iterator

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

    def located(path: str):
        from pyarrow import fs as pafs

        return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)

    class Written(WriterCommitMessage):
        def __init__(self, file: str, rows: int) -> None:
            self.file, self.rows = file, rows

    class Writer(DataSourceStreamWriter):
        def __init__(self, root: str) -> None:
            self.root = root

        def write(self, iterator: Iterator) -> WriterCommitMessage:
            import uuid

            name, total = f"data/{uuid.uuid4().hex}.parquet", 0
            fs, root = located(self.root)
            fs.create_dir(f"{root}/data")
            schema = pa.schema([("key", pa.string()), ("value", pa.string())])
            with fs.open_output_stream(f"{root}/{name}") as out, pq.ParquetWriter(out, schema) as writer:
                held: list[tuple] = []
                for row in iterator:
                    held.append((row["key"], row["value"]))
                    if len(held) >= 10_000:
                        writer.write_table(pa.table(list(map(list, zip(*held, strict=True))), schema=schema))
                        total, held = total + len(held), []
                if held:
                    writer.write_table(pa.table(list(map(list, zip(*held, strict=True))), schema=schema))
                    total += len(held)
            return Written(name, total)

        def remove(self, messages) -> None:
            fs, root = located(self.root)
            for m in messages:
                if m is not None:
                    fs.delete_file(f"{root}/{m.file}")

        def commit(self, messages, batchId: int) -> None:  # noqa: N803
            import uuid

            from pyarrow import fs as pafs

            fs, root = located(self.root)
            fs.create_dir(f"{root}/commits")
            manifest = f"{root}/commits/{batchId}.json"
            if fs.get_file_info(manifest).type != pafs.FileType.NotFound:
                self.remove(messages)  # the epoch was committed before the stream stopped
                return
            aside = f"{root}/commits/.{batchId}-{uuid.uuid4().hex}"
            with fs.open_output_stream(aside) as out:
                out.write(json.dumps([m.file for m in messages if m is not None and m.rows]).encode())
            fs.move(aside, manifest)
            self.remove([m for m in messages if m is not None and not m.rows])

        def abort(self, messages, batchId: int) -> None:  # noqa: N803
            self.remove(messages)

    class MessageLog(DataSource):
        @classmethod
        def name(cls) -> str:
            return "message_log"

        def schema(self) -> str:
            return "key string, value string"

        def streamWriter(self, schema, overwrite) -> DataSourceStreamWriter:  # noqa: N802
            return Writer(self.options["path"].rstrip("/"))

    return MessageLog


def start_message_log(messages: DataFrame, root: str, checkpoint: str, trigger: dict | None = None):
    """Keyed messages (key, value) into the log at ``root``, each epoch once.

    Data Source sinks append, so a window's message leaves when the watermark has
    closed it; ``start_stats_messages`` gives every change of a window.
    """
    messages.sparkSession.dataSource.register(message_log_sink())
    w = messages.select(F.col("key").cast("string"), F.col("value").cast("string")).writeStream.format("message_log").option("path", root)
    return w.option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"processingTime": "15 seconds"})).start()


def committed_messages(spark: SparkSession, root: str) -> DataFrame:
    """(key, value, batch_id) of the committed epochs."""
    # One manifest an epoch; the manifest is a JSON array of file names on one line.
    manifests = spark.read.text(f"{root}/commits/*.json").withColumn(
        "batch_id", F.regexp_extract(F.input_file_name(), r"([0-9]+)\.json$", 1).cast("bigint")
    )
    names = manifests.select("batch_id", F.explode(F.from_json("value", "array<string>")).alias("_name"))
    rows = spark.read.schema("key string, value string").parquet(f"{root}/data")
    rows = rows.withColumn("_name", F.concat(F.lit("data/"), F.element_at(F.split(F.input_file_name(), "/"), -1)))
    return rows.join(names, "_name").select("key", "value", "batch_id")
