"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. The session time zone is part of the semantics:
# trade_date = to_date(event_time) is only well defined when the zone is pinned.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    # Symbols are text: a folder named symbol=0700 must not become the number 700.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Checkpoint files go once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "candela",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC; trade dates and window bounds depend on it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries started inside the block; what was set before comes back."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for materialised intermediates.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set on a local master — local runs and tests — a private
    folder is created and registered as the checkpoint dir, so later
    ``checkpoint()`` calls agree; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - Spark Connect has no context
            base = None
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by the cluster (intermediates and checkpoints go there)"
            )
        base = tempfile.mkdtemp(prefix="candela-")
        try:
            spark.sparkContext.setCheckpointDir(base)
        except Exception:  # pragma: no cover
            pass
    return base.rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the job's own (staging, an emptied partition) through Hadoop's file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder."""
    base = shared_dir(spark)
    return f"{base}/candela/{name}-{uuid.uuid4().hex[:12]}"
