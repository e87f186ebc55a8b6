"""Session factory (no package downloads, UTC, RocksDB state store)."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Spark's default, which cannot hold the several states of a ``transformWithState`` processor.
HDFS_BACKED = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"

# Defaults chosen for a large cluster; every key can be overridden.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    STATE_STORE: ROCKSDB,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app_name: str = "playback-qos", master: str | None = None, **conf) -> SparkSession:
    """Return the active session, or build one.

    ``conf`` keys use underscores for dots, e.g. ``spark_sql_shuffle_partitions=8``,
    or pass full keys through ``conf={"spark.x": "y"}``.
    """
    builder = SparkSession.builder.appName(app_name)
    master = master or os.environ.get("PLAYBACK_QOS_MASTER")
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    settings.update(conf.pop("conf", {}) or {})
    settings.update({k.replace("_", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A fallback is only set when the session has none (local tests).
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    spark.sparkContext.setCheckpointDir(fallback)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share.

    Only a local session may do without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = checkpoint_dir(spark, tempfile.mkdtemp(prefix="playback-qos-"))
    return f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex}"


_starting = threading.RLock()


@contextmanager
def multi_state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside get RocksDB where the session has the default store; the session's setting stays.

    A query keeps the settings of its start, and its checkpoint the store it was
    made with. A session that names a store of its own keeps it.
    """
    with _starting:
        was = spark.conf.get(STATE_STORE, None)
        if was not in (None, HDFS_BACKED):
            yield
            return
        spark.conf.set(STATE_STORE, ROCKSDB)
        try:
            yield
        finally:
            if was is None:
                spark.conf.unset(STATE_STORE)
            else:
                spark.conf.set(STATE_STORE, was)
