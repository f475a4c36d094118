"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when the split costs one more shuffle after it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # no call-site capture per column expression: building a wide plan takes a fraction of the time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "meterdw", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the library is tested with; `extra` keys use __ for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def utc_session(spark: SparkSession) -> SparkSession:
    """A sibling session pinned to UTC, for event-time streams.

    Sources carry zone-less timestamps, watermarks need zoned ones. The cast between
    the two is only the identity when the session zone is UTC, and the caller's own
    session must not be changed for it.
    """
    sibling = spark.newSession()
    wanted = {key: value for key, value in spark.conf.getAll.items() if key.startswith("spark.sql.")}
    wanted |= {key: SETTINGS[key] for key in ("spark.sql.session.timeZone",
                                              "spark.sql.streaming.stateStore.providerClass")}
    known = sibling.conf.getAll
    for key, value in wanted.items():
        if known.get(key) != value and sibling.conf.isModifiable(key):
            sibling.conf.set(key, value)
    return sibling


@cache
def _own_folder() -> str:
    """One temporary folder per process, removed at its end."""
    folder = tempfile.mkdtemp(prefix="meterdw-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder of this machine: on a
    cluster the executors could not see it.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
