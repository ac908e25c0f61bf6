"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app: str = "eventflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the defaults the library is designed for.

    The shuffle partition count is left to the cluster unless given: batch plans are
    coalesced by adaptive execution, a stream pins the value in its first checkpoint.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session that holds inside only."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session that names none gets one made; on a cluster a folder of the
    driver's machine would hold a part of each result only, so that is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not base and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="eventflow-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A path of its own for one run: a new run is a new folder, a restart reuses the old path (STR-7)."""
    return f"{shared_folder(spark).rstrip('/')}/eventflow/{purpose}-{uuid.uuid4().hex}"
