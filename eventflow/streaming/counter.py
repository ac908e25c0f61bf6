"""Exactly-once running counts (AGG-1, STR-1 to STR-7)."""

from __future__ import annotations

import time
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventflow import files
from eventflow.operators.running import running_counts
from eventflow.operators.summary import key_counts
from eventflow.sinks.snapshots import SnapshotStore

REQUIRED_OPTIONS = {
    "checkpoint": "a folder for offsets and state, shared by all executors",
    "out": "a folder for the results, shared by all executors",
}


class ConfigurationMissing(ValueError):
    """A stream was started without an option it needs; ``record`` is the error record."""

    def __init__(self, missing: Sequence[str]) -> None:
        self.record: dict[str, Any] = {
            "error": "configuration_missing",
            "missing": {name: REQUIRED_OPTIONS[name] for name in missing},
        }
        super().__init__(f"missing options: {', '.join(missing)}")


def start_counter(
    events: DataFrame,
    *,
    out: str | None,
    checkpoint: str | None,
    keys: Sequence[str] = ("event_type",),
    mode: str = "update",
    trigger: dict[str, Any] | None = None,
    compact_every: int = 50,
) -> StreamingQuery:
    """Count a stream of keys into a ``SnapshotStore``.

    ``mode="update"`` writes the keys that a batch changed, ``"complete"`` rewrites all keys
    per batch. Offsets and counts survive in the checkpoint: the same checkpoint
    and output continue a run, a new run takes new folders. The default trigger works off
    what is there and stops.
    """
    store = _open(events, out, checkpoint, keys)
    if mode not in ("complete", "update"):
        raise ValueError("mode is 'complete' or 'update'")

    def write(batch: DataFrame, batch_id: int) -> None:
        if mode == "complete":
            store.write_full(batch, batch_id)
        else:
            store.write_delta(batch, batch_id, compact_every)

    counts = key_counts(events, list(keys))
    return _start(counts.writeStream.outputMode(mode).foreachBatch(write), checkpoint, trigger)


def start_changelog(
    events: DataFrame,
    *,
    out: str | None,
    checkpoint: str | None,
    sequence: str,
    keys: Sequence[str] = ("event_type",),
    unique: bool = False,
    trigger: dict[str, Any] | None = None,
    compact_every: int = 50,
) -> StreamingQuery:
    """Write one row per event with the running count of its key (STR-5).

    Batches count in the order of their arrival, the events of a batch by their number.
    A stateful function per key would send all events of a hot key through one task. Here
    every batch is counted with the block-wise batch operator, starting from the counts the
    batches before it left behind; both outputs of a batch are overwritten if it runs again.
    """
    store = _open(events, out, checkpoint, keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Read several times; a batch that runs again overwrites it.
        held = f"{out.rstrip('/')}/batch"
        batch.select(*keys, sequence).write.mode("overwrite").parquet(held)
        rows = batch.sparkSession.read.schema(batch.select(*keys, sequence).schema).parquet(held)
        try:
            total = key_counts(rows, list(keys))
            base = None
            if not store.is_empty():
                same = [F.col(f"e.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
                earlier = store.read(before=batch_id).alias("e")
                base = earlier.join(total.alias("n"), same, "left_semi").select(*keys, "event_count")
                total = total.unionByName(base).groupBy(*keys).agg(F.sum("event_count").alias("event_count"))
            log = running_counts(rows, keys, sequence, base, unique)
            log.write.mode("overwrite").parquet(f"{changelog_path(out)}/batch_id={batch_id}")
            store.write_delta(total, batch_id, compact_every)
        finally:
            files.remove(batch.sparkSession, held)

    return _start(events.writeStream.foreachBatch(write), checkpoint, trigger)


def changelog_path(out: str) -> str:
    return f"{out.rstrip('/')}/changelog"


def read_changelog(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The changelog's finished batches: a folder without its success marker was interrupted."""
    root = changelog_path(out)
    done = [n for n in files.children(spark, root) if files.exists(spark, f"{root}/{n}/_SUCCESS")]
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{n}" for n in done])


def run_to_end(query: StreamingQuery, timeout: float) -> None:
    """Wait for a query that ends by itself; stop it and raise if it takes too long."""
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout} s")


def wait_for_total(store: SnapshotStore, n: int, timeout: float, poll: float = 1.0, keys: int = 0) -> bool:
    """Whether the counts of a running stream reach ``n`` events, of ``keys`` keys at least, in time (STR-6)."""
    deadline = time.monotonic() + timeout
    while True:
        with store.pinned() as counts:
            found = counts.agg(F.sum("event_count").alias("total"), F.count(F.lit(1)).alias("keys")).first()
        if (found.total or 0) >= n and found["keys"] >= keys:
            return True
        if time.monotonic() >= deadline:
            return False
        time.sleep(poll)


def _open(events: DataFrame, out: str | None, checkpoint: str | None, keys: Sequence[str]) -> SnapshotStore:
    """Refuse to start without the needed folders (STR-3) or into another run's output."""
    missing = [name for name, value in (("checkpoint", checkpoint), ("out", out)) if not value]
    if missing:
        raise ConfigurationMissing(missing)
    fields = key_counts(events, list(keys)).schema
    store = SnapshotStore(events.sparkSession, f"{out.rstrip('/')}/counts", fields)
    if not files.exists(events.sparkSession, f"{checkpoint.rstrip('/')}/metadata") and not store.is_empty():
        raise ValueError(f"{out} holds results of another run; a new run takes new folders")
    return store


def _start(writer, checkpoint: str, trigger: dict[str, Any] | None) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
