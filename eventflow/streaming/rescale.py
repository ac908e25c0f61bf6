"""Going on with a running count in another run (STR-8).

A stream keeps the number of state partitions of its first checkpoint. To change it, a new run
takes over: what the old one has counted is read from its state as a table, and the new one
starts at the position at which the old one's last finished batch ended. Both come from the
same checkpoint, so no message is counted twice or left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventflow.session import setting
from eventflow.sinks.snapshots import SnapshotStore
from eventflow.sources.landing import last_position
from eventflow.streaming.counter import start_counter


def read_state(spark: SparkSession, checkpoint: str, keys: Sequence[str] = ("event_type",)) -> DataFrame:
    """Keys and ``event_count`` as of a count's last finished batch, from its state; no stream has to run."""
    state = spark.read.format("statestore").load(checkpoint)
    stored = state.schema["key"].dataType.fieldNames()
    if len(stored) != len(keys):
        raise ValueError(f"the state has the keys {stored}, not {list(keys)}")
    count = state.schema["value"].dataType.fieldNames()[0]
    named = [F.col("key")[name].alias(key) for name, key in zip(stored, keys)]
    return state.select(*named, F.col("value")[count].cast("bigint").alias("event_count"))


def state_partitions(spark: SparkSession, checkpoint: str) -> int:
    """Partitions of a stream's state, as its checkpoint tells."""
    rows = spark.read.format("state-metadata").load(checkpoint)
    return rows.agg(F.max("numPartitions")).first()[0]


def rescale_counter(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    partitions: int,
    *,
    old_out: str,
    old_checkpoint: str,
    out: str,
    checkpoint: str,
    keys: Sequence[str] = ("event_type",),
    mode: str = "update",
    trigger: dict[str, Any] | None = None,
    compact_every: int = 50,
) -> StreamingQuery:
    """Start a count of ``partitions`` state partitions that goes on where a stopped one has ended.

    ``read`` gives the events as a stream from the position it is called with; the source must
    be one with JSON offsets, as landing logs and brokers are. The old run must have stopped;
    its folders are only read. The new run has folders of its own and is restarted by the same
    call. Runs can follow each other any number of times.
    """
    position = last_position(spark, old_checkpoint)
    if position is None:
        raise ValueError(f"{old_checkpoint} has no finished batch to go on from")
    state = read_state(spark, old_checkpoint, keys)
    old = SnapshotStore(spark, f"{old_out.rstrip('/')}/counts", state.schema)
    before = old.base()
    if before is not None:
        state = state.unionByName(before).groupBy(*keys).agg(F.sum("event_count").alias("event_count"))
    SnapshotStore(spark, f"{out.rstrip('/')}/counts", state.schema).write_base(state)
    # A stream takes its settings when it is started.
    with setting(spark, "spark.sql.shuffle.partitions", str(partitions)):
        return start_counter(
            read(position), out=out, checkpoint=checkpoint, keys=keys, mode=mode, trigger=trigger, compact_every=compact_every
        )
