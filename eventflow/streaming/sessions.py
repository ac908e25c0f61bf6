"""Running counts whose state can end (STR-1).

A count since the start of a stream keeps every key for ever. Here a key that has been idle for
a given time has ended: its count is written once and leaves the state, and events that come
later begin a new one. The engine's own session windows do that, so no Python code runs per key,
and what many tasks see of a hot key is merged in each of them before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventflow import files
from eventflow.session import setting
from eventflow.streaming.counter import ConfigurationMissing

LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def session_counts(events: DataFrame, keys: Sequence[str], time: str, idle: str) -> DataFrame:
    """Events of each key from its first one until it is idle: keys, ``started``, ``last_seen``, ``event_count``.

    One definition for bounded and streaming frames. A key is idle if the next event comes later
    than ``idle`` after the one before; ``time`` is a timestamp, and rows without one are left out.
    """
    counted = events.groupBy(*keys, F.session_window(time, idle).alias("_session")).agg(
        F.min(time).alias("started"), F.max(time).alias("last_seen"), F.count(F.lit(1)).alias("event_count")
    )
    return counted.select(*keys, "started", "last_seen", "event_count")


def start_session_counter(
    events: DataFrame,
    *,
    out: str | None,
    checkpoint: str | None,
    keys: Sequence[str],
    time: str,
    idle: str,
    late: str = "0 seconds",
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Write the counts of keys that have ended, each once.

    A key has ended once the latest event of the stream is more than ``idle`` and ``late``
    beyond its last one; an event later than ``late`` behind the latest one may be dropped.
    Each micro-batch overwrites a folder of its own, so a batch that runs again changes nothing.
    """
    missing = [name for name, value in (("checkpoint", checkpoint), ("out", out)) if not value]
    if missing:
        raise ConfigurationMissing(missing)
    spark, root = events.sparkSession, f"{out.rstrip('/')}/sessions"
    if not files.exists(spark, f"{checkpoint.rstrip('/')}/metadata") and files.children(spark, root):
        raise ValueError(f"{out} holds results of another run; a new run takes new folders")
    counts = session_counts(events.withWatermark(time, late), keys, time, idle)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    writer = counts.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    with setting(spark, LOCAL_MERGE, "true"):
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_ended(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The counts of keys that have ended; a folder without its success marker was interrupted."""
    root = f"{out.rstrip('/')}/sessions"
    done = [n for n in files.children(spark, root) if files.exists(spark, f"{root}/{n}/_SUCCESS")]
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{n}" for n in done])


def read_open(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """The counts of keys that have not ended, from the state as of the last finished batch."""
    state = spark.read.format("statestore").load(checkpoint)
    key, value = (state.schema[side].dataType.fieldNames() for side in ("key", "value"))
    # The state's values are the keys, the session, and the three aggregates in their order.
    aggregates = [n for n in value if n not in key][-3:]
    kinds: list[Column] = [F.col("value")[n].alias(to) for n, to in zip(aggregates, ("started", "last_seen", "event_count"))]
    return state.select(*[F.col("key")[n].alias(k) for n, k in zip(key, keys)], *kinds)
