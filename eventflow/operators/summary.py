"""Keyed aggregates (AGG-1 to AGG-6): one definition for bounded and streaming frames.

All of them combine on the map side, so what is shuffled is one row per key and task and
a key that holds a third of all rows costs its reducer no more than any other key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.functions.text import event_key


def parse_messages(messages: DataFrame) -> DataFrame:
    """Messages to their keys (PRJ-1); the constant 1 per event is ``count(*)`` (PRJ-2)."""
    return messages.select(event_key(F.col("value")).alias("event_type"))


def key_counts(events: DataFrame, keys: str | Sequence[str] = "event_type") -> DataFrame:
    """Events per key (AGG-1, PRJ-4); on a stream the count since its start."""
    return events.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias("event_count"))


def grouped_summary(
    events: DataFrame,
    keys: str | Sequence[str] = "event_type",
    value: str | Column = "value",
    time: str | Column | None = "timestamp",
    total_name: str = "total_value",
    max_name: str = "max_timestamp",
) -> DataFrame:
    """Sum, count and latest time per key (AGG-2); without ``time`` the narrow form (AGG-3)."""
    aggregates = [F.sum(value).alias(total_name), F.count(F.lit(1)).alias("event_count")]
    if time is not None:
        aggregates.append(F.max(time).alias(max_name))
    return events.groupBy(*_names(keys)).agg(*aggregates)


def handoff(counts: DataFrame) -> DataFrame:
    """Counts in the form of an event table: value = count, timestamp = 0 (PRJ-3)."""
    return counts.select(
        "event_type", F.col("event_count").alias("value"), F.lit(0).alias("timestamp")
    )


def global_total(counts: DataFrame) -> DataFrame:
    """Sum of all counts, 0 without rows (AGG-5)."""
    return counts.agg(F.coalesce(F.sum("event_count"), F.lit(0)).cast("bigint").alias("total"))


def row_count(df: DataFrame) -> DataFrame:
    """AGG-6."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)
