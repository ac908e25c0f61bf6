"""Deterministic test events (SRC-8 to SRC-10) as expressions over an index column.

Each value depends on its index alone, so any partitioning, retry or row order gives the
same events, and the index may come from ``spark.range`` or from a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.text import message

# Number of event types, prefix of their names, first timestamp.
EVENT_TYPES = 5
PREFIX = "event_type_"
FIRST_TIMESTAMP = 1_700_000_000


def indices(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").alias("i"))


def round_robin_type(i: Column, types: int = EVENT_TYPES) -> Column:
    return F.concat(F.lit(PREFIX), (i % types).cast("string"))


def seeded_value(i: Column, seed: int, low: int, high: int) -> Column:
    """A value of ``low`` to ``high`` drawn from a digest of seed and index."""
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), i.cast("string"))), 1, 8), 16, 10)
    return (draw.cast("bigint") % (high - low + 1) + low).cast("int")


def messages(index: DataFrame, types: int = EVENT_TYPES) -> DataFrame:
    """SRC-8: ``event_type_<i mod types>:<i>``."""
    i = F.col("i")
    return index.select(message(round_robin_type(i, types), i).alias("value"))


def event_table(
    index: DataFrame, seed: int, low: int, high: int, types: int = EVENT_TYPES
) -> DataFrame:
    """SRC-9: round-robin types, seeded values, one second per event."""
    i = F.col("i")
    return index.select(
        round_robin_type(i, types).alias("event_type"),
        seeded_value(i, seed, low, high).alias("value"),
        (i + FIRST_TIMESTAMP).alias("timestamp"),
    )


def constant_table(index: DataFrame, types: int = EVENT_TYPES) -> DataFrame:
    """SRC-10: the narrow table, every value 1."""
    return index.select(round_robin_type(F.col("i"), types).alias("event_type"), F.lit(1).alias("value"))


def expected_counts(total: DataFrame, types: int = EVENT_TYPES) -> DataFrame:
    """AGG-7: closed form of the counts of ``n`` round-robin events, ``n`` in one row.

    The first ``n mod types`` types get one event more.
    """
    i, n = F.col("i"), F.col("n")
    each = total.select("n", F.explode(F.sequence(F.lit(0), F.lit(types - 1))).alias("i"))
    count = F.call_function("div", n, F.lit(types)) + F.when(i < n % types, 1).otherwise(0)
    return each.select(
        round_robin_type(i, types).alias("event_type"), count.cast("bigint").alias("event_count")
    )
