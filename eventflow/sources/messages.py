"""Message streams (SRC-1 to SRC-3): text folders, message brokers and event tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.functions.text import message
from eventflow.sources import landing


def read_messages(
    spark: SparkSession,
    path: str | None = None,
    *,
    format: str = "text",
    streaming: bool = True,
    start: str = "earliest",
    since: datetime | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages as one string column ``value``.

    ``format="kafka"`` needs Spark's kafka package and the broker and topic in ``options``;
    ``start`` is then the position of a run without a checkpoint. ``format="text"`` reads a
    landing folder: with ``start="latest"`` only files written at or after ``since`` count.
    ``since`` is an argument, not the clock, so that a restart keeps the first run's start.
    ``format="landing"`` reads a folder whose files have rising names, as a stream; ``start`` is
    then a position too (``eventflow.sources.landing``), and a micro-batch is all there is.
    ``max_files`` and ``max_bytes`` bound one micro-batch while a backlog is worked off.
    """
    reader = spark.readStream if streaming else spark.read
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if format == "kafka":
        position = "startingOffsets"
        if streaming and (max_files or max_bytes):
            raise ValueError("a topic's micro-batches are bounded by its options maxOffsetsPerTrigger or maxBytesPerTrigger")
        return reader.format("kafka").option(position, start).load().select(F.col("value").cast("string"))
    if format == landing.FORMAT:
        if not streaming or max_files or max_bytes:
            raise ValueError("a landing log is read as a stream, and its micro-batches are not bounded")
        spark.dataSource.register(landing.Landing)
        return reader.format(format).option("start", start).load(path)
    if format != "text":
        raise ValueError(f"unknown message format: {format}")
    if start not in ("earliest", "latest"):
        raise ValueError("a text source starts at 'earliest' or 'latest'")
    if start == "latest" and since is None:
        raise ValueError("start='latest' on a text source needs 'since'")
    if streaming:
        reader = _bounded(reader, max_files, max_bytes)
    lines = reader.text(path)
    if start == "latest":
        lines = lines.filter(F.col("_metadata.file_modification_time") >= F.lit(since))
    return lines.select("value")


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """A parquet table as a stream, whether ``path`` is one file or a folder of files.

    The last character is written as a pattern: a stream over a plain path must be a
    folder, one over a pattern need not.
    """
    reader = _bounded(spark.readStream.schema(schema), max_files, max_bytes)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def as_messages(events: DataFrame, key: str = "event_type", sequence: str = "event_id") -> DataFrame:
    """An event table in message form."""
    return events.select(message(F.col(key), F.col(sequence)).alias("value"))


def _bounded(reader, max_files: int | None, max_bytes: int | None):
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader
