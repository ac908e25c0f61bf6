"""Result files, message and hand-off writers (SNK-2 to SNK-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventflow import files
from eventflow.operators.summary import handoff


def publish_csv(result: DataFrame, path: str, order_by: str = "event_type", single_file: bool = False) -> int:
    """Write an ordered CSV with a header to ``path``; returns the number of rows (SNK-2).

    The result is computed once, into a staging table that also counts its rows. It becomes
    a folder whose part files, taken in name order, hold the rows in order; with
    ``single_file``, which one task writes, a file.
    """
    spark = result.sparkSession
    staging = f"{path.rstrip('/')}_staging"
    counted = Observation()
    result.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(staging)
    ordered = spark.read.schema(result.schema).parquet(staging).orderBy(order_by)
    parts = f"{path.rstrip('/')}_parts"
    ordered = ordered.coalesce(1) if single_file else ordered
    ordered.write.mode("overwrite").option("header", True).csv(parts)
    if single_file:
        written = [name for name in files.children(spark, parts) if name.startswith("part-")]
        if len(written) != 1:
            raise OSError(f"expected one part file in {parts}, found {written}")
        files.move(spark, f"{parts}/{written[0]}", path)
        files.remove(spark, parts)
    else:
        files.move(spark, parts, path)
    files.remove(spark, staging)
    return counted.get["rows"]


def write_messages(messages: DataFrame, path: str | None = None, *, format: str = "text", options: dict[str, str] | None = None) -> None:
    """Append messages to a landing folder or a topic (SNK-4). Any failure raises."""
    if format == "text":
        messages.select("value").write.mode("append").text(path)
    elif format == "kafka":
        messages.select("value").write.format("kafka").options(**(options or {})).save()
    else:
        raise ValueError(f"unknown message format: {format}")


def write_segment(messages: DataFrame, path: str, number: int) -> list[str]:
    """Messages as the next files of a landing log, whose names rise with ``number``; returns the names.

    They are written beside the log and put in place by renaming, so a reader sees whole files.
    A segment that is written again replaces nothing: the number must be new.
    """
    spark, prefix = messages.sparkSession, f"{number:012d}-"
    if any(name.startswith(prefix) for name in files.children(spark, path)):
        raise ValueError(f"{path} has a segment {number}")
    staging = f"{path.rstrip('/')}_staging/{number:012d}"
    messages.select("value").write.mode("overwrite").text(staging)
    names = []
    for part in files.children(spark, staging):
        if part.startswith("part-"):
            names.append(prefix + part)
            files.move(spark, f"{staging}/{part}", f"{path.rstrip('/')}/{names[-1]}")
    files.remove(spark, staging)
    return names


def write_handoff(counts: DataFrame, path: str, format: str = "csv") -> None:
    """Counts re-shaped for the batch stage (SNK-5)."""
    handoff(counts).write.mode("overwrite").option("header", True).format(format).save(path)


def show_stream(counts: DataFrame, checkpoint: str, output_mode: str = "complete"):
    """Console sink (SNK-3)."""
    writer = counts.writeStream.format("console").outputMode(output_mode)
    return writer.option("checkpointLocation", checkpoint).start()
