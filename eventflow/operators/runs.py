"""Roll-up and metrics of run records (AGG-9, MET-2 to MET-5, MET-7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.functions.numbers import latency_ratio, per_second, speedup


def roll_up(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Passed runs, all runs, and the time of failed runs as the penalty; a null is a failure."""
    passed = F.coalesce("passed", F.lit(False))
    elapsed = F.coalesce("elapsed_ms", F.lit(0))
    return runs.groupBy(*by).agg(
        F.count_if(passed).alias("scenarios_passed"),
        F.count(F.lit(1)).alias("scenarios_total"),
        F.coalesce(F.sum(F.when(~passed, elapsed)), F.lit(0)).cast("bigint").alias("penalty_ms"),
        F.coalesce(F.sum(elapsed), F.lit(0)).cast("bigint").alias("total_elapsed_ms"),
    )


def add_metrics(runs: DataFrame) -> DataFrame:
    """Throughput, latency ratio and speed-up of each run from its measured times."""
    c = F.col
    return runs.withColumns({
        "events_per_second": per_second(c("rows_processed"), c("elapsed_ms"), 1),
        "rows_per_second": per_second(c("rows_processed"), c("job_time_ms"), 0).cast("bigint"),
        "latency_ratio": latency_ratio(c("job_time_ms"), c("latency_ms")),
        "speedup_factor": speedup(c("baseline_time_ms"), c("job_time_ms")),
    })


def summary_lines(runs: DataFrame) -> DataFrame:
    """The summary document as lines in the order ``section``, ``id``, ``place`` (SNK-7).

    One line per run: a document of any number of runs is written by many tasks and is
    never held as one value. Every line but the first run's begins with a comma. Ids may
    repeat, which rule 8 reports; equal records of one id are numbered by ``place``.
    """
    c = F.col
    opening = F.concat(
        F.lit('{"scenarios_passed":'), c("scenarios_passed").cast("string"),
        F.lit(',"scenarios_total":'), c("scenarios_total").cast("string"),
        F.lit(',"penalty_ms":'), c("penalty_ms").cast("string"),
        F.lit(',"total_elapsed_ms":'), c("total_elapsed_ms").cast("string"),
        F.lit(',"scenarios":['),
    )
    ends = F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit("").alias("id"), F.lit(0).cast("bigint").alias("place"), text.alias("line"))
        for section, text in ((0, opening), (2, F.lit("]}")))
    ])
    frame = roll_up(runs).select(F.inline(ends))
    key = F.struct("id", "record_json")
    # Equal records are one row with a count, written out again by number.
    counted = runs.groupBy("id", "record_json").agg(F.count(F.lit(1)).alias("times"))
    first = runs.agg(F.min(key).alias("first")).scalar()
    placed = counted.select(
        "id", "record_json", (key == first).alias("is_first"), F.explode(F.sequence(F.lit(1), c("times"))).alias("place")
    )
    comma = F.when(c("is_first") & (c("place") == 1), F.lit("")).otherwise(F.lit(","))
    body = placed.select(F.lit(1).alias("section"), "id", c("place").cast("bigint"), F.concat(comma, c("record_json")).alias("line"))
    return frame.unionByName(body)
