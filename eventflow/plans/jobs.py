"""The user-facing jobs (JOB-1 to JOB-6). Each returns its run record."""

from __future__ import annotations

import statistics
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventflow import schemas
from eventflow.functions.numbers import latency_ratio, per_second, speedup
from eventflow.functions.text import escaped_line, render_line
from eventflow.operators.filters import select_runs
from eventflow.operators.runs import roll_up
from eventflow.operators.summary import grouped_summary, handoff, parse_messages
from eventflow.operators.validate import first_violations
from eventflow.operators.verify import canonical_digest, key_diff, multiset_digest
from eventflow.plans.measured import Shuffles, measured, shuffle_partitions
from eventflow.sinks.records import write_run, write_summary
from eventflow.sinks.snapshots import SnapshotStore, write_snapshot_text
from eventflow.sinks.tables import publish_csv, write_handoff, write_messages
from eventflow.sources import generators
from eventflow.sources.delimited import bad_rows, good_rows, read_event_csv
from eventflow.sources.messages import read_messages
from eventflow.sources.records import read_run_records
from eventflow.streaming.counter import run_to_end, start_counter

# Ids and names of the five runs, the largest partition count that passes and
# the baseline it is compared with.
RUNS = {"01": "flink-basic", "02": "spark-batch", "03": "stream-vs-batch", "04": "spark-shuffle", "05": "pipeline"}
MOST_PARTITIONS = 8
CANONICAL, MULTISET = "canonical", "multiset"
BASELINE_PARTITIONS = 200


def stream_counts(
    spark: SparkSession,
    messages: DataFrame,
    out: str,
    checkpoint: str,
    expected: DataFrame | None = None,
    injected: int | None = None,
    mode: str = "update",
    timeout: float = 120.0,
    digest: str = MULTISET,
) -> dict[str, Any]:
    """JOB-1: count a message stream, publish the snapshot, and check it.

    It passes if the counts are those of ``expected`` and add up to ``injected``, the number
    of messages as told by something else than the stream. One of both has to be given.
    """
    if expected is None and injected is None:
        raise ValueError("give expected counts or the number of messages: a result is not checked by itself")
    clock = _Clock()
    run_to_end(start_counter(parse_messages(messages), out=out, checkpoint=checkpoint, mode=mode), timeout)
    latency = clock.ms()
    counts = SnapshotStore(spark, f"{out}/counts").read()
    write_snapshot_text(counts, f"{out}/counts.txt")
    total = counts.agg(F.coalesce(F.sum("event_count"), F.lit(0))).first()[0]
    found, wanted = result_digest(counts, digest), result_digest(expected, digest)
    passed = (expected is None or found == wanted) and (injected is None or total == injected)
    return _record(
        "01", passed, clock,
        events_injected=total if injected is None else injected, events_counted=total, processing_latency_ms=latency,
        events_per_second=_value(spark, per_second(F.lit(total), F.lit(latency), 1)),
        digest=digest, output_sha256=found, expected_sha256=wanted,
    )


def batch_summary(
    spark: SparkSession,
    path: str,
    out: str,
    expected: DataFrame | None = None,
    single_file: bool = False,
    timeout: float = 120.0,
    digest: str = MULTISET,
) -> dict[str, Any]:
    """JOB-2: summarise an event CSV into an ordered CSV; malformed rows go to ``<out>_quarantine``.

    A missing input raises at analysis. It passes if the rows summarised and the rows in
    quarantine, both counted in what was written, are the rows read, and the summary is
    ``expected`` if that is given.
    """
    clock = _Clock()
    seen = Observation()
    quarantine = f"{out.rstrip('/')}_quarantine"
    with _limit(spark, timeout), measured(spark) as moved:
        typed = read_event_csv(spark, path)
        observed = typed.observe(seen, F.count(F.lit(1)).alias("rows"))
        publish_csv(grouped_summary(good_rows(observed)), out, single_file=single_file)
        job_ms, rows = clock.ms(), seen.get["rows"]
        bad_rows(typed).write.mode("overwrite").json(quarantine)
    summary = spark.read.schema(schemas.SUMMARY).option("header", True).csv(out)
    good = summary.agg(F.coalesce(F.sum("event_count"), F.lit(0))).first()[0]
    rejected = spark.read.text(quarantine).count()
    found, wanted = result_digest(summary, digest, ","), result_digest(expected, digest, ",")
    return _record(
        "02", good + rejected == rows and (expected is None or found == wanted), clock,
        rows_read=rows, rows_processed=good, rows_rejected=rejected,
        rows_per_second=int(_value(spark, per_second(F.lit(rows), F.lit(job_ms), 0))),
        shuffle_partitions_used=moved.configured, shuffle_partitions_run=moved.used, shuffle_bytes=moved.written_bytes,
        job_time_ms=job_ms, digest=digest, output_sha256=found, expected_sha256=wanted,
    )


def compare_stream_batch(
    spark: SparkSession,
    landing: str | None,
    work: str,
    timeout: float = 120.0,
    digest: str = MULTISET,
    expected: DataFrame | None = None,
    source: dict[str, Any] | None = None,
    **bounds: int | None,
) -> dict[str, Any]:
    """JOB-3: the same messages as a stream and as a batch; passes if every key agrees (VER-7).

    The counts also have to be those of ``expected`` if that is given. ``source`` holds what
    ``read_messages`` takes besides the folder: the format, its options, where to start.
    ``max_files`` and ``max_bytes`` bound a micro-batch.
    """
    clock = _Clock()
    source = source or {}
    messages = read_messages(spark, landing, **source, **bounds)
    run_to_end(
        start_counter(parse_messages(messages), out=f"{work}/stream", checkpoint=f"{work}/checkpoint"), timeout
    )
    stream_ms = clock.ms()
    counts = SnapshotStore(spark, f"{work}/stream/counts").read()

    batch_clock = _Clock()
    seen = Observation()
    bounded = parse_messages(read_messages(spark, landing, streaming=False, **source)).withColumn("value", F.lit(1))
    bounded = bounded.observe(seen, F.count(F.lit(1)).alias("rows"))
    publish_csv(grouped_summary(bounded, time=None), f"{work}/stream_result.csv")
    batch_ms, events = batch_clock.ms(), seen.get["rows"]

    batch = spark.read.schema(schemas.NARROW_SUMMARY).option("header", True).csv(f"{work}/stream_result.csv")
    diff = key_diff(counts, batch, ["event_type"], ["event_count"])
    agree = diff.filter("status <> 'same'").isEmpty()
    found, wanted = result_digest(counts, digest), result_digest(expected, digest)
    return _record(
        "03", agree and (expected is None or found == wanted), clock,
        events_count=events, flink_latency_ms=stream_ms, spark_job_time_ms=batch_ms,
        latency_ratio=_value(spark, latency_ratio(F.lit(batch_ms), F.lit(stream_ms))),
        flink_events_per_second=_value(spark, per_second(F.lit(events), F.lit(stream_ms), 1)),
        spark_events_per_second=_value(spark, per_second(F.lit(events), F.lit(batch_ms), 1)),
        digest=digest, flink_output_sha256=found, expected_sha256=wanted,
        spark_output_sha256=result_digest(batch, digest, ","),
    )


def compare_partitions(
    spark: SparkSession,
    source: Callable[[SparkSession], DataFrame],
    query: Callable[[DataFrame], DataFrame],
    partitions: int,
    baseline: int = BASELINE_PARTITIONS,
    at_most: int = MOST_PARTITIONS,
    runs: int = 3,
    adaptive: bool = False,
    timeout: float = 90.0,
    digest: str = MULTISET,
    expected: DataFrame | None = None,
) -> dict[str, Any]:
    """JOB-4: one query at the baseline and at another shuffle partition count.

    Both run once to warm up and then in turn, ``runs`` times each; the medians are compared.
    The rows of ``source`` are counted while they are read, and of typed rows those with
    ``bad_fields``, which the query leaves out. The result has to be ``expected``, if that is
    given, and the baseline's, if that could run; without either there is nothing to compare
    with, and the job has not passed. A baseline that fails or takes too long counts as -1 ms,
    and the job goes on without it. Each setting has a session
    of its own, so the caller's settings stay as they are. Adaptive execution is off by
    default because it would merge the partitions compared here.
    """
    clock = _Clock()

    def session_of(count: int) -> SparkSession:
        session = spark.newSession()
        session.conf.set("spark.sql.shuffle.partitions", count)
        session.conf.set("spark.sql.adaptive.enabled", adaptive)
        return session

    def timed(session: SparkSession) -> tuple[int, dict[str, int], Shuffles]:
        seen, run = Observation(), _Clock()
        with _limit(spark, timeout), measured(session) as moved:
            read = source(session)
            counted = [F.count(F.lit(1)).alias("rows")]
            if "bad_fields" in read.columns:
                counted.append(F.count_if(F.size("bad_fields") > 0).alias("rejected"))
            query(read.observe(seen, *counted)).write.format("noop").mode("overwrite").save()
            took = run.ms()
        return took, {"rejected": 0} | seen.get, moved

    usual, other = session_of(baseline), session_of(partitions)
    usual_digest, usual_times, times = None, [], []
    try:
        with _limit(spark, timeout):
            usual_digest = result_digest(query(source(usual)), digest, ",")
    except Exception:  # the baseline's failure is a result
        usual = None
    with _limit(spark, timeout):
        found = result_digest(query(source(other)), digest, ",")
    for _ in range(runs):
        if usual is not None:
            try:
                usual_times.append(timed(usual)[0])
            except Exception:  # as above
                usual = None
        took, seen, moved = timed(other)
        times.append(took)
    baseline_ms = int(statistics.median(usual_times)) if usual is not None else -1
    job_ms, used = int(statistics.median(times)), shuffle_partitions(other)
    wanted = result_digest(expected, digest, ",")
    compared = [d for d in (wanted, usual_digest) if d is not None]
    processed = seen["rows"] - seen["rejected"]
    return _record(
        "04", bool(compared) and all(found == d for d in compared) and used <= at_most, clock,
        shuffle_partitions_used=used, shuffle_partitions_run=moved.used, shuffle_bytes=moved.written_bytes,
        rows_read=seen["rows"], rows_processed=processed, rows_rejected=seen["rejected"],
        rows_per_second=int(_value(spark, per_second(F.lit(processed), F.lit(job_ms), 0))),
        job_time_ms=job_ms, baseline_time_ms=baseline_ms,
        speedup_factor=_value(spark, speedup(F.lit(baseline_ms), F.lit(job_ms))),
        digest=digest, output_sha256=found, expected_sha256=compared[0] if compared else None,
    )


def pipeline(
    spark: SparkSession,
    messages: DataFrame,
    work: str,
    expected: DataFrame | None = None,
    injected: int | None = None,
    timeout: float = 90.0,
    digest: str = MULTISET,
) -> dict[str, Any]:
    """JOB-5: stream counts, handed over as an event table, summarised by the batch stage.

    Checked as JOB-1 is; besides, both stages have to agree on every key.
    """
    if expected is None and injected is None:
        raise ValueError("give expected counts or the number of messages: a result is not checked by itself")
    clock = _Clock()
    run_to_end(
        start_counter(parse_messages(messages), out=f"{work}/stream", checkpoint=f"{work}/checkpoint"), timeout
    )
    counts = SnapshotStore(spark, f"{work}/stream/counts").read()
    write_handoff(counts, f"{work}/pipeline_events", "parquet")
    handed = spark.read.schema(handoff(counts).schema).parquet(f"{work}/pipeline_events")
    publish_csv(grouped_summary(handed), f"{work}/pipeline_result.csv")
    result = spark.read.schema(schemas.SUMMARY).option("header", True).csv(f"{work}/pipeline_result.csv")

    total = counts.agg(F.coalesce(F.sum("event_count"), F.lit(0))).first()[0]
    found, wanted = result_digest(counts, digest), result_digest(expected, digest)
    both = key_diff(
        counts.select("event_type", F.col("event_count").alias("total")),
        result.select("event_type", F.col("total_value").alias("total")),
        ["event_type"], ["total"],
    )
    agree = both.filter("status <> 'same'").isEmpty()
    passed = agree and (expected is None or found == wanted) and (injected is None or total == injected)
    return _record(
        "05", passed, clock,
        events_injected=total if injected is None else injected, digest=digest, flink_output_sha256=found,
        expected_sha256=wanted, spark_output_sha256=result_digest(result, digest, ","),
    )


def summarise_runs(runs: DataFrame, ids: Iterable[str] | None = None) -> DataFrame:
    """JOB-6 on existing records: totals of all or of the requested runs."""
    return roll_up(runs if ids is None else select_runs(runs, ids))


def run_all(
    spark: SparkSession, work: str, ids: Sequence[str] | None = None, n: int = 1000, timeout: float = 120.0
) -> dict[str, Any]:
    """JOB-6: generate events, run the requested jobs, write their records and the summary.

    A job that fails leaves a failed record with its error and does not stop the others.
    """
    known = spark.createDataFrame([(i,) for i in RUNS], "id string")
    wanted = [row.id for row in (known if ids is None else select_runs(known, ids)).orderBy("id").collect()]
    index = generators.indices(spark, n)
    counted = spark.range(1).select(F.lit(n).cast("bigint").alias("n"))
    expected = generators.expected_counts(counted)
    landing, table = f"{work}/landing", f"{work}/events_csv"
    write_messages(generators.messages(index), landing)
    events = generators.event_table(index, 42, 1, 100)
    events.write.mode("overwrite").option("header", True).csv(table)

    jobs = {
        "01": lambda: stream_counts(
            spark, read_messages(spark, landing), f"{work}/01", f"{work}/01/checkpoint", expected, n,
            timeout=timeout, digest=CANONICAL,
        ),
        "02": lambda: batch_summary(
            spark, table, f"{work}/02/result.csv", grouped_summary(events), True, timeout, CANONICAL
        ),
        "03": lambda: compare_stream_batch(spark, landing, f"{work}/03", timeout, CANONICAL),
        "04": lambda: compare_partitions(
            spark, lambda s: read_event_csv(s, table), summary_of_good_rows, MOST_PARTITIONS,
            timeout=timeout, digest=CANONICAL, expected=grouped_summary(events),
        ),
        "05": lambda: pipeline(spark, read_messages(spark, landing), f"{work}/05", expected, n, timeout, CANONICAL),
    }
    for run_id in wanted:
        clock = _Clock()
        try:
            record = jobs[run_id]()
        except Exception as error:
            name = "timeout" if isinstance(error, TimeoutError) else f"{type(error).__name__}: {error}"
            record = _record(run_id, False, clock, error=name)
        write_run(spark, f"{work}/results", record)

    runs = read_run_records(spark, f"{work}/results/scenario_*.json").filter(F.col("id").isin(wanted))
    summary = f"{work}/results/result.json"
    write_summary(runs, summary, single_file=True)
    document = spark.read.text(summary, wholetext=True)
    violation = first_violations(document.select(F.lit("result").alias("submission"), F.col("value").alias("text")))
    checked = violation.first()
    if not checked.valid:
        raise ValueError(f"summary breaks rule {checked.rule}: {checked.detail}")
    return summarise_runs(runs).first().asDict()


def summary_of_good_rows(typed: DataFrame) -> DataFrame:
    return grouped_summary(good_rows(typed))


def result_digest(result: DataFrame | None, kind: str = MULTISET, sep: str = "\t") -> str | None:
    """Digest of a result's lines, of the kind the caller names; None of None.

    ``CANONICAL`` is the SHA-256 of the sorted lines, which meet in one task: for results as
    small as one text may be. ``MULTISET`` takes results of any size.
    """
    if result is None:
        return None
    columns = [F.col(c) for c in result.columns]
    if kind == CANONICAL:
        return canonical_digest(result.select(render_line(*columns, sep=sep).alias("value"))).first().sha256
    if kind == MULTISET:
        return multiset_digest(result.select(escaped_line(*columns, sep=sep).alias("value"))).first().digest
    raise ValueError(f"unknown kind of digest: {kind}")


@contextmanager
def _limit(spark: SparkSession, seconds: float) -> Iterator[None]:
    """Cancels the jobs started inside after a time; that ends in a ``TimeoutError``."""
    group, late = f"eventflow-{uuid.uuid4().hex}", threading.Event()

    def cancel() -> None:
        late.set()
        spark.sparkContext.cancelJobGroup(group)

    timer = threading.Timer(seconds, cancel)
    spark.sparkContext.setJobGroup(group, "limited in time", interruptOnCancel=True)
    timer.start()
    try:
        yield
    except Exception as error:
        if late.is_set():
            raise TimeoutError(f"job did not finish within {seconds} s") from error
        raise
    finally:
        timer.cancel()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


class _Clock:
    def __init__(self) -> None:
        self._start = time.monotonic()

    def ms(self) -> int:
        return int((time.monotonic() - self._start) * 1000)


def _record(run_id: str, passed: bool, clock: _Clock, **fields: Any) -> dict[str, Any]:
    common = {"id": run_id, "name": RUNS[run_id], "passed": bool(passed)}
    return {**common, **fields, "elapsed_ms": clock.ms()}


def _value(spark: SparkSession, column) -> Any:
    return spark.range(1).select(column.alias("v")).first().v
