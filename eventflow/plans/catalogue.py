"""The registered queries: each operator over the given tables, as ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow import files, schemas
from eventflow.functions.numbers import cents, epoch_micros
from eventflow.functions.text import escaped_row, event_key, event_sequence, render_line, scenario_id
from eventflow.operators.filters import bad_integers, select_runs
from eventflow.operators.hashtree import tree_diff
from eventflow.operators.running import nth_event, running_counts
from eventflow.operators.runs import add_metrics, roll_up, summary_lines
from eventflow.operators.summary import (
    global_total,
    grouped_summary,
    handoff,
    key_counts,
    parse_messages,
    row_count,
)
from eventflow.operators.validate import all_violations, first_violations, large_violations
from eventflow.operators.verify import (
    canonical_digest,
    completeness,
    digests_match,
    fingerprint,
    key_diff,
    multiset_digest,
    partition_rule,
)
from eventflow.plans import derived, jobs
from eventflow.plans.measured import measured
from eventflow.session import setting, work_dir
from eventflow.sinks.records import write_single_text, write_submissions
from eventflow.sinks.snapshots import SnapshotStore, write_snapshot_text
from eventflow.sinks.tables import publish_csv, write_handoff, write_segment
from eventflow.sources import generators
from eventflow.sources.delimited import (
    accounting,
    bad_rows,
    good_rows,
    parse_event_lines,
    parse_snapshot_lines,
    read_event_csv,
)
from eventflow.sources.inference import infer_types
from eventflow.sources.large_json import read_large_documents
from eventflow.sources.messages import as_messages, read_messages, stream_table
from eventflow.sources.records import parse_run_records, read_run_records, read_submissions
from eventflow.streaming.counter import (
    read_changelog,
    run_to_end,
    start_changelog,
    start_counter,
)
from eventflow.streaming.progress import RunProgress, completion
from eventflow.streaming.rescale import rescale_counter
from eventflow.streaming.sessions import read_ended, read_open, session_counts, start_session_counter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries.
NTH = 1000
SEED, LOW, HIGH = 42, 1, 100
STREAM_TIMEOUT = 3600.0
# A backlog is worked off in micro-batches of this size, so that a failure repeats one of them.
BATCH_BYTES = 4 << 30


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _cents(table: DataFrame) -> DataFrame:
    return table.withColumn("value", cents(F.col("value")))


def _event_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table and damaged lines as CSV text in the shared folder, read back."""
    path = work_dir(spark, "event-csv")
    derived.csv_lines(derived.events(spark, sf_dir)).write.text(path)
    return read_event_csv(spark, path, header=False)


def _lineitem_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns as whole numbers and texts, which every engine writes alike."""
    table = derived.lineitem(spark, sf_dir)
    exact = {c: cents(F.col(c)) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
    return table.withColumns({**exact, "l_shipdate": epoch_micros(F.col("l_shipdate"))})


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch form of the running counts."""
    return key_counts(parse_messages(as_messages(derived.events(spark, sf_dir))))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(stream_table(spark, f"{sf_dir}/events.parquet", schemas.EVENTS, max_bytes=BATCH_BYTES))


def _stream_counts(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    work = work_dir(spark, f"counts-{mode}")
    started = start_counter(
        parse_messages(_stream(spark, sf_dir)), out=f"{work}/out", checkpoint=f"{work}/checkpoint", mode=mode
    )
    run_to_end(started, STREAM_TIMEOUT)
    return SnapshotStore(spark, f"{work}/out/counts").read()


# Grouped summaries


@query
def batch_summary(spark, sf_dir):
    """AGG-2, SRT-1."""
    table = _cents(derived.events(spark, sf_dir))
    return grouped_summary(table, time="ts", total_name="total_cents", max_name="max_ts").orderBy("event_type")


@query
def batch_summary_narrow(spark, sf_dir):
    """AGG-3."""
    return grouped_summary(_cents(derived.events(spark, sf_dir)), time=None, total_name="total_cents")


@query
def summary_by_user_type(spark, sf_dir):
    """AGG-2 with two keys."""
    table = _cents(derived.events(spark, sf_dir))
    return grouped_summary(table, ["user_id", "event_type"], time="ts", total_name="total_cents", max_name="max_ts")


@query
def lineitem_summary(spark, sf_dir):
    """AGG-2 on the largest table."""
    table = derived.lineitem(spark, sf_dir)
    return grouped_summary(
        table, ["l_returnflag", "l_linestatus"], cents(F.col("l_quantity")), "l_shipdate",
        "total_quantity_hundredths", "max_shipdate",
    )


@query
def orders_summary(spark, sf_dir):
    """AGG-2 on another key, value and time."""
    table = derived.orders(spark, sf_dir)
    return grouped_summary(
        table, ["o_orderstatus", "o_orderpriority"], cents(F.col("o_totalprice")), "o_orderdate",
        "total_cents", "max_orderdate",
    )


@query
def csv_summary(spark, sf_dir):
    """SRC-4, AGG-2 over CSV text."""
    return grouped_summary(good_rows(_event_csv(spark, sf_dir)))


@query
def csv_quarantine(spark, sf_dir):
    """SRC-4, FLT-1: the rows that are kept out, by key and bad field; lines in a table column."""
    lines = derived.csv_lines(derived.events(spark, sf_dir)).filter(F.trim("value") != "")
    bad = bad_rows(parse_event_lines(lines)).select("event_type", F.explode("bad_fields").alias("bad_field"))
    return bad.groupBy("event_type", "bad_field").agg(F.count(F.lit(1)).alias("row_count"))


@query
def csv_rejected_lines(spark, sf_dir):
    """JOB-2, SRC-4: the lines in quarantine as they were read, and what is wrong with each."""
    bad = bad_rows(_event_csv(spark, sf_dir))
    return bad.select("line", F.array_join("bad_fields", ",").alias("bad_fields"), F.col("file").isNotNull().alias("has_file"))


@query
def csv_types(spark, sf_dir):
    """SRC-4: types of the columns of CSV lines, if none or a quarter of the values may be misfits."""
    lines = derived.csv_lines(derived.events(spark, sf_dir)).filter(F.trim("value") != "")
    parsed = parse_event_lines(lines, schemas.EVENT_TEXTS)
    rows = parsed.filter(F.size("bad_fields") == 0)
    found = [
        infer_types(rows, schemas.EVENT_TEXTS.fieldNames(), tolerance=tolerance).withColumn("tolerance", F.lit(tolerance))
        for tolerance in (0.0, 0.25)
    ]
    return found[0].unionByName(found[1])


@query
def csv_accounting(spark, sf_dir):
    """SRC-4, JOB-2: every row read is summed, without a value, or rejected."""
    return accounting(_event_csv(spark, sf_dir))


@query
def batch_job_rows(spark, sf_dir):
    """JOB-2, FLT-4: the batch job on CSV with a header, damaged rows included, as its record tells."""
    path = work_dir(spark, "batch-job")
    rows = derived.csv_rows(derived.events(spark, sf_dir))
    rows.write.option("header", True).csv(f"{path}/events")
    record = jobs.batch_summary(spark, f"{path}/events", f"{path}/summary", timeout=STREAM_TIMEOUT)
    counted = [F.lit(record[k]).cast("bigint").alias(k) for k in ("rows_read", "rows_processed", "rows_rejected")]
    return spark.range(1).select(*counted, F.lit(record["passed"]).alias("passed"))


@query
def published_summary(spark, sf_dir):
    """SNK-2: the batch summary published as ordered CSV parts, read back."""
    path = f"{work_dir(spark, 'published')}/summary"
    summary = grouped_summary(_cents(derived.events(spark, sf_dir)), time="event_id")
    publish_csv(summary, path)
    return spark.read.schema(summary.schema).option("header", True).csv(path)


# Messages and generators


@query
def event_messages(spark, sf_dir):
    """SNK-4 form of the event table."""
    return as_messages(derived.events(spark, sf_dir))


@query
def parse_events(spark, sf_dir):
    """PRJ-1 on messages of eight shapes."""
    table = derived.dirty_messages(derived.events(spark, sf_dir))
    return table.select(
        "event_id",
        "shape",
        event_key(F.col("value")).alias("event_type"),
        event_sequence(F.col("value")).alias("sequence"),
    )


@query
def generated_messages(spark, sf_dir):
    """SRC-8 over the table's row numbers."""
    return generators.messages(derived.index(derived.events(spark, sf_dir)))


@query
def generated_counts(spark, sf_dir):
    """SRC-8 to AGG-1; equal to ``expected_counts``."""
    generated = generators.messages(derived.index(derived.events(spark, sf_dir)))
    return key_counts(parse_messages(generated))


@query
def expected_counts(spark, sf_dir):
    """AGG-7 for as many events as the table has."""
    return generators.expected_counts(derived.table_size(derived.events(spark, sf_dir)))


@query
def generated_event_table(spark, sf_dir):
    """SRC-9."""
    return generators.event_table(derived.index(derived.events(spark, sf_dir)), SEED, LOW, HIGH)


@query
def constant_summary(spark, sf_dir):
    """SRC-10 to AGG-3."""
    return grouped_summary(generators.constant_table(derived.index(derived.events(spark, sf_dir))), time=None)


# Streams


@query
def stream_counts(spark, sf_dir):
    """SRC-1, PRJ-1, AGG-1, SNK-1 in complete mode."""
    return _stream_counts(spark, sf_dir, "complete")


@query
def stream_counts_update(spark, sf_dir):
    """AGG-1 in update mode, read back with the latest count per key (STR-4)."""
    return _stream_counts(spark, sf_dir, "update")


def _two_landings(spark: SparkSession, sf_dir: str, work: str) -> Iterator[DataFrame]:
    """The messages as a stream over a landing folder to which the second half is added later."""
    table = derived.events(spark, sf_dir)
    for half in (0, 1):
        as_messages(table.filter(F.col("event_id") % 2 == half)).write.mode("append").text(f"{work}/landing")
        yield parse_messages(read_messages(spark, f"{work}/landing", max_bytes=BATCH_BYTES))


@query
def stream_restart(spark, sf_dir):
    """STR-7: a run that ended is continued from its checkpoint when more messages have come."""
    work = work_dir(spark, "restart")
    for events in _two_landings(spark, sf_dir, work):
        run_to_end(start_counter(events, out=f"{work}/out", checkpoint=f"{work}/checkpoint"), STREAM_TIMEOUT)
    return SnapshotStore(spark, f"{work}/out/counts").read()


def _log(spark: SparkSession, work: str, start: str = "earliest") -> DataFrame:
    return parse_messages(read_messages(spark, f"{work}/log", format="landing", start=start))


def _segment(spark: SparkSession, sf_dir: str, work: str, number: int, of: int) -> list[str]:
    """A share of the event table as the next segment of a landing log."""
    share = derived.events(spark, sf_dir).filter(F.col("event_id") % of == number)
    return write_segment(as_messages(share), f"{work}/log", number)


@query
def counts_from_position(spark, sf_dir):
    """SRC-2: a stream that starts at a position of a log, ends, and goes on when more has come."""
    work = work_dir(spark, "position")
    _segment(spark, sf_dir, work, 0, 3)
    start = json.dumps({"file": min(_segment(spark, sf_dir, work, 1, 3)), "bytes": 0})
    for more in (None, 2):
        if more:
            _segment(spark, sf_dir, work, more, 3)
        started = start_counter(_log(spark, work, start), out=f"{work}/out", checkpoint=f"{work}/checkpoint")
        run_to_end(started, STREAM_TIMEOUT)
    return SnapshotStore(spark, f"{work}/out/counts").read()


@query
def rescaled_counts(spark, sf_dir):
    """STR-8: half of the messages counted with 4 state partitions, the rest by a run that goes on with 8."""
    work = work_dir(spark, "rescaled")
    _segment(spark, sf_dir, work, 0, 2)
    with setting(spark, "spark.sql.shuffle.partitions", "4"):
        run_to_end(start_counter(_log(spark, work), out=f"{work}/old", checkpoint=f"{work}/old/checkpoint"), STREAM_TIMEOUT)
    _segment(spark, sf_dir, work, 1, 2)
    started = rescale_counter(
        spark, lambda start: _log(spark, work, start), 8,
        old_out=f"{work}/old", old_checkpoint=f"{work}/old/checkpoint", out=f"{work}/new", checkpoint=f"{work}/new/checkpoint",
    )
    run_to_end(started, STREAM_TIMEOUT)
    return SnapshotStore(spark, f"{work}/new/counts").read()


@query
def stream_until_complete(spark, sf_dir):
    """STR-6: a stream without an end, stopped once it has worked off as many events as the table has."""
    work = work_dir(spark, "until-complete")
    with RunProgress(spark, parse_messages(_stream(spark, sf_dir))) as progress:
        running = start_counter(
            progress.events, out=f"{work}/out", checkpoint=f"{work}/checkpoint", trigger={"processingTime": "1 second"}
        )
        try:
            if not progress.wait_for(derived.events(spark, sf_dir).count(), running, STREAM_TIMEOUT):
                raise TimeoutError("the stream's counts stayed incomplete")
        finally:
            running.stop()
    return SnapshotStore(spark, f"{work}/out/counts").read()


@query
def batch_progress(spark, sf_dir):
    """STR-6, MET-1: the micro-batches of a run over a log that grows three times, and when it was half through."""
    work = work_dir(spark, "progress")
    half = derived.events(spark, sf_dir).count() // 2
    with RunProgress(spark, _log(spark, work)) as progress:
        for number in range(4):
            _segment(spark, sf_dir, work, number, 4)
            started = start_counter(progress.events, out=f"{work}/out", checkpoint=f"{work}/checkpoint")
            progress.wait_for_end(started, STREAM_TIMEOUT)
        batches = progress.table()
    reached = completion(batches, half)
    return batches.select(
        "batch_id", "rows", "rows_before", (F.col("batch_id") == reached.select("batch_id").scalar()).alias("reaches_half"),
        ((F.col("milliseconds") >= 0) & (reached.select("latency_ms").scalar() >= 0)).alias("timed"),
    )


@query
def idle_keys(spark, sf_dir):
    """STR-1: counts per user and type that end when idle for a day; the ended ones as written, the others in the state."""
    work, keys, at = work_dir(spark, "idle"), ["user_id", "event_type"], F.col("ts").cast("timestamp").alias("at")
    events = stream_table(spark, f"{sf_dir}/events.parquet", schemas.EVENTS, max_bytes=BATCH_BYTES).select(*keys, at)
    checkpoint, idle = f"{work}/checkpoint", "1 day"
    run_to_end(start_session_counter(events, out=work, checkpoint=checkpoint, keys=keys, time="at", idle=idle), STREAM_TIMEOUT)
    ended = read_ended(spark, work, session_counts(events, keys, "at", idle).schema)
    found = ended.withColumn("ended", F.lit(True)).unionByName(read_open(spark, checkpoint, keys).withColumn("ended", F.lit(False)))
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started", "last_seen")})


@query
def count_changelog(spark, sf_dir):
    """STR-5 in batch."""
    return running_counts(derived.events(spark, sf_dir), ["event_type"], "event_id")


@query
def count_changelog_stream(spark, sf_dir):
    """STR-5 as a stream."""
    work = work_dir(spark, "changelog")
    parsed = _stream(spark, sf_dir).select(
        event_key(F.col("value")).alias("event_type"), event_sequence(F.col("value")).alias("event_id")
    )
    started = start_changelog(
        parsed, out=f"{work}/out", checkpoint=f"{work}/checkpoint", sequence="event_id"
    )
    run_to_end(started, STREAM_TIMEOUT)
    return read_changelog(spark, f"{work}/out", parsed.withColumn("running_count", F.lit(0).cast("bigint")).schema)


@query
def time_to_n(spark, sf_dir):
    """MET-1: when each key reached its n-th event."""
    table = derived.events(spark, sf_dir)
    return nth_event(table, ["event_type"], "ts", epoch_micros(F.col("ts")), NTH)


@query
def time_to_n_overall(spark, sf_dir):
    """MET-1 over all events."""
    return nth_event(derived.events(spark, sf_dir), [], "ts", epoch_micros(F.col("ts")), NTH)


# Snapshots and the two-stage pipeline


@query
def snapshot_rows(spark, sf_dir):
    """SRC-5, FLT-2."""
    lines = derived.snapshot_lines(derived.events(spark, sf_dir))
    return parse_snapshot_lines(lines).select("event_type", "count_text", "event_count")


@query
def snapshot_rows_loose(spark, sf_dir):
    """SRC-5 as JOB-3 reads it: any line with a tab, nothing stripped."""
    lines = derived.snapshot_lines(derived.events(spark, sf_dir))
    return parse_snapshot_lines(lines, exact=False).select("event_type", "count_text", "event_count")


@query
def snapshot_total_skip(spark, sf_dir):
    """FLT-3: bad integers are skipped."""
    rows = parse_snapshot_lines(derived.snapshot_lines(derived.events(spark, sf_dir)))
    return rows.groupBy("event_type").agg(
        bad_integers("skip", F.col("event_count"), F.col("count_text")).alias("total")
    )


@query
def snapshot_total_zero(spark, sf_dir):
    """FLT-3: one bad integer makes the total 0."""
    rows = parse_snapshot_lines(derived.snapshot_lines(derived.events(spark, sf_dir)))
    return rows.groupBy("event_type", F.startswith("count_text", F.lit("-")).alias("negative")).agg(
        bad_integers("zero", F.col("event_count"), F.col("count_text")).alias("total")
    )


@query
def rendered_lines(spark, sf_dir):
    """PRJ-5 on the batch summary."""
    summary = grouped_summary(_cents(derived.events(spark, sf_dir)), time="event_id")
    return summary.select(render_line(*[F.col(c) for c in summary.columns], sep=",").alias("line"))


@query
def global_total_of_counts(spark, sf_dir):
    """AGG-5."""
    return global_total(_counts(spark, sf_dir))


@query
def result_row_count(spark, sf_dir):
    """AGG-6."""
    return row_count(_counts(spark, sf_dir))


@query
def snapshot_file(spark, sf_dir):
    """SRT-2: the counts written as sorted lines and read back."""
    path = work_dir(spark, "snapshot")
    write_snapshot_text(_counts(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query
def handoff_file(spark, sf_dir):
    """SNK-5: the counts handed over as a file for the batch stage, and summarised by it."""
    path = work_dir(spark, "handoff")
    counts = _counts(spark, sf_dir)
    write_handoff(counts, path)
    handed = spark.read.schema(handoff(counts).schema).option("header", True).csv(path)
    return grouped_summary(handed)


@query
def handoff_table(spark, sf_dir):
    """PRJ-3."""
    return handoff(_counts(spark, sf_dir))


@query
def pipeline_summary(spark, sf_dir):
    """JOB-5: stream counts, hand-off, AGG-4."""
    return grouped_summary(handoff(_stream_counts(spark, sf_dir, "update")))


# Verification


@query
def result_digest(spark, sf_dir):
    """VER-1 on the counts."""
    counts = _counts(spark, sf_dir)
    return canonical_digest(counts.select(render_line(F.col("event_type"), F.col("event_count")).alias("value")))


@query
def digest_check(spark, sf_dir):
    """VER-2: generated events against the closed form."""
    table = derived.events(spark, sf_dir)
    counted = key_counts(parse_messages(generators.messages(derived.index(table))))
    expected = generators.expected_counts(derived.table_size(table))
    line = render_line(F.col("event_type"), F.col("event_count")).alias("value")
    return digests_match(canonical_digest(counted.select(line)), canonical_digest(expected.select(line)))


@query
def table_digest(spark, sf_dir):
    """VER-1 for tables of any size."""
    table = _lineitem_columns(spark, sf_dir)
    return multiset_digest(table.select(escaped_row(table).alias("value")))


@query
def table_fingerprint(spark, sf_dir):
    """VER-1, the cheaper form."""
    return fingerprint(_lineitem_columns(spark, sf_dir))


@query
def stream_batch_diff(spark, sf_dir):
    """VER-7, JOB-3: a stream of messages against a batch of events."""
    batch = key_counts(derived.events(spark, sf_dir))
    return key_diff(_stream_counts(spark, sf_dir, "update"), batch, ["event_type"], ["event_count"])


@query
def lineitem_diff(spark, sf_dir):
    """VER-2 for tables of any size: the largest table against a changed copy of it."""
    table = derived.lineitem_exact(derived.lineitem(spark, sf_dir))
    columns = ["quantity", "price", "line", "shipped"]
    return tree_diff(table, derived.lineitem_changed(table), ["l_orderkey", "l_linenumber"], columns, ("kept", "copy"))


@query
def stream_batch_tree_diff(spark, sf_dir):
    """VER-7 for results of any size: the stream's counts per user and type, and a batch's of all but some events."""
    keys, work = ["user_id", "event_type"], work_dir(spark, "tree-diff")
    events = stream_table(spark, f"{sf_dir}/events.parquet", schemas.EVENTS, max_bytes=BATCH_BYTES)
    run_to_end(start_counter(events, out=f"{work}/out", checkpoint=f"{work}/checkpoint", keys=keys), STREAM_TIMEOUT)
    streamed = SnapshotStore(spark, f"{work}/out/counts", key_counts(events, keys).schema).read()
    batch = key_counts(derived.events(spark, sf_dir).filter("event_id % 50 <> 7"), keys)
    return tree_diff(streamed, batch, keys, ["event_count"], ("stream", "batch"), rows_per_leaf=64)


@query
def completeness_check(spark, sf_dir):
    """VER-3, VER-4."""
    return completeness(_counts(spark, sf_dir), derived.table_size(derived.events(spark, sf_dir)))


@query
def summary_violations(spark, sf_dir):
    """VER-6."""
    return first_violations(derived.documents(derived.spread(derived.events(spark, sf_dir))))


@query
def all_violations_of_documents(spark, sf_dir):
    """VER-6: every violation with the stated and the computed value."""
    return all_violations(derived.documents(derived.spread(derived.events(spark, sf_dir))))


@query
def large_document_violations(spark, sf_dir):
    """VER-6, SRC-7, SNK-7: one document with a run per event, written, read in ranges and checked by many tasks."""
    path = f"{work_dir(spark, 'large-document')}/result.json"
    lines = derived.large_document(derived.events(spark, sf_dir))
    write_single_text(lines.orderBy("section", "event_id").select(F.col("line").alias("value")), path)
    found = read_large_documents(spark, path)
    return large_violations(found.documents, found.elements).drop("submission")


@query
def partitions_used(spark, sf_dir):
    """MET-6: a summary with 200 partitions set; adaptive execution runs fewer."""
    path = work_dir(spark, "partitions")
    table = _cents(derived.events(spark, sf_dir))
    with setting(spark, "spark.sql.shuffle.partitions", "200"), measured(spark) as moved:
        grouped_summary(table, ["user_id", "event_type"], time="ts").write.parquet(path)
    groups = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("groups"))
    return groups.select(
        "groups", F.lit(moved.configured).cast("bigint").alias("configured"),
        F.lit(0 < moved.used < moved.configured).alias("fewer_ran"), F.lit(moved.written_bytes > 0).alias("moved"),
    )


# Jobs, by what their records tell


def _told(spark: SparkSession, record: dict, *names: str) -> DataFrame:
    numbers = [F.lit(record[name]).cast("bigint").alias(name) for name in names]
    return spark.range(1).select(*numbers, F.lit(record["passed"]).alias("passed"))


@query
def stream_job(spark, sf_dir):
    """JOB-1: the counting job on the event table's messages, checked against the batch form."""
    work = work_dir(spark, "stream-job")
    events = derived.events(spark, sf_dir)
    as_messages(events).write.text(f"{work}/landing")
    record = jobs.stream_counts(
        spark, read_messages(spark, f"{work}/landing", max_bytes=BATCH_BYTES), work, f"{work}/checkpoint",
        key_counts(events), events.count(), timeout=STREAM_TIMEOUT,
    )
    return _told(spark, record, "events_injected", "events_counted")


@query
def partitions_job(spark, sf_dir):
    """JOB-4: CSV with damaged rows at 4 and at 12 partitions, against the table's own summary."""
    path = work_dir(spark, "partitions-job")
    events = derived.events(spark, sf_dir)
    derived.csv_rows(events).write.option("header", True).csv(path)
    clean = parse_event_lines(derived.csv_rows(events).select(F.to_csv(F.struct("event_type", "value", "timestamp")).alias("value")))
    record = jobs.compare_partitions(
        spark, lambda session: read_event_csv(session, path), jobs.summary_of_good_rows, 4, 12, runs=1,
        timeout=STREAM_TIMEOUT, expected=grouped_summary(good_rows(clean)),
    )
    return _told(spark, record, "rows_read", "rows_processed", "rows_rejected", "shuffle_partitions_used")


@query
def all_jobs(spark, sf_dir):
    """JOB-6, SNK-6, SNK-7: the jobs on as many generated events as the table has; their records, as written."""
    work = work_dir(spark, "all-jobs")
    jobs.run_all(spark, work, ["1", "2", "3", "5"], derived.events(spark, sf_dir).count(), STREAM_TIMEOUT)
    records = read_run_records(spark, f"{work}/results/scenario_*.json")
    counted = [F.try_variant_get("record", f"$.{name}", "bigint") for name in ("events_injected", "rows_processed", "events_count")]
    return records.select("id", "name", "passed", F.coalesce(*counted).alias("worked_off"))


@query
def submission_violations(spark, sf_dir):
    """SRC-7: a result file for each submission, and one that is missing for each; first violation of all."""
    root = work_dir(spark, "submissions")
    texts = derived.documents(derived.spread(derived.events(spark, sf_dir).filter("event_id % 25 = 0").dropDuplicates(["event_id"])))
    given = texts.filter(F.col("text").isNotNull())
    write_submissions(given, root)
    names = given.select(F.col("submission").cast("string"))
    expected = names.unionByName(names.select(F.concat(F.lit("late-"), "submission").alias("submission")))
    return first_violations(read_submissions(spark, root, expected)).drop("position")


@query
def counts_from_now(spark, sf_dir):
    """SRC-3: a stream that begins now does not count what was there before."""
    work = work_dir(spark, "from-now")
    events = derived.events(spark, sf_dir)
    as_messages(events.filter("event_id % 2 = 0")).write.text(f"{work}/landing")
    names = files.written(spark, f"{work}/landing")
    now = datetime.fromtimestamp(max(names.values()) + 1, timezone.utc)
    while datetime.now(timezone.utc) < now:
        time.sleep(0.1)
    as_messages(events.filter("event_id % 2 = 1")).write.mode("append").text(f"{work}/landing")
    later = read_messages(spark, f"{work}/landing", start="latest", since=now, max_bytes=BATCH_BYTES)
    run_to_end(start_counter(parse_messages(later), out=work, checkpoint=f"{work}/checkpoint"), STREAM_TIMEOUT)
    return SnapshotStore(spark, f"{work}/counts").read()


# Run records


@query
def run_records(spark, sf_dir):
    """SRC-6: records and unreadable texts."""
    return parse_run_records(derived.run_texts(derived.events(spark, sf_dir))).drop("record")


@query
def run_rollup(spark, sf_dir):
    """AGG-9, MET-7."""
    return roll_up(derived.runs(derived.events(spark, sf_dir)), ["submission"])


@query
def run_metrics(spark, sf_dir):
    """MET-2 to MET-5."""
    runs = add_metrics(derived.runs(derived.events(spark, sf_dir)))
    return runs.select("id", "events_per_second", "rows_per_second", "latency_ratio", "speedup_factor")


@query
def partition_check(spark, sf_dir):
    """VER-5."""
    runs = partition_rule(derived.runs(derived.events(spark, sf_dir)))
    return runs.select("id", "shuffle_partitions_used", "partitions_ok")


@query
def scenario_ids(spark, sf_dir):
    """PRJ-6 on numbers, padded numbers and names."""
    table = derived.events(spark, sf_dir)
    asked = F.when(F.col("event_id") % 3 == 0, F.col("user_id").cast("string")).when(
        F.col("event_id") % 3 == 1, F.concat(F.lit("00"), F.col("user_id").cast("string"))
    ).otherwise(F.col("event_type"))
    return table.select("event_id", scenario_id(asked).alias("scenario_id"))


@query
def selected_runs(spark, sf_dir):
    """FLT-5: runs with the normalised ids 01, 02 and 05."""
    table = derived.events(spark, sf_dir).select(
        scenario_id(F.col("user_id").cast("string")).alias("id"), "event_type", cents(F.col("value")).alias("elapsed_ms")
    )
    runs = table.withColumn("passed", F.col("event_type") != "error")
    return roll_up(select_runs(runs, ["1", "02", "5", "5"]), ["id"])


@query
def summary_document(spark, sf_dir):
    """SNK-7: the lines of the document of all runs."""
    runs = derived.runs(derived.events(spark, sf_dir))
    record = F.to_json(F.struct("id", "name", "passed", "elapsed_ms"))
    return summary_lines(runs.withColumn("record_json", record))
