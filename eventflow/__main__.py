"""Command line: ``python -m eventflow <job> ...``."""

from __future__ import annotations

import argparse
import json
import sys
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow import schemas
from eventflow.operators.validate import first_violations
from eventflow.plans import jobs
from eventflow.session import build_session, work_dir
from eventflow.sinks.tables import write_messages
from eventflow.sources import generators
from eventflow.sources.delimited import read_event_csv, read_snapshot_text
from eventflow.sources.messages import read_messages
from eventflow.sources.records import read_submissions


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session("eventflow", shuffle_partitions=args.shuffle_partitions)
    try:
        result = _run(spark, args)
    finally:
        spark.stop()
    print(json.dumps(result))
    return 1 if result.get("invalid") or result.get("passed") is False else 0


def _run(spark: SparkSession, args: argparse.Namespace) -> dict[str, Any]:
    if args.job == "generate":
        n = generators.indices(spark, args.count)
        options = json.loads(args.options)
        if args.topic:
            options["topic"] = args.topic
        write_messages(generators.messages(n), args.path, format=args.format, options=options)
        total = spark.range(1).select(F.lit(args.count).cast("bigint").alias("n"))
        digest = jobs.result_digest(generators.expected_counts(total), jobs.CANONICAL)
        result = {
            "count": args.count, "sha256_of_expected_output": digest,
            "scenario_id": args.scenario, "topic": args.topic or args.path,
        }
    elif args.job == "stream-counts":
        messages, injected, expected = _messages(spark, args)
        result = jobs.stream_counts(
            spark, messages, args.out, args.checkpoint, expected, injected, args.mode, args.timeout, args.digest
        )
    elif args.job == "pipeline":
        messages, injected, expected = _messages(spark, args)
        result = jobs.pipeline(spark, messages, args.out, expected, injected, args.timeout, args.digest)
    elif args.job == "compare":
        expected = args.expected and read_snapshot_text(spark, args.expected).select("event_type", "event_count")
        source = {"format": args.format, "start": args.start, "options": json.loads(args.options)}
        result = jobs.compare_stream_batch(
            spark, args.path, args.out, args.timeout, args.digest, expected or None, source,
            max_files=args.max_files, max_bytes=args.max_bytes,
        )
    elif args.job == "batch-summary":
        expected = args.expected and spark.read.schema(schemas.SUMMARY).option("header", True).csv(args.expected)
        result = jobs.batch_summary(
            spark, args.path, args.out, expected or None, args.single_file, args.timeout, args.digest
        )
    elif args.job == "partitions":
        expected = args.expected and spark.read.schema(schemas.SUMMARY).option("header", True).csv(args.expected)
        result = jobs.compare_partitions(
            spark, lambda s: read_event_csv(s, args.path), jobs.summary_of_good_rows, args.count, args.baseline,
            args.at_most, timeout=args.timeout, digest=args.digest, expected=expected or None,
        )
    elif args.job == "run-all":
        ids = args.scenarios.split(",") if args.scenarios else None
        work = args.out or work_dir(spark, "run-all")
        result = {"work": work, **jobs.run_all(spark, work, ids, args.count, args.timeout)}
    else:
        rows = first_violations(read_submissions(spark, args.path)).filter("not valid")
        invalid = rows.count()
        rows.orderBy("submission").show(truncate=False)
        result = {"invalid": invalid}
    return result


def _messages(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, int | None, DataFrame | None]:
    """The stream, the number of messages as the batch reader counts them, and expected counts if given.

    A topic that is still being written to has no fixed number; it needs expected counts.
    """
    options = json.loads(args.options)
    common = {"format": args.format, "start": args.start, "options": options}
    stream = read_messages(spark, args.path, max_files=args.max_files, max_bytes=args.max_bytes, **common)
    expected = args.expected and read_snapshot_text(spark, args.expected).select("event_type", "event_count")
    if expected:
        return stream, None, expected
    return stream, read_messages(spark, args.path, streaming=False, **common).count(), None


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="eventflow")
    parser.add_argument("--shuffle-partitions", type=int, help="about the cores of the cluster; a stream keeps its first value")
    commands = parser.add_subparsers(dest="job", required=True)

    generate = commands.add_parser("generate", help="write test messages and print their expected digest")
    generate.add_argument("--path")
    generate.add_argument("--count", type=int, default=1000)
    generate.add_argument("--scenario", default="0")
    generate.add_argument("--topic")
    generate.add_argument("--format", default="text")
    generate.add_argument("--options", default="{}", help="JSON object of sink options")

    def job(name: str, text: str, timeout: float) -> argparse.ArgumentParser:
        added = commands.add_parser(name, help=text)
        added.add_argument("--path")
        added.add_argument("--out", required=name != "partitions")
        added.add_argument("--timeout", type=float, default=timeout)
        added.add_argument("--digest", default=jobs.MULTISET, choices=[jobs.CANONICAL, jobs.MULTISET])
        return added

    def streaming(added: argparse.ArgumentParser) -> argparse.ArgumentParser:
        added.add_argument("--format", default="text")
        added.add_argument("--start", default="earliest")
        added.add_argument("--options", default="{}", help="JSON object of source options")
        added.add_argument("--max-files", type=int, help="most files of a micro-batch")
        added.add_argument("--max-bytes", type=int, help="most bytes of a micro-batch")
        added.add_argument("--expected", help="lines key<TAB>count to compare with; else the messages are counted")
        return added

    stream = streaming(job("stream-counts", "count a message stream", 120))
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--mode", default="update", choices=["complete", "update"])

    streaming(job("compare", "the same messages as a stream and as a batch", 120))
    streaming(job("pipeline", "stream counts, summarised by the batch stage", 90))

    batch = job("batch-summary", "summarise an event CSV", 120)
    batch.add_argument("--expected", help="a summary CSV to compare with")
    batch.add_argument("--single-file", action="store_true", help="one file, written by one task")

    partitions = job("partitions", "compare shuffle partition counts on an event CSV", 90)
    partitions.add_argument("--count", type=int, required=True)
    partitions.add_argument("--baseline", type=int, default=jobs.BASELINE_PARTITIONS)
    partitions.add_argument("--expected", help="a summary CSV to compare with, besides the baseline's result")
    partitions.add_argument("--at-most", type=int, default=jobs.MOST_PARTITIONS)

    everything = commands.add_parser("run-all", help="run the jobs on generated events and write the summary")
    everything.add_argument("--scenarios", help="ids such as 1,2,3")
    everything.add_argument("--timeout", type=float, default=120)
    everything.add_argument("--count", type=int, default=1000)
    everything.add_argument("--out")

    validate = commands.add_parser("validate", help="check <path>/<submission>/result.json")
    validate.add_argument("--path", required=True)
    return parser


if __name__ == "__main__":
    sys.exit(main())
