import json
import os
import random

import pytest
from pyspark.sql import functions as F

from eventflow import __main__ as command_line
from eventflow.operators.summary import grouped_summary
from eventflow.plans import jobs
from eventflow.sinks.tables import publish_csv, write_messages
from eventflow.sources import generators
from eventflow.sources.delimited import bad_rows, good_rows, read_event_csv
from eventflow.sources.messages import read_messages


@pytest.fixture()
def landing(spark, folder):
    write_messages(generators.messages(generators.indices(spark, 1000)), f"{folder}/landing")
    return f"{folder}/landing"


def expected(spark, n):
    return generators.expected_counts(spark.range(1).select(F.lit(n).cast("bigint").alias("n")))


def table(folder, rows=10_000, seed=42, high=100):
    rng = random.Random(seed)
    with open(f"{folder}/events.csv", "w") as f:
        f.write("event_type,value,timestamp\n")
        f.writelines(f"event_type_{i % 5},{rng.randint(1, high)},{1700000000 + i}\n" for i in range(rows))
    return f"{folder}/events.csv"


def test_stream_counts(spark, folder, landing):
    record = jobs.stream_counts(spark, read_messages(spark, landing), f"{folder}/out", f"{folder}/c", expected(spark, 1000), digest=jobs.CANONICAL)
    assert record["passed"] and record["events_injected"] == 1000 and record["processing_latency_ms"] > 0
    assert record["output_sha256"] == "f6ff1613256f362856bf797e26bb1093ff8bb5013ffc922e98462f90cd576faa"
    wrong = jobs.stream_counts(spark, read_messages(spark, landing), f"{folder}/2", f"{folder}/c2", expected(spark, 1001))
    assert not wrong["passed"] and wrong["digest"] == "multiset"
    short = jobs.stream_counts(spark, read_messages(spark, landing), f"{folder}/3", f"{folder}/c3", injected=1001)
    assert not short["passed"] and short["expected_sha256"] is None and short["events_counted"] == 1000
    with pytest.raises(ValueError, match="not checked by itself"):
        jobs.stream_counts(spark, read_messages(spark, landing), f"{folder}/4", f"{folder}/c4")


def test_batch_summary(spark, folder):
    record = jobs.batch_summary(spark, table(folder), f"{folder}/out/result.csv", single_file=True, digest=jobs.CANONICAL)
    assert record["passed"] and record["expected_sha256"] is None
    assert (record["rows_read"], record["rows_processed"], record["rows_rejected"]) == (10_000, 10_000, 0)
    assert record["output_sha256"] == "55b1f846166943d0bfc850490f97beb4e4c31821abdfea2ad77db05674e8e2df"
    lines = open(f"{folder}/out/result.csv").read().splitlines()
    assert lines[0] == "event_type,total_value,event_count,max_timestamp"
    assert lines[1] == "event_type_0,102167,2000,1700009995" and len(lines) == 6
    assert sorted(n for n in os.listdir(f"{folder}/out") if not n.startswith(".")) == ["result.csv", "result.csv_quarantine"]


def test_every_row_of_a_batch_is_accounted_for(spark, folder):
    with open(f"{folder}/events.csv", "w") as f:
        f.write("event_type,value,timestamp\nx,1,1700000000\nx,,1700000009\nx,bad,1700000010\ny,5,1700000001,EXTRA\ny,6\n")
    record = jobs.batch_summary(spark, f"{folder}/events.csv", f"{folder}/result.csv", single_file=True)
    assert record["passed"]
    assert (record["rows_read"], record["rows_processed"], record["rows_rejected"]) == (5, 2, 3)
    assert open(f"{folder}/result.csv").read().splitlines()[1:] == ["x,1,2,1700000009"]
    kept = spark.read.json(f"{folder}/result.csv_quarantine").collect()
    assert sorted((r.event_type, r.bad_fields) for r in kept) == [("x", ["value"]), ("y", ["<line>"]), ("y", ["<line>"])]
    assert sorted(r.line for r in kept) == ["x,bad,1700000010", "y,5,1700000001,EXTRA", "y,6"]
    assert {r.file.rsplit("/", 1)[1] for r in kept} == {"events.csv"}
    assert record["shuffle_bytes"] > 0 and 0 < record["shuffle_partitions_run"] <= record["shuffle_partitions_used"]


def test_partitions_count_what_they_reject(spark, folder):
    with open(f"{folder}/events.csv", "w") as f:
        f.write("event_type,value,timestamp\nx,1,1700000000\nx,bad,1700000010\ny,6\n")
    record = jobs.compare_partitions(
        spark, lambda s: read_event_csv(s, f"{folder}/events.csv"), jobs.summary_of_good_rows, 2, 4, runs=1
    )
    assert record["passed"] and (record["rows_read"], record["rows_processed"], record["rows_rejected"]) == (3, 1, 2)
    assert record["shuffle_partitions_run"] == 2 and record["shuffle_bytes"] > 0


def test_rejected_text_is_what_was_read(spark, folder):
    lines = ["a,n12,3", "b,1,2,EXTRA", "c, 4 x,5", '"d,e",z,1', "f", ",q,"]
    with open(f"{folder}/events.csv", "w") as f:
        f.write("event_type,value,timestamp\ngood,1,2\n" + "\n".join(lines) + "\n")
    rows = bad_rows(read_event_csv(spark, f"{folder}/events.csv")).collect()
    assert sorted(r.line for r in rows) == sorted(lines)


def test_results_are_published_as_ordered_parts(spark, folder):
    frame = spark.range(200).select(F.format_string("k%03d", "id").alias("event_type"), "id")
    assert publish_csv(frame.repartition(5), f"{folder}/large") == 200
    read = [
        line.split(",")[0]
        for name in sorted(n for n in os.listdir(f"{folder}/large") if n.startswith("part-"))
        for line in open(f"{folder}/large/{name}").read().splitlines()
        if not line.startswith("event_type,")
    ]
    assert read == [f"k{i:03d}" for i in range(200)]
    assert publish_csv(frame.limit(0), f"{folder}/empty.csv", single_file=True) == 0
    assert open(f"{folder}/empty.csv").read() == "event_type,id\n"


def test_compare_stream_batch(spark, folder, landing):
    record = jobs.compare_stream_batch(spark, landing, f"{folder}/work", digest=jobs.CANONICAL, max_files=1)
    assert record["passed"] and record["events_count"] == 1000 and record["latency_ratio"] >= 0
    assert record["spark_output_sha256"] == "af6383ba78c36e0babe7078be7f11a8d90291730fee7b583c21e0e5745f83904"


def test_compare_partitions(spark, folder):
    path = table(folder, 50_000, 2024, 1000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    source = lambda s: good_rows(read_event_csv(s, path))
    record = jobs.compare_partitions(spark, source, grouped_summary, 4, 20, runs=1, digest=jobs.CANONICAL)
    assert record["rows_processed"] == 50_000
    assert record["passed"] and record["shuffle_partitions_used"] == 4 and record["speedup_factor"] > 0
    assert record["output_sha256"] == "9d4b341869b2fa7b105ff2192c923c2de5f41775215b45c0ce98e7f98635bb72"
    assert not jobs.compare_partitions(spark, source, grouped_summary, 9, 10, runs=1)["passed"]
    assert jobs.compare_partitions(spark, source, grouped_summary, 9, 10, at_most=9, runs=1)["passed"]

    def fails_at_baseline(session):
        if jobs.shuffle_partitions(session) == 10:
            raise RuntimeError("no resources")
        return source(session)

    # Nothing to compare with is no pass; a result of its own to compare with is enough.
    record = jobs.compare_partitions(spark, fails_at_baseline, grouped_summary, 4, 10, runs=1)
    assert not record["passed"] and (record["baseline_time_ms"], record["speedup_factor"]) == (-1, 0)
    right = grouped_summary(source(spark))
    assert jobs.compare_partitions(spark, fails_at_baseline, grouped_summary, 4, 10, runs=1, expected=right)["passed"]
    wrong = right.withColumn("event_count", F.col("event_count") + 1)
    assert not jobs.compare_partitions(spark, source, grouped_summary, 4, 10, runs=1, expected=wrong)["passed"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_pipeline(spark, folder):
    write_messages(generators.messages(generators.indices(spark, 2000)), f"{folder}/landing")
    record = jobs.pipeline(spark, read_messages(spark, f"{folder}/landing"), f"{folder}/work", expected(spark, 2000), digest=jobs.CANONICAL)
    assert record["passed"] and record["events_injected"] == 2000
    assert record["flink_output_sha256"] == "eb395e4aab6aa623087308a8aeed3854b5450d134a37b3038d46d0b1bdbe9367"
    assert record["spark_output_sha256"] == "bb68c7a165e1a9b53f602d8abd6814036a9b51f5a3f024c934371f5fa7295c3c"


def test_time_limits(spark, folder):
    slow = lambda s: s.range(40).repartition(4).select(F.expr("java_method('java.lang.Thread', 'sleep', 2000L)").alias("event_type"))
    with pytest.raises(TimeoutError):
        with jobs._limit(spark, 1.5):
            slow(spark).write.format("noop").mode("overwrite").save()
    assert spark.range(3).count() == 3


def test_run_all_and_failures(spark, folder, monkeypatch):
    def fails(*args, **kwargs):
        raise TimeoutError("too slow")

    monkeypatch.setattr(jobs, "pipeline", fails)
    totals = jobs.run_all(spark, folder, ["2", "05", "nonsense"], n=100)
    assert (totals["scenarios_passed"], totals["scenarios_total"]) == (1, 2)
    summary = json.load(open(f"{folder}/results/result.json"))
    assert [(s["id"], s["passed"], s.get("error")) for s in summary["scenarios"]] == [("02", True, None), ("05", False, "timeout")]
    assert summary["penalty_ms"] == summary["scenarios"][1]["elapsed_ms"]


def test_command_line(spark, folder, monkeypatch, capsys):
    monkeypatch.setattr(command_line, "build_session", lambda *a, **k: spark)
    monkeypatch.setattr(spark, "stop", lambda: None, raising=False)

    def call(*args):
        code = command_line.main(list(args))
        return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    code, generated = call("generate", "--path", f"{folder}/landing", "--count", "1000")
    assert code == 0 and generated["sha256_of_expected_output"].startswith("f6ff1613")
    code, record = call(
        "stream-counts", "--path", f"{folder}/landing", "--out", f"{folder}/o", "--checkpoint", f"{folder}/c", "--digest", "canonical"
    )
    assert code == 0 and record["output_sha256"] == generated["sha256_of_expected_output"]
    code, record = call("batch-summary", "--path", table(folder, 100), "--out", f"{folder}/r.csv")
    assert code == 0 and record["rows_processed"] == 100
    code, record = call("batch-summary", "--path", table(folder, 100), "--out", f"{folder}/r2.csv", "--expected", f"{folder}/r.csv")
    assert code == 0 and record["expected_sha256"] == record["output_sha256"]
    code, record = call("compare", "--path", f"{folder}/landing", "--out", f"{folder}/compared", "--max-bytes", "1000")
    assert code == 0 and record["events_count"] == 1000 and record["digest"] == "multiset"
    with open(f"{folder}/wrong.txt", "w") as f:
        f.write("event_type_0\t1\n")
    code, record = call("compare", "--path", f"{folder}/landing", "--out", f"{folder}/compared2", "--expected", f"{folder}/wrong.txt")
    assert code == 1 and not record["passed"]
    with pytest.raises(ValueError, match="unknown message format"):
        call("compare", "--path", f"{folder}/landing", "--out", f"{folder}/compared3", "--format", "letters")
    code, record = call("pipeline", "--path", f"{folder}/landing", "--out", f"{folder}/piped")
    assert code == 0 and record["events_injected"] == 1000
    code, record = call("partitions", "--path", table(folder, 100), "--count", "4", "--baseline", "6")
    assert code == 0 and record["rows_processed"] == 100
    os.makedirs(f"{folder}/submissions/ann")
    with open(f"{folder}/submissions/ann/result.json", "w") as f:
        f.write('{"scenarios_passed":0}')
    assert call("validate", "--path", f"{folder}/submissions") == (1, {"invalid": 1})
