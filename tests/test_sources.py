import datetime
import json
import os
import random
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from eventflow import schemas
from eventflow.functions.text import render_line
from eventflow.operators.filters import bad_integers, data_lines, select_runs
from eventflow.operators.summary import grouped_summary, key_counts, parse_messages
from eventflow.operators.verify import canonical_digest
from eventflow.sinks.tables import show_stream
from eventflow.sources import generators, records
from eventflow.sources.delimited import (
    accounting, bad_rows, good_rows, parse_event_lines, parse_snapshot_lines, read_event_csv, read_snapshot_text,
)
from eventflow.sources.messages import read_messages
from eventflow.sources.records import read_run_records, read_submissions


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return str(path)


def seeded_csv(path, seed, rows, high):
    rng = random.Random(seed)
    lines = [f"event_type_{i % 5},{rng.randint(1, high)},{1700000000 + i}" for i in range(rows)]
    return write(path, "event_type,value,timestamp\n" + "\n".join(lines) + "\n")


# Golden digests and totals of the two seeded tables.
@pytest.mark.parametrize("seed,rows,high,totals,digest", [
    (42, 10_000, 100, [102167, 102942, 101522, 102857, 103235],
     "55b1f846166943d0bfc850490f97beb4e4c31821abdfea2ad77db05674e8e2df"),
    (2024, 50_000, 1000, [5027930, 4991546, 5031559, 4983897, 5035036],
     "9d4b341869b2fa7b105ff2192c923c2de5f41775215b45c0ce98e7f98635bb72"),
])
@pytest.mark.parametrize("infer", [False, True])
def test_golden_tables(spark, folder, seed, rows, high, totals, digest, infer):
    path = seeded_csv(f"{folder}/events.csv", seed, rows, high)
    events = read_event_csv(spark, path, infer=infer)
    summary = grouped_summary(events if infer else good_rows(events))
    assert [f.dataType for f in summary.schema] == [f.dataType for f in schemas.SUMMARY]
    found = summary.orderBy("event_type").collect()
    assert [r.total_value for r in found] == totals
    assert [r.event_count for r in found] == [rows // 5] * 5
    line = render_line(*[F.col(c) for c in summary.columns], sep=",")
    assert canonical_digest(summary.select(line.alias("value"))).first().sha256 == digest


def test_csv_quarantine(spark, folder):
    path = write(
        f"{folder}/bad.csv",
        "timestamp,extra,event_type,value\n1,x,a,5\n2,x,a,\n3,x,b,seven\n-4,x,b,8\n5,x,,9\n6,x,c\n\n",
    )
    typed = read_event_csv(spark, path)
    rows = [tuple(r) for r in good_rows(typed).na.fill("").collect()]
    assert ("a", None, 2) in rows
    good = sorted(r for r in rows if r[1] is not None)
    assert good == [("", 9, 5), ("a", 5, 1), ("b", 8, -4)]
    bad = sorted((r.event_type, r.timestamp, r.bad_fields) for r in bad_rows(typed).collect())
    assert bad == [("b", 3, ["value"]), ("c", 6, ["<line>"])]
    assert grouped_summary(good_rows(typed)).filter("event_type = 'b'").first().max_timestamp == -4


def test_csv_files_of_different_headers(spark, folder):
    write(f"{folder}/t/a.csv", "event_type,value,timestamp\nx,7,1700000003\n")
    write(f"{folder}/t/b.csv", "event_type,timestamp,value\ny,1700000004,8\n")
    with pytest.raises(Exception, match="header"):
        read_event_csv(spark, f"{folder}/t").collect()
    rows = good_rows(read_event_csv(spark, f"{folder}/t", mixed_headers=True)).collect()
    assert sorted(tuple(r) for r in rows) == [("x", 7, 1700000003), ("y", 8, 1700000004)]


def test_csv_lines_with_too_many_or_too_few_fields(spark, folder):
    path = write(f"{folder}/e.csv", "event_type,value,timestamp\na,1,2\nb,1,2,EXTRA\nc,1\n")
    typed = read_event_csv(spark, path)
    assert [tuple(r) for r in good_rows(typed).collect()] == [("a", 1, 2)]
    assert sorted((r.event_type, r.bad_fields) for r in bad_rows(typed).collect()) == [("b", ["<line>"]), ("c", ["<line>"])]
    lines = spark.createDataFrame([("a,1,2",), ("b,1,2,EXTRA",), ("c,1",)], "value string")
    typed = parse_event_lines(lines)
    assert [r.event_type for r in good_rows(typed).collect()] == ["a"] and bad_rows(typed).count() == 2
    assert [tuple(r)[1:] for r in accounting(typed).orderBy("event_type").collect()] == [(1, 1, 0, 0), (1, 0, 0, 1), (1, 0, 0, 1)]


def test_csv_without_a_required_column(spark, folder):
    path = write(f"{folder}/no.csv", "event_type,timestamp\na,1\n")
    with pytest.raises(ValueError, match="missing columns \\['value'\\]"):
        read_event_csv(spark, path)
    assert read_event_csv(spark, write(f"{folder}/narrow.csv", "event_type,value\na,1\n"), schemas.NARROW_EVENT_TABLE).count() == 1


def test_csv_header_only_and_missing_file(spark, folder):
    empty = read_event_csv(spark, write(f"{folder}/empty.csv", "event_type,value,timestamp\n"))
    assert grouped_summary(good_rows(empty)).collect() == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_event_csv(spark, f"{folder}/nowhere.csv")


SNAPSHOT = "a\t3\nb\t4\t5\nc\nd\tx\n\n   \n\t7\n e\t8 \nf\t\ng\t1_0\n"


def test_snapshot_text(spark, folder):
    rows = read_snapshot_text(spark, write(f"{folder}/counts.txt", SNAPSHOT))
    expected = []
    for line in SNAPSHOT.splitlines():
        parts = line.strip().split("\t")
        if len(parts) == 2:
            try:
                expected.append((parts[0], int(parts[1])))
            except ValueError:
                expected.append((parts[0], None))
    assert sorted((r.event_type, r.event_count) for r in rows.collect()) == sorted(expected, key=str)


def test_bad_integer_policies(spark):
    rows = parse_snapshot_lines(spark.createDataFrame([("a\t3",), ("b\tx",), ("c\t4",)], "value string"))
    total = lambda how, df=rows: df.agg(bad_integers(how, F.col("event_count"), F.col("count_text"))).first()[0]
    assert total("skip") == 7
    assert total("zero") == 0
    with pytest.raises(Exception, match="not an integer: x"):
        total("fail")
    clean = rows.filter("event_count is not null")
    assert [total(h, clean) for h in ("skip", "zero", "fail")] == [7, 7, 7]
    assert [total(h, rows.limit(0)) for h in ("skip", "zero", "fail")] == [0, 0, 0]


def test_data_lines(spark):
    lines = spark.createDataFrame([("",), (" \t",), ("event_type,value",), (" event_type,x",), (" a,1 ",)], "value string")
    assert [r.value for r in data_lines(lines).collect()] == ["a,1"]


def test_generators_do_not_depend_on_partitions(spark):
    one = generators.event_table(generators.indices(spark, 1000).coalesce(1), 42, 1, 100)
    many = generators.event_table(generators.indices(spark, 1000).repartition(13), 42, 1, 100)
    assert sorted(one.collect()) == sorted(many.collect())
    values = [r.value for r in one.collect()]
    assert min(values) >= 1 and max(values) <= 100 and len(set(values)) > 90
    other = generators.event_table(generators.indices(spark, 1000), 43, 1, 100)
    assert sorted(other.collect()) != sorted(one.collect())


@pytest.mark.parametrize("n", [0, 3, 1000, 1003, 2000])
def test_generated_counts_equal_closed_form(spark, n):
    counted = key_counts(parse_messages(generators.messages(generators.indices(spark, n))))
    total = spark.range(1).select(F.lit(n).cast("bigint").alias("n"))
    expected = {r.event_type: r.event_count for r in generators.expected_counts(total).collect()}
    assert expected == {f"event_type_{i}": n // 5 + (i < n % 5) for i in range(5)}
    assert {r.event_type: r.event_count for r in counted.collect()} == {k: v for k, v in expected.items() if v}


def test_message_source_from_now(spark, folder):
    landing = f"{folder}/landing"
    write(f"{landing}/old.txt", "old:1\n")
    os.utime(f"{landing}/old.txt", (1_000_000_000, 1_000_000_000))
    write(f"{landing}/new.txt", "new:1\nnew:2\n")
    since = datetime.datetime.fromtimestamp(time.time() - 3600)
    for start, expected in (("earliest", 3), ("latest", 2)):
        stream = read_messages(spark, landing, start=start, since=since)
        name = f"messages_{start}"
        query = stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
        assert query.awaitTermination(60)
        assert spark.table(name).count() == expected
    with pytest.raises(ValueError, match="since"):
        read_messages(spark, landing, start="latest")
    with pytest.raises(ValueError, match="unknown message format"):
        read_messages(spark, landing, format="carrier pigeon")


def test_micro_batches_are_bounded(spark, folder):
    for i in range(4):
        write(f"{folder}/landing/{i}.txt", "a:1\n" * 100)
    sizes = []
    stream = read_messages(spark, f"{folder}/landing", max_bytes=500)
    sink = stream.writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count()))
    assert sink.trigger(availableNow=True).option("checkpointLocation", f"{folder}/c").start().awaitTermination(60)
    assert sizes == [100] * 4


def test_console_sink(spark, folder):
    write(f"{folder}/landing/a.txt", "a:1\n")
    query = show_stream(key_counts(parse_messages(read_messages(spark, f"{folder}/landing"))), f"{folder}/c")
    query.processAllAvailable()
    assert query.lastProgress is None or query.exception() is None
    query.stop()


def test_run_records(spark, folder):
    write(f"{folder}/scenario_01.json", json.dumps({"id": "01", "name": "n", "passed": True, "elapsed_ms": 5, "x": [1]}, indent=1))
    write(f"{folder}/scenario_02.json", '{"id": "02", "passed": tr')
    write(f"{folder}/scenario_03.json", '{"id": "03", "passed": true} x')
    write(f"{folder}/scenario_04.json", '{"id":"04","passed":false,"error":"timeout","elapsed_ms":7}')
    write(f"{folder}/scenario_05.json", '{"id":5,"passed":"yes","elapsed_ms":1.9,"name":"n"}')
    write(f"{folder}/scenario_06.json", '[1]')
    rows = {r.id: r for r in read_run_records(spark, f"{folder}/scenario_*.json").collect()}
    assert (rows["05"].passed, rows["05"].elapsed_ms, rows["05"].error) == (False, 0, "wrong type: id, passed, elapsed_ms")
    assert rows["06"].error == "unreadable"
    assert (rows["01"].passed, rows["01"].elapsed_ms, rows["01"].error) == (True, 5, None)
    assert [(rows[i].passed, rows[i].error) for i in ("02", "03")] == [(False, "unreadable")] * 2
    assert (rows["04"].passed, rows["04"].error, rows["04"].elapsed_ms) == (False, "timeout", 7)


def test_select_runs(spark):
    runs = spark.createDataFrame([("01",), ("02",), ("05",), ("x",)], "id string")
    pick = lambda *ids: [r.id for r in select_runs(runs, ids).orderBy("id").collect()]
    assert pick("1", "05", "5", "1") == ["01", "05"]
    assert pick("x", "002", "9") == ["02", "x"]


def test_submissions(spark, folder):
    write(f"{folder}/ann/result.json", '{"a":1}')
    write(f"{folder}/bob/result.json", "{\n}\n")
    expected = spark.createDataFrame([("ann",), ("eve",)], "submission string")
    assert sorted(r.submission for r in read_submissions(spark, folder).collect()) == ["ann", "bob"]
    rows = {r.submission: r.text for r in read_submissions(spark, folder, expected).collect()}
    assert rows == {"ann": '{"a":1}', "bob": "{\n}\n", "eve": None}


def test_submissions_are_read_by_tasks_that_are_dealt_names(spark, folder, monkeypatch):
    monkeypatch.setattr(records, "BLOCK_BYTES", 100)
    root = f"{folder}/a b%20c"
    texts = {f"n{n}": "x" * n for n in range(1, 100)} | {"x y%": '{"a":1}', "a#b?": "é\n", ".h": "[1]", "é": "{}", "_u": "1"}
    for name, text in texts.items():
        write(f"{root}/{name}/result.json", text)
    write(f"{root}/empty/result.json", "")
    write(f"{root}/nested/result.json/part-0", "no file")
    write(f"{root}/bare/conf/result.json", "too deep")
    write(f"{root}/result.json", "no submission")
    wanted = ["n1", "x y%", "x y%", "empty", "nested", "bare", "late", "", "result.json", "../a b%20c/n1", None, None]
    expected = spark.createDataFrame([(name,) for name in wanted], "submission string")
    rows = read_submissions(spark, root)
    assert sorted(map(tuple, rows.collect())) == sorted(texts.items())
    key = lambda row: (row[0] or "", row[0] is None)
    both = read_submissions(spark, f"{root}/", expected)
    want = texts | {name: None for name in wanted if name not in texts}
    assert sorted(map(tuple, both.collect()), key=key) == sorted(want.items(), key=key)
    # No file of a submission is in the plan, and names were met before any was opened.
    assert not [name for name in both.inputFiles() if name.endswith("result.json")]
    assert "Join" not in both._jdf.queryExecution().executedPlan().toString()


def test_submissions_of_several_folders_and_of_none(spark, folder):
    for name in ("one/ann", "two/bob"):
        write(f"{folder}/{name}/result.json", name)
    assert {r.submission: r.text for r in read_submissions(spark, f"{folder}/*").collect()} == {"ann": "one/ann", "bob": "two/bob"}
    for missing in (f"{folder}/three", folder, f"{folder}/one/ann/result.json"):
        with pytest.raises(AnalysisException):
            read_submissions(spark, missing)
