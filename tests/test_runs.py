import json
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventflow import files
from eventflow.functions.json import parse_document
from eventflow.operators.runs import roll_up, summary_lines
from eventflow.operators.validate import RULES, all_violations, first_violations
from eventflow.sinks.records import append_run, write_run, write_submissions, write_summary
from eventflow.sources.records import read_run_records, read_submissions

SLOW = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def violations(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "submission int, text string")
    rows = first_violations(frame).orderBy("submission").collect()
    assert all(r.valid == (r.rule is None) and r.detail == RULES.get(r.rule) for r in rows)
    return [(r.rule, r.position) for r in rows]


def document(**changes):
    good = {
        "scenarios_passed": 1, "scenarios_total": 2, "penalty_ms": 7, "total_elapsed_ms": 12,
        "scenarios": [{"id": "01", "passed": True, "elapsed_ms": 5}, {"id": "02", "passed": False, "elapsed_ms": 7}],
    }
    good.update(changes)
    return json.dumps({k: v for k, v in good.items() if v is not ...})


def element(**changes):
    e = {"id": "02", "passed": False, "elapsed_ms": 7, **changes}
    return [{"id": "01", "passed": True, "elapsed_ms": 5}, {k: v for k, v in e.items() if v is not ...}]


CASES = [
    (document(), None), (None, 1), ("not json", 2), ("", 2), (document() + "]", 2), (document() + "}", 2),
    (document() + ',"x":1', 2), (document() + ",{}", 2), (document() + " \n", None), ("[]", 3), ("5", 3), ("null", 3),
    *[(document(**{f: ...}), 4) for f in ("scenarios_passed", "scenarios_total", "penalty_ms", "scenarios")],
    (document(scenarios={}), 5), (document(scenarios=None), 5), (document(scenarios=[5]), 6), (document(scenarios=[None]), 6),
    (document(scenarios=element(id=...)), 7), (document(scenarios=element(id=2)), 7), (document(scenarios=element(id=None)), 7),
    (document(scenarios=element(id="01")), 8),
    (document(scenarios=element(passed="yes")), 9), (document(scenarios=element(passed=...)), 9), (document(scenarios=element(passed=1)), 9),
    (document(scenarios=element(elapsed_ms=1.5)), 10), (document(scenarios=element(elapsed_ms=7.0)), 10),
    (document(scenarios=element(elapsed_ms=True)), 10), (document(scenarios=element(elapsed_ms=None)), 10),
    (document(scenarios=element(elapsed_ms=...)), 12), (document(scenarios=element(elapsed_ms=...), penalty_ms=0), None),
    (document(scenarios_passed=2), 11), (document(scenarios_passed=True), 11), (document(scenarios_passed=None), 11),
    (document(scenarios_passed=1.0), 11), (document(penalty_ms=8), 12), (document(penalty_ms=True), 12), (document(penalty_ms="7"), 12),
    (document(scenarios=[], scenarios_passed=0, penalty_ms=0), None), (document(scenarios_total="any"), None),
    (document(scenarios=element(elapsed_ms=2**70), penalty_ms=2**70), None), (document(scenarios=element(elapsed_ms=-7), penalty_ms=-7), None),
]


def test_one_document_per_rule(spark):
    found = violations(spark, [text for text, _ in CASES])
    assert [rule for rule, _ in found] == [rule for _, rule in CASES]
    assert all((position is not None) == (rule is not None and 6 <= rule <= 10) for rule, position in found)


# Faults of one element, by the rule they break.
FAULTS = {
    6: lambda e: 5, 7: lambda e: {**e, "id": 1}, 9: lambda e: {**e, "passed": "yes"}, 10: lambda e: {**e, "elapsed_ms": 1.5},
}


@SLOW
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 9)), min_size=1, max_size=8), st.data())
def test_the_first_of_several_faults(spark, runs, data):
    """Documents are built right, then damaged at known places; the first place tells the violation."""
    elements = [{"id": f"{k:02d}", "passed": p, "elapsed_ms": ms} for k, (p, ms) in enumerate(runs)]
    totals = {"scenarios_passed": sum(p for p, _ in runs), "penalty_ms": sum(ms for p, ms in runs if not p)}
    at = sorted(data.draw(st.sets(st.integers(0, len(runs) - 1), max_size=3)))
    rules = [data.draw(st.sampled_from([6, 7, 8, 9, 10])) for _ in at]
    wrong_total = data.draw(st.sampled_from([None, "scenarios_passed", "penalty_ms"]))
    broken = list(elements)
    for k, rule in zip(at, rules):
        # A repeated id needs an earlier element that still has it.
        rule = 7 if rule == 8 and (k == 0 or 0 in at) else rule
        broken[k] = {**elements[k], "id": "00"} if rule == 8 else FAULTS[rule](elements[k])
    rules = [7 if rule == 8 and (k == 0 or 0 in at) else rule for k, rule in zip(at, rules)]
    want = (rules[0], at[0]) if at else (None, None)
    if wrong_total:
        totals[wrong_total] += 1
        want = want if at else ({"scenarios_passed": 11, "penalty_ms": 12}[wrong_total], None)
    text = document(scenarios=broken, **totals)
    assert violations(spark, [text]) == [want]
    every = all_violations(spark.createDataFrame([(1, text)], "submission int, text string"))
    found = {(r.rule, r.position) for r in every.collect()}
    assert set(zip(rules, at)) <= found and (want == (None, None)) == (not found)


def test_a_long_document(spark):
    many = [{"id": str(i), "passed": True} for i in range(5000)]
    texts = [document(scenarios=many, scenarios_passed=5000, penalty_ms=0),
             document(scenarios=many + many[4000:4001] + many[:1], scenarios_passed=5002, penalty_ms=0)]
    assert violations(spark, texts) == [(None, None), (8, 5000)]


def test_roll_up(spark):
    runs = spark.createDataFrame(
        [("s", True, 5), ("s", False, 7), ("s", None, 2), ("s", False, None), ("t", True, 1)],
        "submission string, passed boolean, elapsed_ms bigint",
    )
    rows = {r.submission: tuple(r)[1:] for r in roll_up(runs, ["submission"]).collect()}
    assert rows == {"s": (1, 4, 9, 14), "t": (1, 1, 0, 1)}
    assert tuple(roll_up(runs.limit(0)).first()) == (0, 0, 0, 0)


def test_summary_document(spark, folder):
    for i in range(1, 30):
        record = {"id": f"{i:02d}", "name": 'a "quoted" name', "passed": i % 3 > 0, "elapsed_ms": i}
        write_run(spark, f"{folder}/results", record)
    with open(f"{folder}/results/scenario_77.json", "w") as f:
        f.write("{broken")
    runs = read_run_records(spark, f"{folder}/results/scenario_*.json")
    write_summary(runs, f"{folder}/result.json", single_file=True)
    text = open(f"{folder}/result.json").read()
    doc = json.loads(text)
    assert (doc["scenarios_passed"], doc["scenarios_total"]) == (20, 30)
    assert [e["id"] for e in doc["scenarios"]] == [f"{i:02d}" for i in range(1, 30)] + ["77"]
    assert doc["penalty_ms"] == sum(i for i in range(1, 30) if i % 3 == 0)
    assert doc["scenarios"][-1] == {"id": "77", "error": "unreadable", "passed": False}
    assert violations(spark, [text]) == [(None, None)]


def test_repeated_ids_give_a_document_that_parses(spark, folder):
    rows = [("01", True, 1, '{"id":"01","a":1}'), ("01", True, 1, '{"id":"01","a":1}'), ("01", False, 2, '{"id":"01"}'), ("02", True, 3, '{"id":"02"}')]
    runs = spark.createDataFrame(rows, "id string, passed boolean, elapsed_ms bigint, record_json string")
    lines = summary_lines(runs).orderBy("section", "id", "place").collect()
    assert len(json.loads("".join(r.line for r in lines))["scenarios"]) == 4


def test_all_violations(spark):
    text = document(scenarios=[5, {"id": 1, "passed": "x", "elapsed_ms": 1.5}, *element(id="01")], scenarios_passed=9, penalty_ms=8)
    rows = all_violations(spark.createDataFrame([(1, text), (2, None), (3, document())], "submission int, text string")).collect()
    found = sorted((r.submission, r.rule, r.position, r.stated, r.computed) for r in rows if r.rule != 2)
    assert [f[:3] for f in found] == [
        (1, 6, 0), (1, 7, 1), (1, 8, 3), (1, 9, 1), (1, 10, 1), (1, 11, None), (1, 12, None), (2, 1, None)
    ]
    assert [(f[3], f[4]) for f in found if f[1] in (11, 12)] == [("9", "1"), ("8", "7")]


def test_documents_are_parsed_once_and_not_described_whole(spark, folder):
    spark.createDataFrame([(1, document())], "submission int, text string").write.parquet(folder + "/texts")
    for judge in (all_violations, first_violations):
        plan = judge(spark.read.parquet(folder + "/texts"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lengthOfJsonArray") == 1 and "schemaOfVariant(doc" not in plan


def test_submissions_are_put_in_place_by_tasks(spark, folder, monkeypatch):
    def refused(*_):
        raise AssertionError("a file moved by the driver")

    monkeypatch.setattr(files, "move", refused)
    root, given = f"{folder}/a b%20c", [("1", "one\ntwo"), ("x y%", "é"), (None, ""), ("null", None)]
    for changed in ("", "more"):
        rows = [(n, None if t is None else t + changed) for n, t in given]
        write_submissions(spark.createDataFrame(rows, "submission string, text string"), root)
        found = {r.submission: r.text for r in spark.read.text(f"{folder}/a b%20c/*/result.json", wholetext=True).selectExpr(
            "regexp_extract(_metadata.file_path, '([^/]+)/result.json$', 1) AS submission", "value AS text").collect()}
        assert found["1"] == "one\ntwo" + changed + "\n" and found["__HIVE_DEFAULT_PARTITION__"] == changed + "\n"
    assert read_submissions(spark, root).count() == len(found)


def test_submissions_that_are_there_keep_what_else_they_hold(spark, folder):
    root = f"{folder}/all"
    for name in ("1", "2"):
        os.makedirs(f"{root}/{name}/conf")
    for name in ("1/REPORT.md", "1/result.json", "1/.result.json.crc"):
        with open(f"{root}/{name}", "w") as f:
            f.write("old")
    os.makedirs(f"{root}/4")
    rows = [(str(n), f"{n}") for n in range(200)] + [("a/b", "x"), ("3", "3")]
    write_submissions(spark.createDataFrame(rows, "submission string, text string").repartition(7), root)
    assert sorted(os.listdir(root)) == sorted({n.split("/")[0] for n, _ in rows})
    assert sorted(os.listdir(f"{root}/1")) == ["REPORT.md", "conf", "result.json"] and os.listdir(f"{root}/4") == ["result.json"]
    assert sorted(os.listdir(f"{root}/2")) == ["conf", "result.json"]
    for name, text in rows:
        with open(f"{root}/{name}/result.json") as f:
            assert f.read() == text + "\n"


def test_append_run(spark, folder):
    for i in range(3):
        append_run(spark, f"{folder}/runs", {"id": str(i), "passed": True})
    rows = spark.read.text(f"{folder}/runs").select(parse_document("value").alias("v"))
    assert rows.count() == 3
