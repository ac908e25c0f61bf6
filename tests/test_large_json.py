import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventflow.operators.validate import all_violations, large_violations
from eventflow.session import setting
from eventflow.sources.large_json import Cutter, _pieces, _ranges, _summaries, read_large_documents


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def names(column):
    return F.regexp_extract(column, r"([^/]+)$", 1)


def read(spark, folder, range_bytes):
    """Small ranges: the files are cut into many, wherever it hits."""
    with setting(spark, "spark.sql.files.maxPartitionBytes", str(range_bytes)), setting(spark, "spark.sql.files.openCostInBytes", "0"):
        found = read_large_documents(spark, f"{folder}/*.json")
        documents = {r.document: r for r in found.documents.withColumn("document", names("document")).collect()}
        rows = found.elements.withColumn("document", names("document")).collect()
        return found, documents, rows


VALUES = ["", "a", '"', "\\", "}", '{"x":1}', "},{", "]", "é文🙂", "\n", "\\\"}", "a,b", "[1,2"]


def some_value(depth=0):
    kind = random.randrange(6 if depth < 3 else 4)
    if kind == 0:
        return random.choice([None, True, False, 0, -1.5, 10**20])
    if kind in (1, 2, 3):
        return random.choice(VALUES) * random.choice([1, 1, 7])
    if kind == 4:
        return [some_value(depth + 1) for _ in range(random.randint(0, 4))]
    return {f"k{k}{random.choice(VALUES)}": some_value(depth + 1) for k in range(random.randint(0, 4))}


@pytest.mark.parametrize("range_bytes", [97])
def test_elements_are_those_of_the_parsed_document(spark, folder, range_bytes):
    random.seed(range_bytes)
    docs = []
    for k in range(25):
        doc = {f"m{j}": some_value() for j in range(random.randint(0, 6))} if k % 5 else [some_value(1) for _ in range(k)]
        docs.append(doc)
        put(folder, f"{k}.json", json.dumps(doc, ensure_ascii=k % 2 == 0, indent=random.choice([None, 1])) + random.choice(["", "\n"]))
    _, documents, rows = read(spark, folder, range_bytes)
    by_part = {}
    for r in rows:
        by_part.setdefault((r.document, r.part), []).append(r)
    for k, doc in enumerate(docs):
        found = documents[f"{k}.json"]
        assert found.readable
        outline, parts = json.loads(found.outline), [(None, doc)] if isinstance(doc, list) else doc.items()
        for name, value in parts:
            at = outline if name is None else outline[name]
            if not isinstance(value, (list, dict)):
                assert at == value
                continue
            part = by_part.pop((f"{k}.json", at[0] if isinstance(value, list) else at[""]))
            part.sort(key=lambda r: r.number)
            assert [r.number - r.part for r in part] == list(range(len(part)))
            texts = [r.text for r in part if r.text.strip()]
            opened, closed = "[]" if isinstance(value, list) else "{}"
            assert {r.bracket for r in part} == {opened}
            assert len(texts) == len(value) and json.loads(opened + ",".join(texts) + closed) == value
    assert not by_part


def test_what_is_no_document(spark, folder):
    texts = {
        "blank": " \n", "open": '{"a":[1,{"b":2}', "unclosed": '{"a":{"b":1}', "text": '{"a":"b}', "two": "{}{}",
        "more": '{"a":[]}]', "wrong": '{"a":[1}}', "bom": b"\xef\xbb\xbf{}", "fine": '{"a":[]}', "scalar": "5", "fewer": '{"a":1',
    }
    for name, text in texts.items():
        put(folder, f"{name}.json", text)
    _, documents, _ = read(spark, folder, 1 << 20)
    loads = {}
    for name, text in texts.items():
        try:
            json.loads(documents[f"{name}.json"].outline or "")
            loads[name] = documents[f"{name}.json"].readable
        except ValueError:
            loads[name] = False
    assert {n for n, good in loads.items() if good} == {"fine", "scalar"}


def summary(runs, **changes):
    failed = [r for r in runs if isinstance(r, dict) and r.get("passed") is False]
    fields = {
        "scenarios_passed": sum(isinstance(r, dict) and r.get("passed") is True for r in runs), "scenarios_total": len(runs),
        "penalty_ms": sum(r["elapsed_ms"] for r in failed if type(r.get("elapsed_ms")) is int), "note": {"a": [1, 2], "b": "}"}, "scenarios": runs,
    }
    return {k: v for k, v in (fields | changes).items() if v != "gone"}


@pytest.mark.parametrize("range_bytes", [700])
def test_violations_are_those_of_whole_documents(spark, folder, range_bytes):
    random.seed(5)
    documents = {}
    for k in range(14):
        runs = []
        for j in range(random.randint(0, 25)):
            run = {"id": f"{j:02d}", "name": random.choice(["x", 'a}"{']), "passed": random.random() < 0.5, "elapsed_ms": random.randint(0, 99)}
            if random.random() < 0.3:
                run[random.choice(["id", "passed", "elapsed_ms"])] = random.choice([None, 1, 1.5, "00", "03", True, [1], {"a": 1}])
            if random.random() < 0.1:
                del run[random.choice(list(run))]
            runs.append(run if random.random() < 0.95 else random.choice([5, None, "x", [run], [], {}]))
        changes = [{}, {}, {}, {"penalty_ms": 7}, {"scenarios_passed": True}, {"scenarios_total": "gone"}, {"scenarios": "none"}][k % 7]
        documents[f"{k}"] = json.dumps(summary(runs, **changes), indent=random.choice([None, 2]))
    documents |= {"array": "[{},{}]", "broken": '{"scenarios":[{"id":01}],"scenarios_passed":0}', "comma": documents["0"].replace("[", "[,", 1), "none": " "}
    for name, text in documents.items():
        put(folder, f"{name}.json", text)
    found, _, _ = read(spark, folder, range_bytes)
    got = large_violations(found.documents, found.elements)
    want = all_violations(spark.createDataFrame([(f"{n}.json", t) for n, t in documents.items()], "submission string, text string"))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got.withColumn("submission", names("submission")).collect())) == sorted(map(key, want.collect()))


def test_missing_documents(spark, folder):
    put(folder, "a.json", json.dumps(summary([])))
    found, _, _ = read(spark, folder, 100)
    path = found.documents.first().document
    expected = spark.createDataFrame([(path,), (path.replace("a.json", "b.json"),)], "document string")
    rows = large_violations(found.documents, found.elements, expected).collect()
    assert [(r.submission[-6:], r.rule) for r in rows] == [("b.json", 1)]


def test_many_tasks_share_one_document(spark, folder):
    runs = [{"id": f"{k}", "name": "x", "passed": k % 3 > 0, "elapsed_ms": k} for k in range(5000)]
    runs[4000]["id"] = "17"
    put(folder, "a.json", json.dumps(summary(runs, penalty_ms=1)))
    size = os.path.getsize(f"{folder}/a.json")
    found, _, _ = read(spark, folder, size // 20)
    assert found.elements.count() == 5000 + 2
    rows = {(r.rule, r.position, r.stated) for r in large_violations(found.documents, found.elements).collect()}
    assert rows == {(8, 4000, "17"), (12, None, "1")}


def test_cutter_goes_on_inside_a_part():
    cutter = Cutter(True, 3, 2)
    pieces = [*cutter(b'a,]"},{"b":[1,2]}],"c":{"d":'), cutter.rest()]
    assert [(p[0], p[2], p[3], p[4], p[5], p[6], p[7]) for p in pieces] == [
        ("element", 0, b'a,]"}', False, True, None, None), ("element", 1, b'{"b":[1,2]}', True, True, None, None),
        ("outline", 1, b'],"c":{', True, True, "{", 2), ("element", 2, b'"d":', True, False, "{", 2),
    ]


def batches_of(blocks, first, rows):
    names = ["a.json"] * len(blocks)
    given = {"in_text": [False] * len(blocks), "depth": [0] * len(blocks), "within": [2] * len(blocks), "closed": [False] * len(blocks)}
    every = pa.RecordBatch.from_pydict({"document": names, "first": first, "data": pa.array(blocks, pa.binary())} | given)
    return [every.slice(at, rows) for at in range(0, len(blocks), rows)]


def test_blocks_of_a_range_come_joined():
    blocks, first = [b"%d" % k for k in range(9000)], [0] * 4500 + [7] * 4500
    found = [(key, list(parts)) for key, parts in _ranges(iter(batches_of(blocks, first, 5000)))]
    assert [key for key, _ in found] == [("a.json", 0), ("a.json", 7)]
    assert [b"}".join(parts).split(b"}") for _, parts in found] == [blocks[:4500], blocks[4500:]]
    # A few values for thousands of blocks.
    assert all(len(parts) <= 4 for _, parts in found)


@pytest.mark.parametrize("rows", [1, 3, 10_000])
def test_pieces_do_not_depend_on_batches(rows):
    text = json.dumps({"a": [{"x": "}\\\"{"}, [1, {"b": ["]", {}]}], "é,"] * 50, "b": {"c": {"d": "\\"}, "e": []}, "f": 1}).encode()
    blocks = text.split(b"}")
    batches = batches_of(blocks, [0] * len(blocks), rows)
    whole = [*(cutter := Cutter(False, 0, 2))(text), cutter.rest()]
    found = [r for b in _pieces(iter(batches)) for r in b.to_pylist()]
    assert [(r["kind"], r["number"], r["text"], r["starts"], r["ends"], r["bracket"], r["part"]) for r in found] == [
        (p[0], *p[2:]) for p in whole
    ]
    assert len(found) == 150 + 2 + 3 and (cutter.depth, cutter.in_text) == (0, False)
    summary = next(_summaries(iter(batches))).to_pylist()[0]
    assert summary["bytes"] + summary["cuts"] == len(text) + 1 and (summary["depth_0"], summary["ends_0"]) == (-1, 0)
