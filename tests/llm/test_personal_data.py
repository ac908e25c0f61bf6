import random
import re
import time

import pytest
from pyspark.sql import functions as F
from tables import EDGES, documents

from eventflow.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = [int(c) for c in re.sub("[^0-9]", "", found)]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(digits[::-1])]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def slow(text):
    return [
        (kind, m.start(), m.end())
        for kind, rule in PLAIN.items() for m in re.finditer(rule, text or "") if passes(kind, m.group())
    ]


def check(spark, texts, ids=None):
    rows = pii.personal_data(documents(spark, texts, ids)).collect()
    got = sorted((str(r.doc_id), [(s.kind, s.start, s.end) for s in r.base]) for r in rows)
    assert got == sorted((str(i), slow(t)) for i, t in zip(ids or range(len(texts)), texts))
    for r in rows:
        assert set(r.base) <= set(r.spans)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_base_spans_are_those_of_the_plain_rules(spark, seed):
    random.seed(seed)
    parts = ["@", ".", "..", "-", " ", "+", "(", ")", "_", "a", "b.c", "1", "23", "456", "255", "256", "0", "é", "🙂",
             "4111111111111111", "4111 1111 1111 1112", "+1 (377) 555-0271", "1.2.3.4", "x@y.zz", "\n"]
    check(spark, ["".join(random.choices(parts, k=random.randint(0, 40))) for _ in range(300)])


def test_edges_and_repeated_rows(spark):
    texts = EDGES + ["a@b.c", "a@b.c", "1" * 30_000, "1 " * 20_000, "a" * 30_000 + "@", "x@" + "y." * 20_000 + "z", "+" * 1000]
    check(spark, texts, [*range(len(EDGES)), 50, 50, None, 60, 61, 62, 63])
    assert pii.personal_data(documents(spark, [])).count() == 0


def test_trees_add_what_looks_like_the_verified(spark):
    random.seed(5)
    digits = lambda n: "".join(random.choices("0123456789", k=n))
    texts = []
    for k in range(400):
        texts.append(f"call +1 ({digits(3)}) {digits(3)}-{digits(4)} now")
        texts.append(f"number {digits(16)} and 300.{k}.1.2 here")
    texts += [f"phone ({digits(3)}) {digits(3)}-{digits(4)} now" for _ in range(20)]
    rows = check(spark, texts)
    added = [s for r in rows for s in set(r.spans) - set(r.base)]
    for r in rows:
        ends = sorted((s.start, s.end) for s in set(r.spans) - set(r.base))
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert all(s.kind in pii.KINDS for s in added)


def test_chains_of_overlapping_spans_keep_all_that_fit(spark, monkeypatch):
    monkeypatch.setattr(pii, "_scored", lambda spans, trees: spans)
    given = [  # row, start, end, score
        (1, 0, 10, 0.9), (1, 8, 20, 0.7), (1, 18, 30, 0.6), (1, 29, 40, 0.8), (1, 40, 50, 0.6),
        (2, 0, 10, 0.6), (2, 5, 15, 0.9), (2, 12, 20, 0.7), (3, 4, 9, 0.6),
    ]
    rows = [(row, row, "phone", a, b, "x", "", "", False, None, False, score) for row, a, b, score in given]
    spans = spark.createDataFrame(
        rows, "row long, doc_id long, kind string, start long, end long, found string, left string, right string, "
        "base boolean, label double, overlaps boolean, score double",
    )
    found = pii.added(spans, pii.Judge(None, {"phone": 0.5})).collect()
    assert sorted((r.row, r.start) for r in found) == [(1, 0), (1, 29), (1, 40), (2, 5), (3, 4)]


def test_trees_and_thresholds_come_from_all_labelled_spans(spark, monkeypatch):
    """Of 60,000 labelled spans all count, each equal form as often as it occurs."""
    fitted = []
    train = pii.GBTClassifier.fit
    monkeypatch.setattr(pii.GBTClassifier, "fit", lambda self, rows: fitted.append(rows.select(self.getWeightCol())) or train(self, rows))
    spans = spark.range(60_000).select(
        F.col("id").alias("row"), F.lit("phone").alias("kind"), F.lit(0).alias("start"), F.lit(12).alias("end"),
        F.concat(F.lit("+"), F.lpad(F.col("id").cast("string"), 11, "1")).alias("found"),
        F.lit("call ").alias("left"), F.lit("").alias("right"), (F.col("id") % 2).cast("double").alias("label"),
    ).withColumn("found", F.when(F.col("label") == 0, F.concat("found", F.lit("a"))).otherwise(F.col("found")))
    judge = pii.fit(spans)
    held = spans.where(F.pmod(F.xxhash64("kind", "found", "left"), F.lit(pii.HELD_BACK)) == 0).count()
    assert fitted[0].agg(F.sum(fitted[0].columns[0])).first()[0] == 60_000 - held and judge.thresholds["phone"] >= 0.5


def test_luhn(spark):
    values = ["4111111111111111", "4111111111111112", "0", "", None, "79927398713"]
    found = spark.createDataFrame([(v,) for v in values], "v string").select(F.coalesce(pii.luhn(F.col("v")), F.lit(False)).alias("x"))
    assert [r.x for r in found.collect()] == [True, False, True, False, False, True]


def test_rows_of_one_id_are_redacted_each_by_itself(spark):
    texts = ["mail a@b.cc", "host 1.2.3.4 is up", "mail a@b.cc", "or x@y.zz", None]
    rows = pii.redact(documents(spark, texts, [1, 1, 1, None, None])).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == [
        ("1", "host [ip] is up"), ("1", "mail [email]"), ("1", "mail [email]"), ("None", ""), ("None", "or [email]"),
    ]


def test_many_spans_in_one_text(spark):
    """Spans of one text look back only, so a hundred thousand of them take seconds, not hours."""
    text = "\n".join(f"{k >> 16}.{k >> 8 & 255}.{k & 255}.9 up" for k in range(100_000))
    began = time.monotonic()
    row = pii.personal_data(documents(spark, [text, "a@b.cc"])).where("doc_id = 0").select(F.size("base").alias("n")).first()
    assert row.n == 100_000 and time.monotonic() - began < 180


def test_redaction(spark):
    rows = pii.redact(documents(spark, ["to a@b.cc and é 1.2.3.4!", None, "none"])).collect()
    assert {r.doc_id: r.text for r in rows} == {0: "to [email] and é [ip]!", 1: "", 2: "none"}
