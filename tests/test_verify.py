import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventflow.functions.text import escaped_line, render_line
from eventflow.operators.summary import global_total, grouped_summary, handoff, key_counts, row_count
from eventflow.operators.verify import (
    canonical_digest, completeness, digests_match, fingerprint, key_diff, multiset_digest, partition_rule,
)
from eventflow.sources import generators

SLOW = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def python_digest(texts, header=None):
    kept = [t.strip() for t in texts if t.strip()]
    kept = sorted(t for t in kept if not (header and t.startswith(header)))
    return hashlib.sha256(("\n".join(kept) + "\n").encode()).hexdigest()


# Golden digests of the count snapshot and of the narrow and second-stage results.
@pytest.mark.parametrize("n,digest", [
    (1000, "f6ff1613256f362856bf797e26bb1093ff8bb5013ffc922e98462f90cd576faa"),
    (2000, "eb395e4aab6aa623087308a8aeed3854b5450d134a37b3038d46d0b1bdbe9367"),
])
def test_golden_counts(spark, n, digest):
    counts = key_counts(generators.constant_table(generators.indices(spark, n)))
    line = render_line(F.col("event_type"), F.col("event_count"))
    assert canonical_digest(counts.select(line.alias("value"))).first().sha256 == digest


def test_golden_summaries(spark):
    render = lambda df: df.select(render_line(*[F.col(c) for c in df.columns], sep=",").alias("value"))
    narrow = grouped_summary(generators.constant_table(generators.indices(spark, 1000)), time=None)
    assert canonical_digest(render(narrow)).first().sha256 == "af6383ba78c36e0babe7078be7f11a8d90291730fee7b583c21e0e5745f83904"
    counts = key_counts(generators.constant_table(generators.indices(spark, 2000)))
    staged = grouped_summary(handoff(counts))
    assert canonical_digest(render(staged)).first().sha256 == "bb68c7a165e1a9b53f602d8abd6814036a9b51f5a3f024c934371f5fa7295c3c"


@SLOW
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab,\té中𐐀￿ \xa0")), max_size=6), max_size=30))
def test_canonical_digest_like_python(spark, texts):
    assert canonical_digest(lines(spark, texts)).first().sha256 == python_digest(texts)


def test_digest_of_nothing_and_of_a_header(spark):
    assert canonical_digest(lines(spark, [])).first().sha256 == hashlib.sha256(b"\n").hexdigest()
    texts = ["event_type,n", "b,2", " a,1 "]
    found = canonical_digest(lines(spark, texts), "event_type,").first()
    assert (found.line_count, found.sha256) == (2, python_digest(texts, "event_type,"))


def python_multiset(texts):
    shas = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    return "-".join(str(sum(int(h[a:a + 15], 16) for h in shas)) for a in range(0, 64, 15))


def test_escaped_lines_can_be_told_apart(spark):
    rows = [(None, "a"), ("a", None), ("", "a"), ("a,b", "c"), ("a", "b,c"), ("a\\", "b"), ("a\\,b", None), ("\\N", "a")]
    frame = spark.createDataFrame(rows, "x string, y string")
    found = frame.select(escaped_line(F.col("x"), F.col("y")).alias("v"))
    assert found.distinct().count() == len(rows)
    one, two = frame.limit(1), frame.filter("x = 'a' and y is null")
    assert fingerprint(one).first().digest != fingerprint(two).first().digest


@SLOW
@given(st.lists(st.text(max_size=5), max_size=30), st.randoms())
def test_multiset_digest(spark, texts, rng):
    shuffled = texts[:]
    rng.shuffle(shuffled)
    found = multiset_digest(lines(spark, shuffled)).first()
    assert (found.line_count, found.digest) == (len(texts), python_multiset(texts))
    if texts:
        assert multiset_digest(lines(spark, texts + texts[:1])).first().digest != found.digest


def test_digests_match(spark):
    a, b = (canonical_digest(lines(spark, t)) for t in (["x", "y"], ["y", "x "]))
    assert digests_match(a, b).first().passed
    assert not digests_match(a, canonical_digest(lines(spark, ["x"]))).first().passed


def test_key_diff_names_the_keys(spark):
    schema = "event_type string, event_count bigint"
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", None)], schema)
    right = spark.createDataFrame([("a", 1), ("b", 9), (None, 3), ("d", 4), ("c", None)], schema)
    rows = {r.event_type: r.status for r in key_diff(left, right, ["event_type"], ["event_count"]).collect()}
    assert rows == {"a": "same", "b": "different", None: "same", "c": "same", "d": "batch_only"}
    rows = {r.event_type: r.status for r in key_diff(right, left, ["event_type"], ["event_count"]).collect()}
    assert rows["d"] == "stream_only"


def test_completeness_counts_exactly(spark):
    counts = spark.createDataFrame([(f"t{i}", 10) for i in range(5)], "event_type string, event_count bigint")
    check = lambda n, df=counts: completeness(df, spark.range(1).select(F.lit(n).alias("n"))).first()
    assert (check(50).enough_rows, check(50).complete) == (True, True)
    assert not check(51).complete
    assert not check(49).complete
    nothing = check(0, counts.limit(0))
    assert (nothing.enough_rows, nothing.complete, nothing.total) == (False, True, 0)
    assert global_total(counts.limit(0)).first().total == 0
    assert row_count(counts).first().row_count == 5


def test_partition_rule(spark):
    runs = spark.createDataFrame([(8,), (9,), (None,)], "shuffle_partitions_used int")
    assert [r.partitions_ok for r in partition_rule(runs).collect()] == [True, False, False]
