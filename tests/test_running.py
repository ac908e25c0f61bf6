import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventflow.operators import running
from eventflow.operators.running import nth_event, running_counts

SCHEMA = "k string, seq bigint"


def brute_force(rows, start=None):
    """Counts by key in sequence order, nulls first; equal numbers are interchangeable."""
    by_key = defaultdict(list)
    for key, seq in rows:
        by_key[key].append(seq)
    result = []
    for key, sequence in by_key.items():
        ordered = sorted(sequence, key=lambda s: (s is not None, s or 0))
        first = (start or {}).get(key, 0)
        result += [(key, s, first + i + 1) for i, s in enumerate(ordered)]
    return sorted(result, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def events(seed, n=600, spread=2**45, null_share=0.05):
    rng = random.Random(seed)
    pick = lambda: rng.choice([rng.randrange(50), rng.randrange(2**21), rng.randrange(-spread, spread)])
    return [
        (rng.choice(["hot", "hot", "a", "b", None]), None if rng.random() < null_share else pick())
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rows = events(seed)
    assert found(running_counts(spark.createDataFrame(rows, SCHEMA), ["k"], "seq")) == brute_force(rows)


def test_unique_numbers(spark):
    rows = [(f"k{i % 3}", i * 700_001) for i in range(500)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(running_counts(frame, ["k"], "seq", unique=True)) == brute_force(rows)


def test_starts_from_base(spark):
    rows = events(3, 200)
    base = {"hot": 1000, None: 7, "gone": 5}
    given = spark.createDataFrame(list(base.items()), "k string, event_count bigint")
    assert found(running_counts(spark.createDataFrame(rows, SCHEMA), ["k"], "seq", given)) == brute_force(rows, base)


def test_crowded_blocks(spark, monkeypatch):
    """A third of all events are copies of one, and blocks are small enough for that to matter."""
    monkeypatch.setattr(running, "BLOCK_BITS", 4)
    monkeypatch.setattr(running, "COPIES_PER_ROW", 7)
    rows = events(4, 300, 2**12) + [("hot", 77)] * 150 + [(None, None)] * 40
    assert found(running_counts(spark.createDataFrame(rows, SCHEMA), ["k"], "seq")) == brute_force(rows)


def test_without_rows_and_without_keys(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert running_counts(empty, ["k"], "seq").collect() == []
    rows = [("a", 3), ("b", 1), ("a", 2)]
    overall = running_counts(spark.createDataFrame(rows, SCHEMA), [], "seq")
    assert found(overall) == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("n", [1, 2, 17, 60, 10_000])
def test_nth_event(spark, n):
    rows = events(5, 400) + [("hot", 77)] * 50
    frame = spark.createDataFrame(rows, SCHEMA)
    expected = [(k, s) for k, s, c in brute_force(rows) if c == n]
    assert found(nth_event(frame, ["k"], "seq", F.col("seq"), n)) == sorted(expected, key=repr)
    overall = [s for _, s, c in brute_force([("all", s) for _, s in rows]) if c == n]
    assert [r.seq for r in nth_event(frame, [], "seq", F.col("seq"), n).collect() if len(overall)] == overall
