import random

import pytest
from pyspark.sql import functions as F

from eventflow.operators.hashtree import (
    HashTree, bits_for, build_tree, leaf_of, rows_in_leaves, tree_diff, unequal_leaves,
)

SCHEMA = "k long, g string, v long, t string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def some_rows(seed, n=3000):
    random.seed(seed)
    return [(random.randrange(n), random.choice(["a", "b", None]), random.choice([None, 1, 2]), random.choice(["", None, "x"])) for _ in range(n)]


def slow(left, right):
    """Status and rows of each side per key, after equal rows have cancelled out."""
    surplus = {}
    for rows, sign in ((left, 1), (right, -1)):
        for row in rows:
            surplus[row] = surplus.get(row, 0) + sign
    keys = {}
    for row, n in surplus.items():
        if n:
            counted = keys.setdefault(row[:2], [0, 0])
            counted[n < 0] += abs(n)
    return {k: ("right_only" if not a else "left_only" if not b else "different", a, b) for k, (a, b) in keys.items()}


def found(diff):
    return {(r.k, r.g): (r.status, r.left_rows, r.right_rows) for r in diff.collect()}


@pytest.mark.parametrize("rows_per_leaf", [1, 100, 10**6])
def test_difference_is_that_of_all_rows(spark, rows_per_leaf):
    left = some_rows(1)
    right = [r for r in left if random.random() > 0.02] + [(r[0], r[1], 9, r[3]) for r in left[:40]] + left[50:60] * 3
    diff = tree_diff(table(spark, left), table(spark, right), ["k", "g"], ["v", "t"], rows_per_leaf=rows_per_leaf)
    assert found(diff) == slow(left, right)


def test_values_of_both_sides(spark):
    left, right = [(1, "a", 5, None), (2, None, 1, "x"), (3, "b", 1, "x")], [(1, "a", None, None), (3, "b", 1, "x"), (4, "b", 0, "")]
    rows = tree_diff(table(spark, left), table(spark, right), ["k", "g"], ["v", "t"]).orderBy("k").collect()
    assert [(r.k, r.left_v, r.left_t, r.right_v, r.right_t, r.status) for r in rows] == [
        (1, 5, None, None, None, "different"), (2, 1, "x", None, None, "left_only"), (4, None, None, 0, "", "right_only"),
    ]


def test_equal_and_empty_tables(spark):
    rows = some_rows(2)
    assert tree_diff(table(spark, rows), table(spark, rows[::-1]), ["k", "g"], ["v", "t"]).count() == 0
    assert tree_diff(table(spark, []), table(spark, []), ["k", "g"], ["v", "t"]).count() == 0
    assert found(tree_diff(table(spark, rows[:9]), table(spark, []), ["k", "g"], ["v", "t"])) == slow(rows[:9], [])
    assert found(tree_diff(table(spark, []), table(spark, rows[:9]), ["k", "g"], ["v", "t"])) == slow([], rows[:9])


def test_equal_leaves_are_not_looked_at(spark):
    """Of 20,000 rows in 256 leaves, only those that share a leaf with one of three changes are read again."""
    left = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    right = left.withColumn("v", F.when(F.col("k").isin(5, 700, 19_999), -1).otherwise(F.col("v")))
    trees = [build_tree(t, ["k"], ["v"], 8) for t in (left, right)]
    leaves = unequal_leaves(*trees)
    changed = left.where(F.col("k").isin(5, 700, 19_999)).select(leaf_of(["k"], 8).alias("leaf")).distinct()
    assert {r.leaf for r in leaves.collect()} == {r.leaf for r in changed.collect()}
    assert 3 <= rows_in_leaves(left, ["k"], 8, leaves).count() < 3 * 20_000 / 256 * 2


def test_upper_nodes_are_sums_and_trees_are_kept(spark, folder):
    tree = build_tree(table(spark, some_rows(3)), ["k", "g"], ["v", "t"], 8)
    for level in range(2):
        below = tree.level(level + 1).groupBy((F.col("node") / 16).cast("bigint").alias("node")).agg(F.sum("rows").alias("n"), F.sum("h0_0").alias("h"))
        assert sorted(map(tuple, tree.level(level).select("node", "rows", "h0_0").collect())) == sorted(map(tuple, below.collect()))
    tree.write(f"{folder}/tree")
    kept = HashTree.read(spark, f"{folder}/tree", ["k", "g"], ["v", "t"], 8)
    assert unequal_leaves(kept, build_tree(table(spark, some_rows(3)[::-1]), ["k", "g"], ["v", "t"], 8)).count() == 0
    assert unequal_leaves(kept, build_tree(table(spark, some_rows(4)), ["k", "g"], ["v", "t"], 8)).count() == 256


def test_refuses_what_cannot_be_compared(spark):
    rows = table(spark, some_rows(5, 10))
    with pytest.raises(ValueError):
        tree_diff(rows, rows.withColumn("v", F.col("v").cast("int")), ["k"], ["v"])
    with pytest.raises(ValueError):
        unequal_leaves(build_tree(rows, ["k"], ["v"], 0), build_tree(rows, ["k"], ["v"], 4))


def test_sizes():
    assert [bits_for(n) for n in (0, 4096, 4097, 65536, 65537, 10**7, 10**15)] == [0, 0, 4, 4, 8, 12, 24]
