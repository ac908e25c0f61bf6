"""Difference of two large tables by hash trees (VER-2, VER-7).

A leaf of the tree is a range of the keys' hash. It holds how many rows lie in it and sums over
the hashes of these rows, whatever their order. A node above holds the sums of its leaves, so a
tree is made by one pass over its table and rolled up from there. Two tables are compared from
the roots down, and only rows of leaves that differ are looked at again. A tree is a small table
of its own: kept beside a table, it lets a later comparison do without reading that table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.session import work_dir

ROWS_PER_LEAF = 4096
MOST_BITS = 24
# Each node has 2 ** FANOUT_BITS children.
FANOUT_BITS = 4
# A 64-bit hash is summed in parts of so many bits; sums fit a bigint for 2 ** 41 rows.
PART_BITS = 22
PARTS = [f"h{seed}_{at}" for seed in (0, 1) for at in range(0, 64, PART_BITS)]


@dataclass
class HashTree:
    """``nodes`` has ``level`` (0 is the root), ``node``, ``rows`` and the sums of hashes."""

    nodes: DataFrame
    keys: list[str]
    columns: list[str]
    bits: int

    @property
    def depth(self) -> int:
        return self.bits // FANOUT_BITS

    def level(self, number: int) -> DataFrame:
        return self.nodes.where(F.col("level") == number).drop("level")

    def write(self, path: str) -> None:
        self.nodes.write.mode("overwrite").parquet(path)

    @staticmethod
    def read(spark: SparkSession, path: str, keys: Sequence[str], columns: Sequence[str], bits: int) -> HashTree:
        return HashTree(spark.read.parquet(path), list(keys), list(columns), bits)


def bits_for(rows: int, rows_per_leaf: int = ROWS_PER_LEAF) -> int:
    """Bits of a leaf's number, so that leaves of evenly spread keys hold about so many rows."""
    wanted = math.ceil(math.log2(max(1, rows / rows_per_leaf)))
    return min(MOST_BITS, -(-wanted // FANOUT_BITS) * FANOUT_BITS)


def leaf_of(keys: Sequence[str], bits: int) -> Column:
    """Number of the leaf that a row's key lies in. Keys are exact values, no floating-point numbers."""
    if not bits:
        return F.lit(0).cast("bigint")
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def build_tree(table: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int) -> HashTree:
    """The tree of a table in one pass; sums combine on the map side, so hot keys do no harm.

    What moves is a row per leaf and task, and then a row per leaf and level. Nulls differ from
    every value; equal rows count as often as they come.
    """
    values = [*keys, *columns]
    # A hash skips nulls: which values are null is hashed with them.
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in values])
    hashed = table.select(
        leaf_of(keys, bits).alias("leaf"), *[F.xxhash64(F.lit(seed), nulls, *values).alias(f"h{seed}") for seed in (0, 1)]
    )
    mask = F.lit((1 << PART_BITS) - 1)
    parts = [
        F.sum(F.shiftrightunsigned(f"h{seed}", at).bitwiseAND(mask)).alias(f"h{seed}_{at}")
        for seed in (0, 1) for at in range(0, 64, PART_BITS)
    ]
    leaves = hashed.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), *parts)
    levels = F.sequence(F.lit(0), F.lit(bits // FANOUT_BITS))
    up = leaves.withColumn("level", F.explode(levels)).withColumn(
        "node", F.expr(f"shiftrightunsigned(leaf, {bits} - {FANOUT_BITS} * level)")
    )
    nodes = up.groupBy("level", "node").agg(*[F.sum(c).alias(c) for c in ("rows", *PARTS)])
    return HashTree(_stored(nodes, "hash-tree"), list(keys), list(columns), bits)


def unequal_leaves(a: HashTree, b: HashTree) -> DataFrame:
    """Leaves, as column ``leaf``, in which the tables differ.

    Nodes are compared level by level, and below an equal node no more. The walk ends at the
    first level without a difference, so equal tables cost one look at the roots.
    """
    if (a.keys, a.columns, a.bits) != (b.keys, b.columns, b.bits):
        raise ValueError("trees of different keys, columns or sizes cannot be compared")
    differing = None
    for level in range(a.depth + 1):
        left, right = a.level(level), b.level(level)
        if differing is not None:
            parents = differing.select(F.col("node").alias("parent"))
            left, right = (t.join(parents, F.shiftright("node", FANOUT_BITS) == F.col("parent"), "left_semi") for t in (left, right))
        same = F.lit(True)
        for c in ("rows", *PARTS):
            same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        joined = left.alias("a").join(right.alias("b"), F.col("a.node") == F.col("b.node"), "full_outer")
        differing = _stored(joined.where(~same).select(F.coalesce("a.node", "b.node").alias("node")), "nodes")
        if differing.isEmpty():
            break
    return differing.select(F.col("node").alias("leaf"))


def rows_in_leaves(table: DataFrame, keys: Sequence[str], bits: int, leaves: DataFrame) -> DataFrame:
    return table.withColumn("leaf", leaf_of(keys, bits)).join(leaves, "leaf", "left_semi").drop("leaf")


def tree_diff(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    names: tuple[str, str] = ("left", "right"),
    rows_per_leaf: int = ROWS_PER_LEAF,
) -> DataFrame:
    """The keys in which two tables differ: values of both sides, ``status``, and rows of each side.

    Both tables are read once for their trees, and the rows of unequal leaves once more; nothing
    else moves. These rows are not joined but counted, those of the one side against those of the
    other, so that equal rows cancel out and a key of many copies makes no pairs. Of a key
    with several rows left on a side the greatest is shown; ``<name>_rows`` tells how many there are.
    """
    a, b = names
    values = [*keys, *columns]
    types = [dict(t.select(*values).dtypes) for t in (left, right)]
    if types[0] != types[1]:
        raise ValueError(f"types differ: {types[0]} / {types[1]}")
    bits = bits_for(left.count(), rows_per_leaf)
    leaves = unequal_leaves(build_tree(left, keys, columns, bits), build_tree(right, keys, columns, bits))
    sides = [
        rows_in_leaves(table.select(*values), keys, bits, leaves).withColumn("_surplus", F.lit(sign))
        for table, sign in ((left, 1), (right, -1))
    ]
    rows = sides[0].unionByName(sides[1]).groupBy(*values).agg(F.sum("_surplus").alias("_surplus"))
    rows = rows.where(F.col("_surplus") != 0)
    shown, n = F.struct(*columns), F.col("_surplus")
    by_key = rows.groupBy(*keys).agg(
        F.max(F.when(n > 0, shown)).alias("_l"), F.max(F.when(n < 0, shown)).alias("_r"),
        F.sum(F.greatest(n, F.lit(0))).alias(f"{a}_rows"), F.sum(F.greatest(-n, F.lit(0))).alias(f"{b}_rows"),
    )
    status = (
        F.when(F.col(f"{b}_rows") == 0, F.lit(f"{a}_only")).when(F.col(f"{a}_rows") == 0, F.lit(f"{b}_only"))
        .otherwise(F.lit("different"))
    )
    return by_key.select(
        *keys, *[F.col(f"_l.{c}").alias(f"{a}_{c}") for c in columns], *[F.col(f"_r.{c}").alias(f"{b}_{c}") for c in columns],
        status.alias("status"), f"{a}_rows", f"{b}_rows",
    )


def _stored(table: DataFrame, purpose: str) -> DataFrame:
    path = work_dir(table.sparkSession, purpose)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
