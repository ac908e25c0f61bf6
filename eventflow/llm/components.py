"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import stored


def smallest_reachable(links: DataFrame) -> DataFrame:
    """Per node that has links, the smallest node it can reach.

    ``links`` has two columns of nodes of one type. Returns ``node, root`` with root below
    node; smallest nodes of components are left out. Rounds of large and small stars: each
    connects the neighbours of a node to the smallest one, until nothing changes. The number of
    rounds grows with the logarithm of the longest path. Each round's links are written to
    the shared folder. Groups are never gathered: the smallest neighbour is an aggregate.
    """
    a, b = links.columns
    edges = stored(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        large = _large_star(edges)
        edges = stored(_small_star(large), "links")
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges


def _state(edges: DataFrame) -> tuple:
    """Changes whenever the links do: their number and sums of hashes."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")).alias("one"),
        F.sum(F.xxhash64("root", "node").cast("decimal(38,0)")).alias("two"),
    ).first()
    return row.n, row.one, row.two


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour, itself included."""
    both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
    return (
        both.join(least, "node").where(F.col("root") > F.col("node"))
        .select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and itself, are linked to the smallest of them."""
    least = edges.groupBy("node").agg(F.min("root").alias("least"))
    moved = edges.join(least, "node")
    return (
        moved.select(F.col("root").alias("node"), F.col("least").alias("root"))
        .unionByName(moved.select("node", F.col("least").alias("root")))
        .where(F.col("node") > F.col("root")).distinct()
    )
