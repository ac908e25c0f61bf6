"""Exact duplicates: frequent digests apart from the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import BLANKS, stored, text_or_empty

# A digest that at least one row in so many has is frequent. Counters per task: COUNTERS,
# several times 1 / SUPPORT, so that no frequent digest is missed.
SUPPORT = 1000
COUNTERS = 1 << 14
# Groups in which the counters of all tasks are merged before the last merge.
MERGES = 64


def _digest_rows(docs: DataFrame, carry: list[str], id_column: str, text_column: str) -> DataFrame:
    """One row per document, written once: number, length, digest and what is carried along."""
    text = text_or_empty(text_column)
    table = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried") if carry else F.lit(0).alias("carried"),
        F.col(id_column).alias("id"),
        F.char_length(text).cast("bigint").alias("length"),
        F.sha2(F.regexp_replace(text, BLANKS + "+", "").cast("binary"), 256).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stored(table, "digests")


def frequent_candidates(digests: DataFrame) -> DataFrame:
    """Digests that may be frequent, at most ``SUPPORT`` of them.

    Misra-Gries counters (Spark's frequent-items sketch) are kept per task and merged in
    two steps, so that the last merge reads ``MERGES`` sketches, however many tasks there are.
    """
    return (
        digests.select("digest", (F.spark_partition_id() % MERGES).alias("part"))
        .groupBy("part").agg(F.expr(f"approx_top_k_accumulate(digest, {COUNTERS})").alias("sketch"))
        # Grouped, since a task without rows would add a sketch without type, which cannot be merged.
        .withColumn("all", F.lit(0)).groupBy("all").agg(F.expr(f"approx_top_k_combine(sketch, {COUNTERS})").alias("sketch"))
        .select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {SUPPORT})")).alias("found"))
        .select(F.col("found.item").alias("digest"))
    )


def _winners(rows: DataFrame) -> DataFrame:
    """Per digest: the row that stays, and how many there are."""
    order = F.struct(
        (-F.col("length")).alias("shorter"), F.col("id").isNull().alias("no_id"), "id", "row"
    )
    return rows.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size")).select(
        "digest", "group_size", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row")
    )


def label_copies(
    docs: DataFrame, carry: list[str] | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Which row stays of each group of rows with equal text, white space left out.

    Returns a row per input row: ``carried`` (a struct of the columns named), id, row,
    digest, keep_id, group_size, kept. Of equal texts the longest original stays, then the
    smallest id (no id comes last), then, for rows equal in both, the first row read; so
    exactly one row of a group is kept. Null text is empty text, and all empty texts are
    equal. Very long texts are hashed whole. An empty table gives an empty result. Other columns
    are not looked at.

    Digests that more than one row in ``SUPPORT`` has are found by Misra-Gries counters and
    verified by exact counting; their winners, at most ``SUPPORT`` rows, are broadcast, so
    these rows are never shuffled. The others are grouped with partial aggregation and
    joined with their winners.
    """
    return _decide(_digest_rows(docs, carry or [], id_column, text_column))


def _decide(rows: DataFrame) -> DataFrame:
    digests = rows.drop("carried")
    total = digests.count()
    candidates = stored(frequent_candidates(digests), "candidates")
    # At most SUPPORT candidates, by the sketch's estimate; their groups merge on the map side.
    verified = _winners(digests.join(F.broadcast(candidates), "digest"))
    heavy = stored(verified.where(F.col("group_size") * SUPPORT >= total), "heavy")
    light = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    winners = _winners(light.drop("carried"))
    both = rows.join(F.broadcast(heavy), "digest").unionByName(light.join(winners, "digest"))
    return both.withColumn("kept", F.col("row") == F.col("keep_row")).drop("keep_row", "length")


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with their columns. See ``label_copies``.

    Texts are not moved if few rows go; else they are shuffled once, by row number.
    """
    rows = _digest_rows(docs, docs.columns, id_column, text_column)
    gone = _decide(rows.withColumn("carried", F.lit(0))).where(~F.col("kept")).select("row")
    return rows.join(gone, "row", "left_anti").select("carried.*")
