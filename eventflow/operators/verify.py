"""Result verification (VER-1 to VER-5, VER-7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.functions.text import escaped_row
from eventflow.operators.filters import data_lines

# Hexadecimal digits of a digest that are summed as one number, which fits into a bigint.
DIGITS = 15


def canonical_digest(lines: DataFrame, header_start: str | None = None) -> DataFrame:
    """SHA-256 of the stripped, non-blank lines of ``value`` in code-point order (VER-1, SRT-3).

    The digest is defined over one sorted text, so all lines meet in one task. It is for
    results as short as one text may be; ``multiset_digest`` takes tables of any size.
    """
    text = F.concat(F.array_join(F.sort_array(F.collect_list("value")), "\n"), F.lit("\n"))
    gathered = data_lines(lines, header_start).agg(F.count(F.lit(1)).alias("line_count"), text.alias("text"))
    return gathered.select("line_count", F.sha2("text", 256).alias("sha256"))


def multiset_digest(lines: DataFrame) -> DataFrame:
    """Order-insensitive digest of a result of any size: row count, and sums over each line's SHA-256."""
    return _summed(lines.select(F.sha2("value", 256).alias("hash")), 64)


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cheaper digest of a table: sums over the MD5 of each row's escaped line.

    Columns are taken by their text form; nulls, empty texts and separators inside a value
    all differ from each other.
    """
    return _summed(df.select(F.md5(escaped_row(df, columns)).alias("hash")), 32)


def _summed(hashes: DataFrame, length: int) -> DataFrame:
    """Row count and, for every ``DIGITS`` hexadecimal digits, the sum of that number over all rows.

    Sums combine on the map side, need no sort and, unlike an exclusive or, notice lines that
    appear twice. Each number is summed in three parts of 20 bits, which stay in a bigint
    for 2**43 rows and avoid decimal arithmetic for every row. All digits are summed.
    """
    starts = range(1, length + 1, DIGITS)
    numbers = {s: F.conv(F.substring("hash", s, DIGITS), 16, 10).cast("bigint") for s in starts}
    parts = [
        F.coalesce(F.sum(F.shiftright(f"n{s}", shift).bitwiseAND(F.lit(0xFFFFF))), F.lit(0)).alias(f"n{s}_{shift}")
        for s in starts
        for shift in (0, 20, 40)
    ]

    def total(s: int) -> Column:
        wide = [F.col(f"n{s}_{shift}").cast("decimal(20,0)") * F.lit(1 << shift) for shift in (0, 20, 40)]
        return (wide[0] + wide[1] + wide[2]).cast("decimal(38,0)").cast("string")

    summed = hashes.select(*[n.alias(f"n{s}") for s, n in numbers.items()]).agg(F.count(F.lit(1)).alias("line_count"), *parts)
    return summed.select("line_count", F.concat_ws("-", *map(total, starts)).alias("digest"))


def digests_match(actual: DataFrame, expected: DataFrame, column: str = "sha256") -> DataFrame:
    """VER-2 over two frames of one row each."""
    return actual.select(
        F.col(column).alias("output_sha256"),
        expected.select(column).scalar().alias("expected_sha256"),
    ).withColumn("passed", F.col("output_sha256").eqNullSafe(F.col("expected_sha256")))


def key_diff(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    names: tuple[str, str] = ("stream", "batch"),
) -> DataFrame:
    """Both results side by side with a ``status`` per key, so that a failure names its keys (VER-2, VER-7).

    Both inputs have one row per key. Keys are matched null-safely.
    """
    a, b = names
    left = left.select(*[F.col(k).alias(f"_l_{k}") for k in keys], *[F.col(c).alias(f"{a}_{c}") for c in columns], F.lit(True).alias("_in_l"))
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[F.col(c).alias(f"{b}_{c}") for c in columns], F.lit(True).alias("_in_r"))
    same_key = _all([F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    same = _all([F.col(f"{a}_{c}").eqNullSafe(F.col(f"{b}_{c}")) for c in columns])
    status = (
        F.when(F.col("_in_r").isNull(), F.lit(f"{a}_only"))
        .when(F.col("_in_l").isNull(), F.lit(f"{b}_only"))
        .when(same, F.lit("same"))
        .otherwise(F.lit("different"))
    )
    return left.join(right, same_key, "full_outer").select(
        *[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys],
        *[f"{a}_{c}" for c in columns],
        *[f"{b}_{c}" for c in columns],
        status.alias("status"),
    )


def completeness(counts: DataFrame, injected: DataFrame, min_rows: int = 5) -> DataFrame:
    """VER-3 and VER-4: enough result rows, and every event counted exactly once.

    ``injected`` has one row with the number ``n`` of events put in.
    """
    facts = counts.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum("event_count"), F.lit(0)).cast("bigint").alias("total"),
    ).withColumn("injected", injected.select("n").scalar())
    return facts.select(
        "row_count",
        "total",
        "injected",
        (F.col("row_count") >= min_rows).alias("enough_rows"),
        (F.col("total") == F.col("injected")).alias("complete"),
    )


def partition_rule(runs: DataFrame, at_most: int = 8) -> DataFrame:
    """VER-5: a run passes with at most this many shuffle partitions."""
    used = F.col("shuffle_partitions_used")
    return runs.withColumn("partitions_ok", F.coalesce(used <= at_most, F.lit(False)))


def _all(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result
