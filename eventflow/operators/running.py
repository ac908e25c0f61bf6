"""Running counts per key in sequence order (STR-5) and the time of the n-th event (MET-1).

A window over a whole key would put a hot key into one task. Here the 64-bit sequence
number is cut into blocks of 2**20 numbers and those into spans of 2**20 blocks. Counts
are added up over the spans of a key, then over the blocks of a span, then inside a block,
each level starting from what the level above carries in. However the events are spread
over keys and numbers, no window group exceeds 2**20 rows (2**24 spans for a key): copies
of an event, which alone could fill a block further, are combined first.

What is carried in travels as one more row of its group, so no join is needed and null
keys or sequence numbers are counted like any other; null numbers come first. The time of
the n-th event is found by going down the same levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 20
NULL_BLOCK = -(1 << 62)
# Copies of one event that are written by one row of a task.
COPIES_PER_ROW = 65_536


def running_counts(
    events: DataFrame,
    keys: Sequence[str],
    sequence: str,
    base: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """One row per event: its key, its number and the count of the key up to it.

    ``unique`` says that a key's numbers do not repeat, as with broker offsets; copies then
    need not be looked for. ``base`` holds ``event_count`` per key from earlier input.
    """
    rows = _with_blocks(events.select(*keys, sequence), F.col(sequence))
    offsets = _block_offsets(_block_counts(rows, keys), keys, base)
    count = _count_rows if unique else _count_copies
    return count(rows, offsets, keys, sequence)


def nth_event(events: DataFrame, keys: Sequence[str], order: str, sequence: Column, n: int) -> DataFrame:
    """Value of ``order`` at which each key reaches ``n`` events; keys below ``n`` have no row.

    ``sequence`` is the bigint form of ``order``. One pass counts the events of each key per
    block; the span and the block in which a key's count passes ``n`` are found from these
    counts. A second pass takes the events of those blocks, one a key, and counts them one
    by one.
    """
    rows = _with_blocks(events.select(*keys, order, sequence.alias("_at")), F.col("_at"))
    blocks = _block_counts(rows, keys)
    spans = blocks.groupBy(*keys, "_span").agg(F.sum("copies").alias("copies"))
    passing = _passing(spans.withColumn("before", F.lit(0)), keys, "_span", n)
    passing = _passing(_inside(blocks, passing, [*keys, "_span"]), keys, "_block", n)
    cells = _inside(rows, passing, [*keys, "_block"]).groupBy(*keys, "_at", order, "before").agg(
        F.count(F.lit(1)).alias("copies")
    )
    return _passing(cells, keys, "_at", n).select(*keys, order)


def _inside(rows: DataFrame, passing: DataFrame, names: list[str]) -> DataFrame:
    """The rows in a passing span or block, with what is counted before it."""
    chosen = passing.select(*[F.col(k).alias(f"_p_{k}") for k in names], "before")
    return rows.join(chosen, _same(names, "_p_")).drop(*[f"_p_{k}" for k in names])


def _passing(counts: DataFrame, keys: Sequence[str], at: str, n: int) -> DataFrame:
    """The one row per key in which its count passes ``n``, ``before`` being the count ahead of it."""
    ahead = Window.partitionBy(*keys).orderBy(F.asc_nulls_first(at)).rowsBetween(Window.unboundedPreceding, 0)
    reached = counts.withColumn("_reached", F.col("before") + F.sum("copies").over(ahead))
    passes = (F.col("_reached") >= n) & (F.col("_reached") - F.col("copies") < n)
    return reached.filter(passes).withColumn("before", F.col("_reached") - F.col("copies")).drop("_reached")


def _with_blocks(rows: DataFrame, number: Column) -> DataFrame:
    return rows.withColumns({
        "_block": F.coalesce(F.shiftright(number, BLOCK_BITS), F.lit(NULL_BLOCK)),
        "_span": F.coalesce(F.shiftright(number, 2 * BLOCK_BITS), F.lit(NULL_BLOCK)),
    })


def _block_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys, "_span", "_block").agg(F.count(F.lit(1)).alias("copies"))


def _block_offsets(blocks: DataFrame, keys: Sequence[str], base: DataFrame | None) -> DataFrame:
    """``before``: the events of the key ahead of each block."""
    spans = blocks.groupBy(*keys, "_span").agg(F.sum("copies").alias("copies"))
    start = None if base is None else base.select(*keys, F.col("event_count").alias("before"))
    spans = _carry_in(spans, start, list(keys), "_span")
    return _carry_in(blocks, spans, [*keys, "_span"], "_block")


def _count_rows(rows: DataFrame, offsets: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    single = rows.withColumn("copies", F.lit(1).cast("bigint"))
    counted = _carry_in(single, offsets, [*keys, "_block"], sequence)
    return counted.select(*keys, sequence, (F.col("before") + 1).alias("running_count"))


def _count_copies(rows: DataFrame, offsets: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Copies are combined on the map side, counted as one, and written out again. More than
    ``COPIES_PER_ROW`` of them are written out by several tasks."""
    cells = rows.groupBy(*keys, "_block", sequence).agg(F.count(F.lit(1)).alias("copies"))
    counted = _carry_in(cells, offsets, [*keys, "_block"], sequence)
    first = F.col("_run") * COPIES_PER_ROW
    last = F.least(F.col("copies"), first + COPIES_PER_ROW)
    last_run = F.call_function("div", F.col("copies") - 1, F.lit(COPIES_PER_ROW))
    few = counted.filter(F.col("copies") <= COPIES_PER_ROW).withColumn("_run", F.lit(0).cast("bigint"))
    many = counted.filter(F.col("copies") > COPIES_PER_ROW).withColumn(
        "_run", F.explode(F.sequence(F.lit(0).cast("bigint"), last_run))
    )
    return few.unionByName(many.repartition(*keys, sequence, "_run")).select(
        *keys,
        sequence,
        F.explode(F.sequence(F.col("before") + first + 1, F.col("before") + last)).alias("running_count"),
    )


def _carry_in(rows: DataFrame, carried: DataFrame | None, group: list[str], order: str) -> DataFrame:
    """Adds ``before``: what is carried into the group plus the copies ahead in its order."""
    rows = rows.withColumn("_carried", F.lit(False))
    if carried is not None:
        first = carried.select(*group, F.col("before").alias("copies"), F.lit(True).alias("_carried"))
        rows = rows.unionByName(first, allowMissingColumns=True)
    ahead = (
        Window.partitionBy(*group)
        .orderBy(F.desc("_carried"), F.asc_nulls_first(order))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = rows.withColumn("before", F.sum("copies").over(ahead) - F.col("copies"))
    return summed.filter(~F.col("_carried")).drop("_carried")


def _same(names: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of columns with their prefixed counterparts."""
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(f"{prefix}{name}"))
    return condition
