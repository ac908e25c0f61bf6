"""Near duplicates by SimHash: exact comparison of fingerprints tile by tile."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from eventflow.llm.common import single_threaded, stored, text_or_empty
from eventflow.llm.components import smallest_reachable

SHINGLE = 4
RADIUS = 4
SEED = 42
# Fingerprints of a tile, the unit that is shuffled and compared; and of its inner tiles.
TILE = 1 << 16
INNER = 64


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 for a text without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    last = max(len(words) - size, 0)
    first, stop = starts[: last + 1].tolist(), (ends[min(size, len(words)) - 1 :] - 1).tolist()
    hashes = np.fromiter(
        (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(first, stop)), np.uint64, last + 1
    )
    # Set bits per position, in slices, so that a long text takes no more memory.
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = hashes[k : k + (1 << 14)].astype(">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The rows with ``fingerprint``, the 64 bits as a long, in place of a column of that name.

    Null text is empty text.
    """

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        single_threaded()
        found = np.fromiter((fingerprint(t, size) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return docs.withColumn("fingerprint", of(text_or_empty()))


def quarter_counts(prints: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters of each fingerprint."""
    quarters = prints.astype("<u8").view("<u2").reshape(-1, 4)
    return np.bitwise_count(quarters).astype(np.int16)


def _arranged(prints: np.ndarray) -> np.ndarray:
    """The fingerprints so ordered that neighbours have similar counts in all quarters.

    Halves by the count of one quarter after the other, as often as it takes to come down
    to inner tiles.
    """
    order = np.argsort(prints, kind="stable")
    counts = quarter_counts(prints)
    parts, level = [order], 0
    while max(map(len, parts)) > INNER:
        split = []
        for part in parts:
            if len(part) <= INNER:
                split.append(part)
                continue
            part = part[np.argsort(counts[part, level % 4], kind="stable")]
            half = (len(part) // 2 + INNER - 1) // INNER * INNER
            split += [part[:half], part[half:]]
        parts, level = split, level + 1
    return prints[np.concatenate(parts)]


def _boxes(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest counts of each inner tile."""
    counts = quarter_counts(prints)
    starts = np.arange(0, len(prints), INNER)
    return np.minimum.reduceat(counts, starts), np.maximum.reduceat(counts, starts)


class _Labels:
    """Components of numbered nodes: each has the label of its smallest node."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links ``a`` and ``b``. Links inside a component, most of a large group's, cost nothing more."""
        x, y = self.of[a], self.of[b]
        new = x != y
        if not new.any():
            return
        pairs = np.unique(np.stack([np.minimum(x[new], y[new]), np.maximum(x[new], y[new])], axis=1), axis=0)
        up: dict[int, int] = {}

        def root(k: int) -> int:
            while k in up:
                k = up[k]
            return k

        for x, y in pairs.tolist():
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        moved = np.arange(len(self.of))
        for k in up:
            moved[k] = root(k)
        self.of = moved[self.of]


def link_tiles(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within a tile (``right`` None) or between two.

    Every pair is compared but those in inner tiles whose population counts, quarter by
    quarter, differ by more than the radius in sum: the counts of a quarter differ by no
    more than its bits do. An inner tile is compared with all others in reach at once, first
    by the lower halves, whose bits are some of all. Links are reduced to (node, first node
    of its component), so the result has fewer rows than the tiles have fingerprints,
    however many pairs link.
    """
    same = right is None
    a = _arranged(left)
    b = a if same else _arranged(right)
    (a_low, a_high), (b_low, b_high) = _boxes(a), _boxes(b)
    both = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    labels = _Labels(len(both))
    half = a.astype(np.uint32)
    # Whole inner tiles, the last filled up with places that are left out again.
    places = np.arange(len(b_low) * INNER).reshape(-1, INNER)
    halves = np.resize(b, places.size).astype(np.uint32).reshape(-1, INNER)
    for i in range(len(a_low)):
        apart = np.maximum(np.maximum(a_low[i] - b_high, b_low - a_high[i]), 0).sum(axis=1)
        near = np.flatnonzero(apart <= radius)
        if same:
            near = near[near >= i]
        if not len(near):
            continue
        start = i * INNER
        theirs = halves[near].ravel()
        x, y = np.nonzero(np.bitwise_count(half[start : start + INNER, None] ^ theirs) <= radius)
        x, y = x + start, places[near].ravel()[y]
        keep = y < len(b)
        if same:
            keep &= x < y
        x, y = x[keep], y[keep]
        linked = np.bitwise_count(a[x] ^ b[y]) <= radius
        labels.join(x[linked], y[linked] + shift)
    nodes = np.flatnonzero(labels.of != np.arange(len(both)))
    return both[nodes], both[labels.of[nodes]]


def _tiles(distinct: DataFrame, tile: int) -> DataFrame:
    """Distinct fingerprints packed into tiles, with the range of population counts of each.

    Range partitioning by population count puts equal counts side by side.
    """
    schema = "tile string, low int, high int, prints binary"

    def pack(batches):
        held, size = [], 0

        def rows(values):
            values = values[np.argsort(np.bitwise_count(values), kind="stable")]
            for k in range(0, len(values), tile):
                part = values[k : k + tile]
                counts = np.bitwise_count(part)
                yield part.tobytes(), int(counts.min()), int(counts.max())

        def out(values):
            found = list(rows(values))
            return pa.RecordBatch.from_pydict({
                "tile": pa.array([None] * len(found), pa.string()),
                "low": pa.array([x[1] for x in found], pa.int32()),
                "high": pa.array([x[2] for x in found], pa.int32()),
                "prints": pa.array([x[0] for x in found], pa.binary()),
            })

        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64).copy())
            size += len(held[-1])
            if size >= 16 * tile:
                yield out(np.concatenate(held))
                held, size = [], 0
        if size:
            yield out(np.concatenate(held))

    packed = distinct.select("fingerprint").mapInArrow(pack, schema)
    return packed.withColumn("tile", F.monotonically_increasing_id())


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links between distinct fingerprints at most ``radius`` bits apart, reduced to forests.

    ``prints`` has the column ``fingerprint``. Returns ``a, b``: for each pair of tiles, a
    spanning forest of all links between their fingerprints. Connected components are those
    of all links. The number of comparisons is quadratic in the number of distinct
    fingerprints, less what population counts rule out; it is the method's, and each is a
    few instructions. A tile pair is one row, so the work spreads over all executors.
    """
    distinct = prints.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct()
    count = F.bit_count("fingerprint")
    number = stored(distinct, "prints")
    pieces = max(1, -(-number.count() // tile))
    spread = number.repartitionByRange(pieces, count, F.col("fingerprint"))
    tiles = stored(_tiles(spread, tile), "tiles")
    extent = tiles.select("tile", "low", "high")
    # Tile pairs by the population counts they have in common within the radius: an equi-join on counts.
    reach = extent.select("tile", F.explode(F.sequence("low", F.col("high") + radius)).alias("at"))
    start = extent.select(F.col("tile").alias("other"), F.explode(F.sequence("low", "high")).alias("at"))
    pairs = (
        reach.join(start, "at")
        .select(F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two")).distinct()
    )
    held = tiles.select(F.col("tile").alias("one"), F.col("prints").alias("left"))
    against = tiles.select(F.col("tile").alias("two"), F.col("prints").alias("right"))
    work = pairs.join(held, "one").join(against, "two").repartition(F.col("one"), F.col("two"))

    def compare(batches):
        single_threaded()
        for batch in batches:
            for one, two, left, right in zip(*(batch.column(k) for k in range(4))):
                same = one.as_py() == two.as_py()
                first = np.frombuffer(left.as_buffer(), np.uint64)
                a, b = link_tiles(first, None if same else np.frombuffer(right.as_buffer(), np.uint64), radius)
                yield pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

    return work.select("one", "two", "left", "right").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, carry: list[str] | None = None) -> DataFrame:
    """The class of each document under links between SimHash fingerprints.

    Returns a row per input row: ``carried`` (a struct of the columns named), doc_id,
    fingerprint (long), row (a number), component_id (the smallest id reachable, the own
    one included), keep_row (the row of that id; the first read, if the id repeats). Texts of
    equal fingerprints are linked. Null text is empty; texts without words have fingerprint
    0 and are linked like any other. Rows without id take part in links; their component is
    null only if none of it has an id. Very long texts are read whole; columns that are not
    named are not looked at. An empty table gives an empty result.
    """
    rows = _rows(docs, size, carry)
    return rows.join(_classes(rows, radius), "fingerprint")


def _rows(docs: DataFrame, size: int, carry: list[str] | None) -> DataFrame:
    carried = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(0)
    rows = fingerprints(docs.select(carried.alias("carried"), "doc_id", text_or_empty().alias("text")), size)
    return stored(
        rows.select("carried", "doc_id", "fingerprint", F.monotonically_increasing_id().alias("row")), "fingerprints"
    )


def _classes(rows: DataFrame, radius: int) -> DataFrame:
    """Per fingerprint the smallest id of its class, and the row that has it."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    groups = stored(rows.groupBy("fingerprint").agg(F.min(order).alias("first")), "groups")
    roots = smallest_reachable(links(groups, radius))
    classed = groups.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    firsts = classed.groupBy("root").agg(F.min("first").alias("first"))
    return classed.select("fingerprint", "root").join(firsts, "root").select(
        "fingerprint", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("keep_row")
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class, that of the smallest id, with its columns."""
    rows = _rows(docs, SHINGLE, docs.columns)
    kept = _classes(rows, RADIUS).select(F.col("keep_row").alias("row")).distinct()
    return rows.join(kept, "row", "left_semi").select("carried.*")
