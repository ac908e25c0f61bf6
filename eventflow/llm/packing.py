"""Packing documents into training sequences: best-fit decreasing."""

from __future__ import annotations

from collections.abc import Iterable
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import rows_of, single_threaded, stored, text_or_empty
from eventflow.llm.tokens import default_vocabulary, tokenizer

WINDOW = 1024
END = 0
# Pieces that are packed together by one task.
PIECES = 100_000


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree over the capacities.

    A node says whether any window below it is open, so the tightest window that a piece
    fits is found in as many steps as the tree has levels.
    """

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.open = bytearray(2 * self.size)
        self.held: list[list] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, which) -> None:
        self.held[capacity].append(which)
        k = capacity + self.size
        while k and not self.open[k]:
            self.open[k] = 1
            k //= 2

    def take(self, need: int):
        """Removes the tightest window with at least this capacity: (capacity, window), or None."""
        k = need + self.size
        if not self.open[k]:
            # Up to the first ancestor with an open right sibling, then down its left side.
            while k > 1 and (k & 1 or not self.open[k + 1]):
                k //= 2
            if k <= 1:
                return None
            k += 1
            while k < self.size:
                k = 2 * k if self.open[2 * k] else 2 * k + 1
        capacity = k - self.size
        which = self.held[capacity].pop()
        if not self.held[capacity]:
            while k and not (k < self.size and (self.open[2 * k] or self.open[2 * k + 1])):
                self.open[k] = 0
                k //= 2
        return capacity, which


def best_fit(lengths: Iterable[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece, longest pieces first, each into the tightest window."""
    lengths = list(lengths)
    placed: list = [None] * len(lengths)
    windows, sequences = OpenWindows(window), 0
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = windows.take(lengths[k])
        if found is None:
            found, sequences = (window, sequences), sequences + 1
        capacity, sequence = found
        placed[k] = sequence, window - capacity
        if capacity > lengths[k]:
            windows.add(capacity - lengths[k], sequence)
    return placed


PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of at most a window: the full windows of each document, and what is left.

    The token ids of a whole text and one end id; null text is empty and has the end id
    alone. ``with_ids`` adds the ids themselves.
    """
    path = vocabulary or default_vocabulary()
    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")

    def pieces(batches):
        single_threaded()
        encode = tokenizer(path)
        names = [c.strip().split(" ")[0] for c in schema.split(",")]
        types = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
        held: list[list] = [[] for _ in names]
        for doc_id, text in rows_of(batches, ["doc_id", "text"]):
            ids = encode(text)
            ids.append(END)
            whole = memoryview(ids.tobytes())
            for start in range(0, len(ids), window):
                part = whole[4 * start : 4 * (start + window)]
                row = [doc_id, start, len(part) // 4, crc32(part), len(ids)]
                if with_ids:
                    row.append(ids[start : start + window].tolist())
                for column, value in zip(held, row):
                    column.append(value)
            if len(held[0]) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, types)], names)
                held = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, types)], names)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(pieces, schema)


def pack(
    docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None, pieces: int = PIECES, with_ids: bool = False
) -> DataFrame:
    """All tokens of all documents in sequences of at most a window.

    Returns a row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (and ids). Overlong documents are cut into full windows first, each of which is a
    sequence. The rest is dealt evenly to tasks, about ``pieces`` rows of a few numbers each,
    and packed there by best fit, longest first; only these rows move, never texts. Each task
    leaves little padding but in its last sequences. Null text is empty and has one token.
    Repeated rows are packed as often as they come; ids may be null; very long texts are
    tokenised whole. Pieces of equal length are interchangeable: which window each gets depends
    on the order in which they reach a task. Other columns are not looked at. An empty table
    gives no sequences.
    """
    table = stored(cut(docs, window, vocabulary, with_ids), "pieces")
    full = table.where(F.col("length") == window).select(
        "*", (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    rest = table.where(F.col("length") < window)
    tasks = max(1, -(-rest.count() // pieces))

    def place(batches):
        found = list(batches)
        if not sum(b.num_rows for b in found):
            return
        held = pa.Table.from_batches(found)
        placed = best_fit(held["length"].to_pylist(), window)
        base = TaskContext.get().partitionId() << 33
        out = held.append_column("sequence_id", pa.array([2 * (base + s) + 1 for s, _ in placed], pa.int64()))
        yield from out.append_column("offset", pa.array([o for _, o in placed], pa.int64())).to_batches()

    packed = rest.repartition(tasks).mapInArrow(place, full.schema)
    return full.unionByName(packed)
