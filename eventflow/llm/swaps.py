"""Packing whole documents into few sequences: best fit, then local search by exchanges.

Documents are first put each into the tightest open sequence. Then the emptier
sequences give documents away: one moves to a fuller sequence, or is exchanged for a
smaller one or for two, or two for one, always so that the fuller sequence gets fuller. Each
step makes the sum of squared fills larger, so the search ends, and sequences become empty.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterable
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import rows_of, single_threaded, stored, text_or_empty
from eventflow.llm.tokens import default_vocabulary, tokenizer

WINDOW = 2048
END = 0
# Pieces that are packed together by one task.
PIECES = 50_000
# Passes in a row that empty no sequence, before the search ends.
PASSES = 3


def best_fit_in_order(lengths: Iterable[int], window: int = WINDOW) -> list[list[int]]:
    """Numbers of the pieces of each sequence; each piece goes where it leaves least room.

    The rooms that open sequences have are the bits of one number, so that the smallest of
    them that is large enough is one shift away.
    """
    sequences: list[list[int]] = []
    rooms, held = 0, [[] for _ in range(window + 1)]
    for number, length in enumerate(lengths):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            sequence = held[room].pop()
            if not held[room]:
                rooms ^= 1 << room
            sequences[sequence].append(number)
        else:
            room, sequence = window, len(sequences)
            sequences.append([number])
        held[room - length].append(sequence)
        if room > length:
            rooms |= 1 << room - length
    return sequences


class Bin:
    """Pieces of one sequence by length. ``ones`` and ``twos`` have a bit for each length of a
    piece, and for each sum of two pieces."""

    def __init__(self, pieces: list[int], lengths: list[int], window: int):
        self.by_length: dict[int, list[int]] = {}
        for number in pieces:
            self.by_length.setdefault(lengths[number], []).append(number)
        self.room = window - sum(lengths[number] for number in pieces)
        self._count()

    def _count(self) -> None:
        self.ones = self.twos = 0
        for length, held in self.by_length.items():
            self.twos |= self.ones << length
            self.ones |= 1 << length
            if len(held) > 1:
                self.twos |= 1 << 2 * length

    def take(self, lengths: tuple[int, ...]) -> list[int]:
        taken = []
        for length in lengths:
            held = self.by_length[length]
            taken.append(held.pop())
            if not held:
                del self.by_length[length]
        self.room += sum(lengths)
        return taken

    def put(self, lengths: tuple[int, ...], pieces: list[int]) -> None:
        for length, number in zip(lengths, pieces):
            self.by_length.setdefault(length, []).append(number)
        self.room -= sum(lengths)
        self._count()

    def two_of(self, total: int) -> tuple[int, int]:
        """Two of its lengths with this sum."""
        for length, held in self.by_length.items():
            other = total - length
            if other in self.by_length and (other != length or len(held) > 1):
                return length, other
        raise KeyError(total)

    def pieces(self) -> list[int]:
        return [number for held in self.by_length.values() for number in held]


def bits(number: int) -> Iterable[int]:
    while number:
        low = number & -number
        yield low.bit_length() - 1
        number ^= low


def exchange(giver: Bin, taker: Bin) -> bool:
    """The move or exchange after which ``taker`` is fullest; whether there is any.

    ``giver`` is the emptier of both, so whatever makes ``taker`` fuller by ``d`` adds
    ``2 * d * (fill of taker - fill of giver + d)`` to the squares.
    """
    room, best, chosen = taker.room, 0, None
    for given, returned in ((giver.ones, 1 | taker.ones | taker.twos), (giver.twos, taker.ones)):
        for total in bits(given):
            # What comes back is smaller than what is given, by the room at most; least is best.
            least = total - room
            fitting = returned >> least if least > 0 else returned << -least
            fitting &= (1 << room) - 1
            if fitting:
                gain = room - ((fitting & -fitting).bit_length() - 1)
                if gain > best:
                    best, chosen = gain, (total, total - gain, given is giver.ones)
                    if gain == room:
                        break
        if best == room:
            break
    if chosen is None:
        return False
    total, back, single = chosen
    there = (total,) if single else giver.two_of(total)
    if back == 0:
        here: tuple[int, ...] = ()
    elif taker.ones >> back & 1:
        here = (back,)
    else:
        here = taker.two_of(back)
    moved, returned = giver.take(there), taker.take(here)
    giver.put(here, returned)
    taker.put(there, moved)
    return True


class Givers:
    """Sequences with room, and which of them hold a piece of some length."""

    def __init__(self, bins: list[Bin], window: int, numbers: Iterable[int]):
        self.bins, self.numbers, self.lengths = bins, set(), 0
        self.holding: list[set[int]] = [set() for _ in range(window + 1)]
        for number in numbers:
            self.add(number)

    def add(self, number: int) -> None:
        self.numbers.add(number)
        for length in self.bins[number].by_length:
            self.holding[length].add(number)
            self.lengths |= 1 << length

    def remove(self, number: int) -> None:
        self.numbers.remove(number)
        for length in self.bins[number].by_length:
            self.holding[length].remove(number)
            if not self.holding[length]:
                self.lengths ^= 1 << length

    def giver_for(self, taker: Bin) -> int | None:
        """The emptiest one with a piece by which a move or an exchange for one or two of the
        taker's makes the taker fullest."""
        best, piece = 0, 0
        for back in bits(1 | taker.ones | taker.twos):
            fitting = (self.lengths >> back + 1) & ((1 << taker.room) - 1)
            if fitting.bit_length() > best:
                best = fitting.bit_length()
                piece = back + best
                if best == taker.room:
                    break
        return max(self.holding[piece], key=lambda k: (self.bins[k].room, k)) if best else None


def empty_bins(sequences: list[list[int]], lengths: list[int], window: int = WINDOW, passes: int = PASSES) -> list[list[int]]:
    """The sequences after the local search.

    In each pass the sequences with room take from the emptier ones, the fullest first and as
    long as one of these has something for it. Passes end when ``passes`` of them in a row have
    emptied no sequence, when nothing has moved, or when the rooms of all others are less than
    what the emptiest sequence holds.
    """
    bins = [Bin(pieces, lengths, window) for pieces in sequences]
    idle = 0
    while idle < passes:
        order = sorted((k for k, b in enumerate(bins) if b.room and b.by_length), key=lambda k: (bins[k].room, k))
        if not order or sum(bins[k].room for k in order[:-1]) < window - bins[order[-1]].room:
            break
        givers, moved, emptied = Givers(bins, window, order), False, False
        for number in order:
            if number not in givers.numbers:
                continue
            givers.remove(number)
            taker = bins[number]
            while taker.room and (giver := givers.giver_for(taker)) is not None:
                givers.remove(giver)
                moved |= exchange(bins[giver], taker)
                if bins[giver].by_length:
                    givers.add(giver)
                else:
                    emptied = True
        if not moved:
            break
        idle = 0 if emptied else idle + 1
    return [b.pieces() for b in bins if b.by_length]


def pack_pieces(lengths: list[int], window: int = WINDOW, passes: int = PASSES) -> list[list[int]]:
    """Sequences as lists of the numbers of their pieces.

    The search starts twice, from pieces as they come and from the longest first, since either
    may end better; the result of fewer sequences counts.
    """
    found = []
    for order in (range(len(lengths)), sorted(range(len(lengths)), key=lambda k: -lengths[k])):
        start = best_fit_in_order([lengths[k] for k in order], window)
        found.append(empty_bins([[order[k] for k in pieces] for pieces in start], lengths, window, passes))
    return min(found, key=len)


PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_whole(docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None) -> DataFrame:
    """Documents as pieces: one if it fits a window, else full windows after a shorter first piece.

    The token ids of a whole text and one end id; null text is empty and has the end id alone.
    """
    path = vocabulary or default_vocabulary()

    def pieces(batches):
        single_threaded()
        encode = tokenizer(path)
        names = [c.strip().split(" ")[0] for c in PIECE_SCHEMA.split(",")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        held: list[list] = [[] for _ in names]
        for doc_id, text in rows_of(batches, ["doc_id", "text"]):
            ids = encode(text)
            ids.append(END)
            whole = memoryview(ids.tobytes())
            ends = range(len(ids) % window or window, len(ids) + 1, window)
            for piece, end in enumerate(ends):
                start = ends[piece - 1] if piece else 0
                part = whole[4 * start : 4 * end]
                for column, value in zip(held, (doc_id, piece, start, end - start, crc32(part))):
                    column.append(value)
            if len(held[0]) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, types)], names)
                held = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, types)], names)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(pieces, PIECE_SCHEMA)


def _packed(rest: DataFrame, tasks: int, number: int, window: int, passes: int) -> DataFrame:
    """The pieces with sequence_id, offset and whether their sequence has room, packed by tasks."""

    def place(batches):
        found = list(batches)
        if not sum(b.num_rows for b in found):
            return
        # In an order of their own, whatever the order in which a shuffle delivers them.
        held = pa.Table.from_batches(found).sort_by([("ids_crc32", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = held["length"].to_pylist()
        sequence, offset, has_room = (np.zeros(len(lengths), t) for t in (np.int64, np.int64, bool))
        base = (number << 58) + (TaskContext.get().partitionId() << 34)
        for k, pieces in enumerate(pack_pieces(lengths, window, passes)):
            sizes = [lengths[p] for p in pieces]
            sequence[pieces] = base + 2 * k + 1
            offset[pieces] = np.cumsum([0, *sizes[:-1]])
            has_room[pieces] = sum(sizes) < window
        for name, column in (("sequence_id", sequence), ("offset", offset), ("has_room", has_room)):
            held = held.append_column(name, pa.array(column))
        yield from held.to_batches()

    schema = PIECE_SCHEMA + ", sequence_id long, offset long, has_room boolean"
    return rest.repartition(tasks).mapInArrow(place, schema)


def pack_whole(
    docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None, pieces: int = PIECES, passes: int = PASSES
) -> DataFrame:
    """All documents in few sequences of at most a window, cutting only what is longer.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Full
    windows are sequences of their own. The others, a few numbers each, are dealt evenly to
    tasks of about ``pieces`` and packed there; what lies in sequences that still have room is
    packed again in further rounds, as long as a round has at most half the tasks of the one
    before.

    Null text is empty and has one token. Very long texts are whole, in pieces. Repeated rows
    are packed as often as they come; ids may be null. Pieces of equal length are
    interchangeable; which of them goes where follows the hash of their tokens. Other columns
    are not looked at. An empty table gives no sequences.
    """
    table = stored(cut_whole(docs, window, vocabulary), "pieces")
    names = [*table.columns, "sequence_id", "offset"]
    packed = table.where(F.col("length") == window).select(
        "*", (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    rest = table.where(F.col("length") < window)
    tasks, number = max(1, -(-rest.count() // pieces)), 0
    while True:
        found = stored(_packed(rest, tasks, number, window, passes), "packed")
        rest = found.where("has_room").select(table.columns)
        fewer = max(1, -(-rest.count() // pieces)) if tasks > 1 else 1
        if fewer > tasks // 2:
            return packed.unionByName(found.select(names))
        packed = packed.unionByName(found.where(~F.col("has_room")).select(names))
        tasks, number = fewer, number + 1
