"""JSON documents of any size, read by many tasks (SRC-7).

A document is cut wherever a closing brace is, whatever that brace means there. Tasks read byte
ranges of the file. Whether a range begins inside a text, and how deep, follows from all before
it: each range is summed up for both cases, whether it begins inside a text or not, as a change
of state, and changes are combined in order. An escape never crosses a cut, for no escape ends
with a closing brace.

Once its first state is known, a range is cut into the elements of the document's large parts:
the members of a top-level object are its own text, and what lies inside an array or object
there becomes rows, one for each element.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventflow.functions.json import parse_document
from eventflow.session import work_dir

# Functions that tasks run travel with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CUT = b"}"
CHUNK = 1 << 20
# Most ranges whose first states are sent to all executors; more are joined by sorting.
MOST_RANGES = 200_000
RANGE = ["document", "first"]

ESCAPES = re.compile(rb"\\.", re.DOTALL)
# Characters that are looked at, and by how much they go deeper.
SIGNS, CHANGES = np.zeros(256, bool), np.zeros(256, np.int64)
SIGNS[list(b'"{}[],')] = True
CHANGES[list(b"{[")], CHANGES[list(b"}]")] = 1, -1

SUMMARY = "document string, first long, bytes long, cuts long, top binary, ends_0 long, depth_0 long, ends_1 long, depth_1 long"
PIECES = (
    "document string, first long, kind string, place long, number long, text binary, starts boolean, ends boolean, "
    "bracket string, part long, separators long, depth long, in_text boolean"
)


@dataclass
class LargeDocuments:
    """``documents`` has ``document``, whether it is ``readable``, and ``outline``: its text with
    the number of the first element in place of all elements of each large part. ``elements``
    has ``document, part`` (that number), ``number, text`` and ``bracket``, ``[`` or ``{``, in
    which they lie; an empty part has one element of blanks."""

    documents: DataFrame
    elements: DataFrame


def read_large_documents(spark: SparkSession, paths: str | Sequence[str]) -> LargeDocuments:
    """Documents at files or patterns. What is held at once is one element, and a megabyte a task.

    Files of no bytes are not listed, so to their readers they are missing.
    """
    size = spark.read.format("binaryFile").load(paths).select(
        F.col("_metadata.file_path").alias("document"), F.col("_metadata.file_size").alias("size")
    )
    blocks = _blocks(spark, paths)
    states = _stored(_states(_stored(blocks.mapInArrow(_summaries, SUMMARY), "json-ranges"), size), "json-states")
    given = ["in_text", "depth", "within", "closed"]
    if states.limit(MOST_RANGES + 1).count() <= MOST_RANGES:
        rows = blocks.join(F.broadcast(states.select(*RANGE, *given)), RANGE)
    else:
        rows = blocks.join(states.select(*RANGE, *given), RANGE).repartition(*RANGE).sortWithinPartitions(*RANGE, "at")
    pieces = _stored(rows.select("document", "first", "data", *given).mapInArrow(_pieces, PIECES), "json-pieces")
    return _assembled(size, states, pieces)


def _blocks(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """What lies between two cuts, a row each, in the order of the file within each of its ranges."""
    rows = spark.read.option("lineSep", CUT.decode()).text(paths)
    return rows.select(
        F.col("_metadata.file_path").alias("document"), F.col("_metadata.file_block_start").alias("first"),
        F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("data"),
    )


def _ranges(batches: Iterator[pa.RecordBatch], given: Sequence[str] = ()) -> Iterator[tuple[tuple, Iterator[bytes]]]:
    """The ranges of a task: their key with the given columns, and their blocks, joined some at a time.

    A key is looked at once for all neighbouring rows that have it, not row by row.
    """

    def runs():
        for batch in batches:
            keys = [batch.column(batch.schema.get_field_index(c)) for c in (*RANGE, *given)]
            data = batch.column(batch.schema.get_field_index("data"))
            numbers = [k.dictionary_encode().indices.to_numpy() for k in keys[: len(RANGE)]]
            changes = [np.flatnonzero(np.diff(n)) + 1 for n in numbers]
            starts = [0, *np.unique(np.concatenate(changes)).tolist(), batch.num_rows]
            for start, end in zip(starts, starts[1:]):
                if end > start:
                    yield tuple(k[start].as_py() for k in keys), data.slice(start, end - start)

    def joined(data):
        for start in range(0, len(data), 4096):
            part = data.slice(start, 4096)
            yield pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part), CUT)[0].as_py()

    for key, group in groupby(runs(), key=lambda run: run[0]):
        yield key, (blocks for _, data in group for blocks in joined(data))


def _chunks(blocks: Iterator[bytes], closed: bool = True) -> Iterator[bytes]:
    """Blocks with their cuts, about a megabyte at a time; unless ``closed``, the last has no cut."""
    held, size = [], 0
    for block in blocks:
        if size >= CHUNK:
            yield CUT.join(held) + CUT
            held, size = [], 0
        held.append(block)
        size += len(block) + 1
    if held:
        yield CUT.join(held) + (CUT if closed else b"")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range: its bytes and the cuts not among them, its first character that is no blank, and for a beginning
    outside (0) and inside (1) of a text: whether it ends inside one, and by how much it goes deeper."""
    names = [c.strip().split(" ")[0] for c in SUMMARY.split(",")]
    for (document, first), blocks in _ranges(batches):
        size = cuts = quotes = 0
        depth, top = [0, 0], b""

        def counted(parts: Iterator[bytes]) -> Iterator[bytes]:
            nonlocal size, cuts
            for block in parts:
                size, cuts = size + len(block), cuts + 1
                yield block

        for chunk in _chunks(counted(blocks)):
            top = top or chunk.lstrip(b" \t\r\n")[:1]
            parts = ESCAPES.sub(b"", chunk).split(b'"')
            for inside in (0, 1):
                # Every second part lies outside of texts.
                outside = b"".join(parts[(quotes + inside) % 2 :: 2])
                depth[inside] += sum(map(outside.count, (b"{", b"["))) - sum(map(outside.count, (b"}", b"]")))
            quotes += len(parts) - 1
        row = [document, first, size, cuts, top, quotes % 2, depth[0], (quotes + 1) % 2, depth[1]]
        yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, row)}, _arrow(SUMMARY))


def _states(summaries: DataFrame, size: DataFrame) -> DataFrame:
    """First state of each range: combined changes of all ranges before, a row each.

    A document's text is open at a place if the number of quotes before it is odd. ``within``
    is the depth of the elements: 2 below a top-level object, 1 in a top-level array. ``closed``
    says whether the last block ends with a cut, which only the file's size can tell.
    """
    before = Window.partitionBy("document").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("document")
    text = F.coalesce(F.sum("ends_0").over(before), F.lit(0)) % 2 == 1
    known = summaries.withColumn("in_text", text).withColumn(
        "change", F.when(F.col("in_text"), F.col("depth_1")).otherwise(F.col("depth_0"))
    )
    seen = F.when(F.length("top") > 0, F.struct("first", "top"))
    known = known.withColumns({
        "depth": F.coalesce(F.sum("change").over(before), F.lit(0)), "seen": F.min(seen).over(whole)["top"],
        "total": F.sum(F.col("bytes") + F.col("cuts")).over(whole), "is_last": F.max("first").over(whole) == F.col("first"),
    })
    joined = known.join(size, "document")
    return joined.select(
        *RANGE, "in_text", "depth", "is_last",
        F.when(F.col("seen") == F.lit(b"["), 1).otherwise(2).alias("within"),
        (~F.col("is_last") | (F.col("total") == F.col("size"))).alias("closed"),
        # One byte too many is the cut that was not there; else bytes were lost in reading.
        F.col("total").isin(F.col("size"), F.col("size") + 1).alias("complete"),
    )


class Cutter:
    """Cuts a range into pieces: of the outline (kind ``outline``) and elements.

    ``number`` counts what separates elements: openings of large parts and commas in them.
    """

    def __init__(self, in_text: bool, depth: int, within: int):
        self.in_text, self.depth, self.within = in_text, depth, within
        self.number = self.place = 0
        # The piece at hand was begun in this range.
        self.starts, self.held = False, b""
        # Of the large part at hand, if it was opened in this range.
        self.bracket: str | None = None
        self.part: int | None = None

    def _piece(self, data: bytes, ends: bool) -> tuple:
        kind = "element" if self.depth >= self.within else "outline"
        self.place += 1
        return kind, self.place, self.number, self.held + data, self.starts, ends, self.bracket, self.part

    def __call__(self, chunk: bytes) -> Iterator[tuple]:
        # Escapes have two characters and mean nothing here.
        data = np.frombuffer(ESCAPES.sub(b"  ", chunk) if b"\\" in chunk else chunk, np.uint8)
        places = np.flatnonzero(SIGNS[data])
        signs = data[places]
        quotes = np.cumsum(signs == ord('"')) + self.in_text
        outside = (signs != ord('"')) & (quotes % 2 == 0)
        places, signs = places[outside], signs[outside]
        change = CHANGES[signs]
        depth = self.depth + np.cumsum(change) - change
        opens = (change > 0) & (depth == self.within - 1)
        cuts = np.flatnonzero(opens | ((change <= 0) & (depth == self.within)))
        at = 0
        for place, sign, before in zip(places[cuts].tolist(), signs[cuts].tolist(), depth[cuts].tolist()):
            self.depth = before
            if CHANGES[sign] > 0:
                # The number of the first element follows in the outline.
                self.bracket, self.part = chr(sign), self.number + 1
                yield self._piece(chunk[at : place + 1], True)
                self.number += 1
                at = place + 1
            else:
                yield self._piece(chunk[at:place], True)
                comma = sign == ord(",")
                self.number += comma
                at = place + comma
            self.held, self.starts = b"", True
        if len(places):
            self.depth = int(depth[-1] + change[-1])
        if len(quotes):
            self.in_text = bool(quotes[-1] % 2)
        self.held += chunk[at:]

    def rest(self) -> tuple:
        return self._piece(b"", False)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.strip().split(" ")[0] for c in PIECES.split(",")]
    schema = _arrow(PIECES)
    for (document, first, in_text, depth, within, closed), blocks in _ranges(batches, ["in_text", "depth", "within", "closed"]):
        cutter, rows = Cutter(in_text, depth, within), []

        def batch():
            return pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))), schema)

        for chunk in _chunks(blocks, closed):
            for piece in cutter(chunk):
                rows.append((document, first, *piece, None, None, None))
                if len(rows) >= 4096:
                    yield batch()
                    rows = []
        rows.append((document, first, *cutter.rest(), cutter.number, cutter.depth, cutter.in_text))
        yield batch()


def _assembled(size: DataFrame, states: DataFrame, pieces: DataFrame) -> LargeDocuments:
    """Pieces of ranges to outlines and elements of documents."""
    rest = pieces.where(F.col("separators").isNotNull())
    before = Window.partitionBy("document").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("separators").over(before), F.lit(0))
    opened = F.when(F.col("part").isNotNull(), F.struct("bracket", (F.col("part") + F.col("offset")).alias("part")))
    # What was opened last before a range is open at its beginning.
    ranges = rest.withColumn("offset", offset).withColumn("opened", F.last(opened, ignorenulls=True).over(before))
    numbered = pieces.join(ranges.select(*RANGE, "offset", "opened"), RANGE).withColumns({
        "number": F.col("number") + F.col("offset"),
        "bracket": F.coalesce("bracket", F.col("opened.bracket")),
        "part": F.coalesce(F.col("part") + F.col("offset"), F.col("opened.part")),
    })
    elements = numbered.where(F.col("kind") == "element")
    whole, names = F.col("starts") & F.col("ends"), ["document", "part", "number", "bracket"]
    found = elements.where(whole).select(*names, F.col("text").cast("string").alias("text"))
    elements = found.unionByName(_joined(elements.where(~whole), names))

    first_element = F.concat(F.when(F.col("bracket") == "{", F.lit('"":')).otherwise(F.lit("")), F.col("part").cast("string"))
    outline = numbered.where(F.col("kind") == "outline").withColumn(
        "text", F.when(F.col("ends"), F.concat(F.col("text").cast("string"), first_element)).otherwise(F.col("text").cast("string"))
    )
    outlines = _joined(outline, ["document"]).withColumnRenamed("text", "outline")
    last = states.where("is_last").select(*RANGE).join(rest.select(*RANGE, "depth", "in_text"), RANGE)
    ends = last.select("document", ((F.col("depth") == 0) & ~F.col("in_text")).alias("balanced"))
    complete = states.groupBy("document").agg(F.bool_and("complete").alias("complete"))
    documents = size.select("document").join(outlines, "document", "left").join(ends, "document", "left").join(complete, "document", "left")
    readable = F.col("balanced") & F.col("complete") & F.col("outline").isNotNull()
    # A row per document, read more than once.
    outlined = documents.select("document", F.coalesce(readable, F.lit(False)).alias("readable"), "outline")
    return LargeDocuments(_stored(outlined, "json-documents"), elements)


def _joined(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """The pieces of one text put together in their order. Few texts are in several pieces: those
    that cross the end of a range, and outlines. No piece ends inside a character."""
    parts = F.sort_array(F.collect_list(F.struct("first", "place", F.col("text").cast("string").alias("text"))))
    joined = pieces.groupBy(*keys).agg(parts.alias("parts"))
    return joined.select(*keys, F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))


def element_value(text: Column, bracket: Column) -> Column:
    """An element as a variant: an array's value, or an object's member as an object; null if it is neither."""
    return F.when(bracket == "[", parse_document(text)).when(
        bracket == "{", parse_document(F.concat(F.lit("{"), text, F.lit("}")))
    )


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.strip().split(" ") for c in schema.split(","))])


def _stored(table: DataFrame, purpose: str) -> DataFrame:
    path = work_dir(table.sparkSession, purpose)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
