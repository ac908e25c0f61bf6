"""Ranked lexical search: one scan of the documents by an automaton of all items' terms.

There is no index of the documents. The terms of the items, each between two spaces, are the
patterns of an Aho-Corasick automaton; the documents, with every separator made a space, run
through it, so that an occurrence of a pattern is one whole term. Each pattern knows the
items that hold it.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from eventflow.llm.common import rows_of, stored, text_or_empty

TOP = 20
# Most bytes of items' terms that one automaton is made of; more items take more scans.
BLOCK_BYTES = 16 << 20
# What a pattern costs beyond its text.
PATTERN_BYTES = 64
# Parts into which the best of all tasks are dealt before the best of an item meet.
PARTS = 64
# What separates terms once A to Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def separators_as_spaces() -> bytes:
    """For each byte of UTF-8 what it becomes: letters lower case, ASCII separators a space."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for byte in b"0123456789abcdefghijklmnopqrstuvwxyz":
        table[byte] = byte
    for upper, lower in zip(ascii_uppercase, ascii_lowercase):
        table[ord(upper)] = ord(lower)
    return bytes(table)


def item_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, term, times`` of ``item_id, text`` rows, each row an item of its own."""
    numbered = stored(
        items.select("item_id", text_or_empty().alias("text"), F.monotonically_increasing_id().alias("item")), "items"
    )
    lower = F.translate("text", ascii_uppercase, ascii_lowercase)
    words = numbered.select("item", "item_id", F.explode(F.split(lower, BETWEEN, -1)).alias("term"))
    return stored(
        words.where(F.col("term") != "").groupBy("item", "item_id", "term").agg(F.count(F.lit(1)).alias("times")), "terms"
    )


def blocks_of_items(terms: DataFrame, most_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[int]]:
    """``terms`` with a ``block``, and the numbers of the blocks that have terms.

    The terms of a block stay below ``most_bytes``; only an item that is larger by itself makes
    a larger block. Blocks are dealt by hash and made smaller until all fit.
    """
    cost = F.sum(F.octet_length("term") + PATTERN_BYTES)
    total = terms.agg(cost).first()[0] or 0
    count = max(1, -(-total // most_bytes))
    while True:
        dealt = terms.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(count)))
        sizes = dealt.groupBy("block").agg(cost.alias("bytes"), F.count_distinct("item").alias("items")).collect()
        if all(r.bytes <= most_bytes or r["items"] == 1 for r in sizes):
            return dealt, sorted(r.block for r in sizes)
        count *= 2


@dataclass
class Patterns:
    """An automaton's terms and, as rows of a sparse matrix, the items that hold each of them."""

    terms: list[str]
    items: list[tuple[int, int | None]]
    starts: np.ndarray
    holders: np.ndarray
    times: np.ndarray

    @staticmethod
    def of(rows: list[Row]) -> Patterns:
        rows = sorted(rows, key=lambda r: (r.term, r.item))
        items = sorted({(r.item, r.item_id) for r in rows}, key=lambda i: i[0])
        place = {item: k for k, (item, _) in enumerate(items)}
        terms = sorted({r.term for r in rows})
        number = {term: k for k, term in enumerate(terms)}
        held = np.bincount(np.array([number[r.term] for r in rows], np.int64), minlength=len(terms))
        return Patterns(
            terms, items, np.concatenate([[0], np.cumsum(held)]),
            np.array([place[r.item] for r in rows], np.int64), np.array([r.times for r in rows], np.int64),
        )

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, term in enumerate(self.terms):
            found.add_word(f" {term} ", k)
        found.make_automaton()
        return found


class Scanner:
    """Term counts of a text by an automaton."""

    def __init__(self, automaton):
        self.automaton, self.table = automaton, separators_as_spaces()

    def __call__(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """How many terms the text has, which patterns occur, and how often."""
        plain = text.encode("utf-8", "surrogatepass").translate(self.table)
        n = len(plain.split())
        guarded = f" {plain.decode('utf-8', 'surrogatepass')} "
        ends = [number for _, number in self.automaton.iter(guarded)]
        which, tf = np.unique(np.array(ends, np.int64), return_counts=True)
        return n, which, tf


class Best:
    """The best documents of each item among those seen so far."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.zeros(items, np.int64)
        self.item, self.score, self.doc, self.null = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, scores: np.ndarray, docs: np.ndarray, null: np.ndarray) -> None:
        """``scores`` has a row per document and a column per item."""
        row, item = np.nonzero((scores > 0) & (scores >= self.least))
        if not len(row):
            return
        held = [np.concatenate(pair) for pair in (
            (self.item, item), (self.score, scores[row, item]), (self.doc, docs[row]), (self.null, null[row])
        )]
        order = np.lexsort((held[2], held[3], -held[1], held[0]))
        items = held[0][order]
        first = np.concatenate([[True], items[1:] != items[:-1]])
        place = np.arange(len(items)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        order = order[place < self.top]
        self.item, self.score, self.doc, self.null = (column[order] for column in held)
        last = np.flatnonzero(np.bincount(self.item, minlength=len(self.least)) == self.top)
        if len(last):
            ends = np.searchsorted(self.item, last, side="right") - 1
            self.least[last] = self.score[ends]


def _statistics(docs: DataFrame, automaton) -> tuple[int, int, dict[int, int]]:
    """Documents with terms, their terms, and of each pattern the documents that hold it.

    Tasks count what they read; their counts are summed before they come to the driver, as
    many as the automaton has patterns.
    """

    def count(batches):
        scan = Scanner(pickle.loads(automaton.value))
        with_terms = terms = 0
        seen: dict[int, int] = {}
        for (text,) in rows_of(batches, ["text"]):
            n, which, _ = scan(text)
            with_terms += n > 0
            terms += n
            for number in which.tolist():
                seen[number] = seen.get(number, 0) + 1
        yield pa.RecordBatch.from_pydict({
            "number": pa.array([-2, -1, *seen], pa.int64()), "counted": pa.array([with_terms, terms, *seen.values()], pa.int64())
        })

    counted = docs.select(text_or_empty().alias("text")).mapInArrow(count, "number long, counted long")
    found = {r.number: r.counted for r in counted.groupBy("number").agg(F.sum("counted").alias("counted")).collect()}
    return found.pop(-2, 0), found.pop(-1, 0), found


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _best(docs: DataFrame, patterns: Patterns, top: int) -> DataFrame:
    """``item, doc_id, score``: of each task the best documents of each item."""
    context = docs.sparkSession.sparkContext
    automaton = context.broadcast(pickle.dumps(patterns.automaton()))
    documents, terms, holding = _statistics(docs, automaton)
    weights = np.array([weight(documents, holding.get(k, 0)) for k in range(len(patterns.terms))], np.int64)
    held = context.broadcast((patterns.starts, patterns.holders, patterns.times, weights, [i for i, _ in patterns.items]))

    def search(batches: Iterator[pa.RecordBatch]):
        scan = Scanner(pickle.loads(automaton.value))
        starts, holders, times, weights, items = held.value
        best = Best(len(items), top)
        # A few million scores at a time.
        most = max(1, min(256, (4 << 20) // len(items)))
        scores, docs, null = np.zeros((most, len(items)), np.int64), np.zeros(most, np.int64), np.zeros(most, bool)
        k = 0
        for doc_id, text in rows_of(batches, ["doc_id", "text"]):
            n, which, tf = scan(text)
            if not len(which):
                continue
            m = 100 - 25 + 25 * n * documents // terms
            worth = weights[which] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            many = starts[which + 1] - starts[which]
            # The places in the matrix of all rows of the patterns found.
            at = np.arange(many.sum()) + np.repeat(starts[which] - np.cumsum(many) + many, many)
            np.add.at(scores[k], holders[at], np.repeat(worth, many) * times[at])
            docs[k], null[k], k = doc_id or 0, doc_id is None, k + 1
            if k == most:
                best.add(scores, docs, null)
                scores[:] = k = 0
        best.add(scores[:k], docs[:k], null[:k])
        yield pa.RecordBatch.from_pydict({
            "item": pa.array(np.array(items, np.int64)[best.item]),
            "doc_id": pa.array(best.doc, pa.int64(), mask=best.null),
            "score": pa.array(best.score),
            "part": pa.array(np.full(len(best.item), TaskContext.get().partitionId() % PARTS)),
        })

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        search, "item long, doc_id long, score long, part long"
    )


def search(docs: DataFrame, items: DataFrame, top: int = TOP, most_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The best documents of each item: ``item, item_id, rank, doc_id, score``.

    ``docs`` has ``doc_id, text`` and ``items`` has ``item_id, text``; other columns are not
    looked at. Documents are read twice for each block of items: once for the statistics of
    the collection, once for the scores. A task keeps the best of each item, whatever it
    reads; those of all tasks meet in two steps. Numbers are 64-bit integers, so the result
    does not depend on how the documents are dealt to tasks.

    Null text has no terms, as the empty one; documents without terms do not count and items
    without terms have no rows. Every row of ``docs`` is a document and every row of ``items``
    an item, repeated ones too: an ``item_id`` that comes twice is ranked twice, ``item`` tells
    which. Equal scores are ranked by ``doc_id``, null ids last. Very long texts are scanned
    whole. Empty tables give no rows.
    """
    dealt, blocks = blocks_of_items(item_terms(items), most_bytes)
    found = []
    for block in blocks:
        patterns = Patterns.of(dealt.where(F.col("block") == block).select("item", "item_id", "term", "times").collect())
        found.append(stored(_best(docs, patterns, top), "best"))
    if not found:
        empty = "item long, doc_id long, score long, part long"
        found = [docs.sparkSession.createDataFrame([], empty)]
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["item", "part"], ["item"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        best = best.withColumn("rank", place).where(F.col("rank") <= top)
    named = dealt.select("item", "item_id").distinct()
    return best.join(named, "item").select("item", "item_id", "rank", "doc_id", "score")
