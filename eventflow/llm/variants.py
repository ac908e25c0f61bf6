"""Grouping of spelling variants: words one edit apart, found by pivotal bigrams.

Bigrams are ordered by how often they occur in the words. Of each word the rarest ones are its
prefix, and two of the prefix that do not overlap are its pivots. One edit changes at most one
of two disjoint bigrams, so of two words one edit apart, the one whose prefix ends at the rarer
bigram has a pivot in the other's prefix: everything as rare as that lies in it. Where a bigram
repeats within a word, of those as rare as the prefix's last one more places belong to it, as
many as an edit can make.

The position limits are used in full. Let the pivots begin at a < b. If the edit comes after
the first pivot, all up to the end of that pivot is as it was; otherwise all from the second
pivot on is. So prefixes are indexed by bigram with what precedes it, and by bigram with what
follows it, beside the word's length; and a word asks for two entries at three lengths.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import rows_of, small_side, stored, text_or_empty

LEAST_LENGTH = 7
LEAST_COUNT = 2
# Every such number of a document's runs, by hash, loses a letter.
DAMAGED = 31
# How many times as frequent as a word its form is.
FORM_RATIO = 10
# Most bigrams that an edit makes.
MADE = 2
# Bigrams of a prefix. Three suffice for one edit; two more let pivots lie further inside.
PREFIX = 5
# The letters beside A to Z, so there are at most (26 + 64) ** 2 bigrams.
OTHER_LETTERS = "À-ÿ"
# Entries of one key that meet in one place; more are dealt to several.
MOST_ENTRIES = 4096
MOST_ROWS = 1_000_000
SIDES = "key string, length int, asks boolean, word string, n long, last int, letters long"


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the runs of letters of ``doc_id, text`` rows, A to Z lower-cased.

    A run whose hash with the id is divisible by ``DAMAGED`` loses the letter that the hash
    names. Null text has no runs; a null id counts as the empty text in the hash.
    """
    lower = F.translate(text_or_empty(), ascii_uppercase, ascii_lowercase)
    runs = F.regexp_extract_all(lower, F.lit(f"[a-z{OTHER_LETTERS}]{{{least_length},}}"), F.lit(0))
    found = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run")
    ).withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    words = found.select(F.when(F.col("h") % DAMAGED == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


def bigram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram occurs in the words; there are at most as many as pairs of letters."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))
    counted = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("count"))
    return {r.gram: r["count"] for r in counted.collect()}


class Pivots:
    """Prefix and pivots of a word, by the counts of bigrams."""

    def __init__(self, counts: dict[str, int], prefix: int = PREFIX):
        ordered = sorted(counts, key=lambda gram: (counts[gram], gram))
        self.prefix, self.rank = prefix, {gram: k for k, gram in enumerate(ordered)}
        letters: dict[str, int] = {}
        for gram, count in counts.items():
            letters[gram[0]] = letters.get(gram[0], 0) + count
        self.starts = {letter: math.log(count) for letter, count in letters.items()}
        self.follows = {gram: math.log(count) - self.starts[gram[0]] for gram, count in counts.items()}

    def __call__(self, word: str) -> tuple[int, list[int], int, int]:
        """The rank at which the prefix ends, the places that belong to it, and the pivots' places."""
        grams = [word[k : k + 2] for k in range(len(word) - 1)]
        ranks = [self.rank[gram] for gram in grams]
        ordered = sorted(range(len(grams)), key=lambda k: (ranks[k], k))
        last = ranks[ordered[: self.prefix][-1]]
        first, second = self.choose(grams, sorted(ordered[: self.prefix]))
        return last, [k for k in ordered[: self.prefix + MADE] if ranks[k] <= last], first, second

    def choose(self, grams: list[str], places: list[int]) -> tuple[int, int]:
        """The two disjoint bigrams whose entries are rarest in sum, by dynamic programming.

        How many words share what a pivot is asked for with, all up to it or all from it on,
        is estimated from the counts as a chain of bigrams. From left to right the cheapest
        first pivot that ends before a place is carried on.
        """
        chain = [0.0]
        for gram in grams:
            chain.append(chain[-1] + self.follows[gram])
        head = self.starts[grams[0][0]]
        best = first = None
        waiting: list[tuple[int, float]] = []
        pair = (places[0], places[-1])
        for k in places:
            while waiting and waiting[0][0] <= k - 2:
                place, cost = waiting.pop(0)
                if first is None or cost < first[1]:
                    first = place, cost
            if first is not None:
                cost = first[1] + math.exp(self.starts[grams[k][0]] + chain[-1] - chain[k])
                if best is None or cost < best:
                    best, pair = cost, (first[0], k)
            waiting.append((k, math.exp(head + chain[k + 1])))
        return pair


def letters_of(word: str) -> int:
    """A bit per letter, as a signed number; one edit changes at most two bits."""
    bits = 0
    for letter in word:
        bits |= 1 << (ord(letter) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def sides(words: DataFrame, counts: dict[str, int], prefix: int = PREFIX) -> DataFrame:
    """Of each word the entries of its prefix and, with ``asks``, those its pivots ask for."""
    least = 3

    def entries(batches):
        pivots = Pivots(counts, max(least, prefix))
        names = [c.strip().split(" ")[0] for c in SIDES.split(",")]
        types = [pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.int32(), pa.int64()]
        rows: list[tuple] = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for word, n in rows_of(batches, ["word", "n"]):
            last, held, first, second = pivots(word)
            rest = (word, n, last, letters_of(word))
            for k in held:
                rows.append(("<" + word[: k + 2], len(word), False, *rest))
                rows.append((">" + word[k:], len(word), False, *rest))
            for length in (len(word) - 1, len(word), len(word) + 1):
                rows.append(("<" + word[: first + 2], length, True, *rest))
                rows.append((">" + word[second:], length, True, *rest))
            if len(rows) >= 16384:
                yield batch()
                rows = []
        if rows:
            yield batch()

    return words.mapInArrow(entries, SIDES)


def _spread(entries: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Askers and entries; keys with more than ``most`` of either meet in several places.

    Askers are cut into parts and so are entries; each part of the ones is copied to every part
    of the others, so that no pair is lost and none meets twice.
    """
    counted = entries.groupBy("key", "length").agg(
        F.count_if("asks").alias("askers"), F.count_if(~F.col("asks")).alias("held")
    )
    parts = counted.where(F.greatest("askers", "held") > most).select(
        "key", "length", F.ceil(F.col("askers") / most).alias("asker_parts"), F.ceil(F.col("held") / most).alias("held_parts")
    )
    dealt = entries.join(small_side(stored(parts, "parts"), MOST_ROWS), ["key", "length"], "left")

    def part(column: str) -> Column:
        return F.pmod(F.xxhash64("word"), F.coalesce(F.greatest(F.col(column), F.lit(1)), F.lit(1)))

    def copies(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.greatest(F.col(column), F.lit(1)), F.lit(1)) - 1))

    names = ["key", "length", "word", "n", "last", "letters"]
    asked = dealt.where("asks").select(*names, part("asker_parts").alias("a"), copies("held_parts").alias("b"))
    held = dealt.where(~F.col("asks")).select(*names, part("held_parts").alias("b"), copies("asker_parts").alias("a"))
    return asked, held


def near_pairs(words: DataFrame, prefix: int = PREFIX, most: int = MOST_ENTRIES) -> DataFrame:
    """``word, n, other, other_n``: all pairs of words one edit apart, each both ways and once.

    ``words`` has distinct words of four letters at least, of which three bigrams have two
    that are disjoint, and ``n``.
    """
    asked, held = _spread(stored(sides(words, bigram_counts(words), prefix), "sides"), most)
    meet: Callable[[str], Column] = lambda c: F.col(f"r.{c}") == F.col(f"s.{c}")
    on = meet("key") & meet("length") & meet("a") & meet("b")
    close = (
        (F.col("r.last") <= F.col("s.last"))
        & (F.bit_count(F.col("r.letters").bitwiseXOR(F.col("s.letters"))) <= 2)
        & (F.levenshtein("r.word", "s.word", 1) == 1)
    )
    pair = [F.struct(F.col(f"{x}.word").alias("word"), F.col(f"{x}.n").alias("n"), F.col(f"{y}.word").alias("other"),
                     F.col(f"{y}.n").alias("other_n")) for x, y in ("rs", "sr")]
    found = asked.alias("r").join(held.alias("s"), on & close).select(F.explode(F.array(*pair)).alias("p")).select("p.*")
    return found.repartition("word").dropDuplicates(["word", "other"])


def _roots(links: DataFrame, most_count: int, ratio: int) -> DataFrame:
    """``word, root``: the end of each word's chain of forms.

    A form is ``ratio`` times as frequent as the word, so chains are short; each round
    doubles the steps that a link spans.
    """
    reach = links.select("word", F.col("form").alias("root"))
    steps, spanned = max(1, math.ceil(math.log(max(most_count, 1), ratio))), 1
    while spanned < steps:
        reach = stored(reach, "reach")
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reach = reach.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        spanned *= 2
    return reach


def spelling_variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO,
    prefix: int = PREFIX, most: int = MOST_ENTRIES,
) -> DataFrame:
    """The words of ``doc_id, text`` rows with the form each is a variant of.

    Returns word, form, root, n, n_near, form_n: a row per distinct word of ``least_length``
    letters that occurs ``least_count`` times. Words are near if one letter is inserted, deleted
    or replaced. The form is the near word of largest ``n``, of equal ones the first in
    code-point order, if it is ``ratio`` times as frequent; root is the end of the chain of
    forms, the word itself if there is none.

    Null text has no words, nor has the empty one; very long texts and runs are read whole.
    Every row counts, repeated ones too. A null id counts as the empty text where letters are
    dropped by hash. Other columns are not looked at. An empty table gives no rows.
    """
    words = stored(count_words(docs, least_length, least_count), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form")))
    nearest = near_pairs(words, prefix, most).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.minus") >= ratio * F.col("n")
    joined = stored(
        words.join(nearest, "word", "left").select(
            "word", F.when(is_form, F.col("best.form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(is_form, -F.col("best.minus")).alias("form_n"),
        ),
        "nearest",
    )
    most_count = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(joined.where(F.col("form").isNotNull()), most_count, ratio)
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
