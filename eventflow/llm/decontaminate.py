"""Benchmark decontamination: a positional inverted index of the training text."""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.common import small_side, stored, text_or_empty

# What separates words once A to Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# Most rows of a side that is broadcast; tables beyond are joined by shuffling.
MOST_ROWS = 1_000_000
# Stands for a document in the index; no word has a space. Its position is the number of words.
DOCUMENT = " "
KEY = ["doc", "same"]


def tokens(table: DataFrame, keep: list[Column], text: Column) -> DataFrame:
    """One row per word, with its ``pos`` from 0; and one with ``DOCUMENT`` for each text."""
    lower = F.translate(text, ascii_uppercase, ascii_lowercase)
    split = table.select(*keep, F.split(lower, BETWEEN, -1).alias("parts"))
    # The text may begin and end with what separates words; the parts there are empty.
    parts = F.col("parts")
    lead = (parts[0] == "").cast("int")
    trail = ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    names = [c for c in split.columns if c != "parts"]
    return (
        split.select(*names, lead.alias("lead"), trail.alias("trail"), F.posexplode(F.array_append(parts, DOCUMENT)))
        .select(
            *names, F.col("col").alias("word"),
            (F.col("pos") - F.col("lead") - F.when(F.col("col") == DOCUMENT, F.col("trail")).otherwise(0)).alias("pos"),
        )
        .where(F.col("word") != "")
    )


@dataclass
class Index:
    """Postings ``term, doc, same, pos``, ordered by term within each file, and the terms' numbers.

    ``doc`` is the document's id and ``same`` a hash of its text, so that repeated ids with
    different texts are different documents. ``documents`` has a row per input row.
    """

    terms: DataFrame
    postings: DataFrame
    documents: DataFrame
    frequency: DataFrame


def _same() -> Column:
    """A hash of the text that also tells a missing id from 0."""
    return F.xxhash64(text_or_empty(), F.col("doc_id").isNull())


def build_index(docs: DataFrame, vocabulary: DataFrame) -> Index:
    """The positional inverted index of ``doc_id, text`` rows for the words of ``vocabulary``.

    ``vocabulary`` has the column ``word``: those that queries consist of; no other list can
    be asked for. Each task writes the lists of its own documents, so a frequent word is
    spread over all files and nothing is shuffled. Null text has no words.
    """
    terms = stored(
        vocabulary.select("word").distinct().where(F.col("word") != DOCUMENT)
        .select("word", (F.monotonically_increasing_id() + 1).alias("term"))
        .unionByName(docs.sparkSession.range(1).select(F.lit(DOCUMENT).alias("word"), F.lit(0).cast("bigint").alias("term"))),
        "terms",
    )
    text = text_or_empty()
    keep = [F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("doc"), _same().alias("same"), F.col("doc_id")]
    found = (
        tokens(docs, keep, text).join(small_side(terms, MOST_ROWS), "word")
        .select("term", "doc", "same", F.when(F.col("term") == 0, F.col("doc_id")).alias("doc_id"), "pos")
        .sortWithinPartitions("term")
    )
    table = stored(found, "postings")
    postings = table.where(F.col("term") > 0).drop("doc_id")
    documents = table.where(F.col("term") == 0).select("doc_id", *KEY, F.col("pos").cast("bigint").alias("n_words"))
    frequency = stored(postings.groupBy("term").agg(F.count(F.lit(1)).alias("frequency")), "frequency")
    return Index(terms, postings, documents, frequency)


def item_terms(index: Index, words: DataFrame) -> DataFrame:
    """The words of test items with their term numbers and how often they occur in training."""
    numbered = words.join(small_side(index.terms, MOST_ROWS), "word")
    return numbered.join(small_side(index.frequency, MOST_ROWS), "term", "left").select(
        "item", "at", "length", "term", F.coalesce("frequency", F.lit(0)).alias("frequency")
    )


def _anchors(items: DataFrame, window: int) -> DataFrame:
    """Of each window of items, the positions and terms of the two rarest words."""
    span = F.least(F.lit(window), F.col("length"))
    first = F.greatest(F.lit(0), F.col("at") - span + 1)
    last = F.least(F.col("at"), F.col("length") - span)
    ranked = (
        items.select("item", F.explode(F.sequence(first, last)).alias("start"), F.struct("frequency", "at", "term").alias("word"))
        .groupBy("item", "start").agg(F.sort_array(F.collect_list("word")).alias("words"))
    )
    rarest, second = F.col("words")[0], F.coalesce(F.get("words", F.lit(1)), F.col("words")[0])
    # A word that does not occur rules its windows out.
    return ranked.where(rarest["frequency"] > 0).select(
        "item", rarest["at"].alias("at"), rarest["term"].alias("term"),
        second["at"].alias("at2"), second["term"].alias("term2"),
    ).distinct()


def phrase_matches(index: Index, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every stretch of words that a document and an item have in common, a window long at least.

    ``items`` comes from ``item_terms``. Returns ``item, doc, same, first, last``: positions
    of the document. The list of a window's rarest term gives places where the window could
    lie; places that its second rarest term does not confirm go; for the others the lists of
    all of the item's words are intersected, each moved by its offset. An item shorter than
    a window must be there whole.
    """
    anchors = stored(_anchors(items, window), "anchors")
    lists = index.postings
    places = lists.join(small_side(anchors, MOST_ROWS), "term").select(
        "item", *KEY, (F.col("pos") - F.col("at")).alias("moved"), "at2", F.col("term2").alias("term")
    ).distinct()
    asked = anchors.select(F.col("term2").alias("term")).distinct()
    confirmed = lists.join(small_side(asked, MOST_ROWS), "term", "left_semi").select(
        "term", *KEY, F.col("pos").alias("pos")
    )
    places = stored(
        places.withColumn("pos", F.col("moved") + F.col("at2")).join(confirmed, ["term", *KEY, "pos"], "left_semi")
        .select("item", *KEY, "moved").distinct(),
        "places",
    )
    near = lists.join(small_side(places.select(*KEY).distinct(), MOST_ROWS), KEY, "left_semi")
    asked = places.join(small_side(items, MOST_ROWS), "item").select(
        "item", *KEY, "moved", "at", "length", "term", (F.col("at") + F.col("moved")).alias("pos")
    )
    agreed = asked.join(near, ["term", *KEY, "pos"], "left_semi")
    order = Window.partitionBy("item", *KEY, "moved").orderBy("at")
    return (
        agreed.withColumn("run", F.col("at") - F.dense_rank().over(order))
        .groupBy("item", *KEY, "moved", "run", "length").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
        .where(F.col("last") - F.col("first") + 1 >= F.least(F.lit(window), F.col("length")))
        .select("item", *KEY, "first", "last")
    )


def proximity_matches(index: Index, items: DataFrame, within: int) -> DataFrame:
    """Documents in which all different words of an item lie around its rarest, in any order.

    Returns ``item, doc, same, pos``: places of the rarest word that have each other word
    at most ``within`` words away. Positions meet in blocks of that length, so lists join by
    equality and no pairs beyond neighbouring blocks are made.
    """
    words = items.groupBy("item", "term").agg(F.min("frequency").alias("frequency"))
    asked = words.groupBy("item").agg(
        F.min(F.struct("frequency", "term")).alias("rarest"), F.count(F.lit(1)).alias("n")
    ).where(F.col("rarest.frequency") > 0)
    block = F.floor(F.col("pos") / F.lit(within + 1))
    start = index.postings.join(
        small_side(asked.select("item", "n", F.col("rarest.term").alias("term")), MOST_ROWS), "term"
    ).select("item", "n", *KEY, F.col("pos").alias("place"), F.explode(F.array(block - 1, block, block + 1)).alias("block"))
    others = index.postings.join(small_side(words.select("item", "term"), MOST_ROWS), "term").withColumn("block", block)
    return (
        start.join(others, ["item", *KEY, "block"])
        .where(F.abs(F.col("pos") - F.col("place")) <= within)
        .groupBy("item", *KEY, "place", "n").agg(F.count_distinct("term").alias("found"))
        .where(F.col("found") == F.col("n")).select("item", *KEY, F.col("place").alias("pos"))
    )


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    """The words of items: ``item, item_id, word, at, length``. Null text has none."""
    rows = stored(
        benchmark.select("item_id", text_or_empty().alias("text"), F.monotonically_increasing_id().alias("item")), "items"
    )
    words = tokens(rows, [F.col("item"), F.col("item_id")], F.col("text"))
    length = words.where(F.col("word") == DOCUMENT).select("item", F.col("pos").alias("length"))
    return words.where(F.col("word") != DOCUMENT).withColumnRenamed("pos", "at").join(
        small_side(length, MOST_ROWS), "item"
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """How much of each document's text is that of benchmark items.

    Returns a row per document: doc_id, same (hash of the text), n_words, n_hit (words
    inside an occurrence of a window of an item), n_items, item_ids (as strings, sorted).
    Null text has no words; a document or item without words has no hits. Items of one id
    count once; an item without id marks words but is not listed. Repeated rows get equal
    results, one each. Empty tables give no rows, or rows without hits. Very long texts are
    read whole; other columns are not looked at.
    """
    words = stored(benchmark_words(benchmark), "words")
    index = build_index(docs, words)
    found = stored(phrase_matches(index, item_terms(index, words), window), "matches")
    hit = (
        found.select(*KEY, F.explode(F.sequence("first", "last")).alias("pos")).distinct()
        .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_hit"))
    )
    named = found.join(small_side(words.select("item", "item_id").distinct(), MOST_ROWS), "item")
    ids = named.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    return (
        index.documents.join(hit.join(ids, KEY), KEY, "left")
        .select(
            "doc_id", "same", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
        .withColumn("n_items", F.size("item_ids").cast("bigint"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a word inside an occurrence of a benchmark window.

    Only keys of those that go are joined; texts are not moved if these are few.
    """
    doc = F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("doc")
    gone = contamination(docs, benchmark, window).where(F.col("n_hit") > 0).select(doc, "same").distinct()
    keyed = docs.select(F.struct("*").alias("carried"), doc, _same().alias("same"))
    return keyed.join(gone, KEY, "left_anti").select("carried.*")
