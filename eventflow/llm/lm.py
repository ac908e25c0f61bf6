"""Scoring of whole documents by language models learned from the corpus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.llm import recurrent
from eventflow.llm.common import single_threaded, stored, text_or_empty

# Words whose counts every task holds; counts of others are joined.
FREQUENT = 1 << 17
SMOOTHING = 0.1
# The end of a text as a word; words hold no blanks.
END = b"\n"
# Training documents of the start that all tasks go on from, and passes over them.
START_DOCUMENTS, START_PASSES = 512, 4
# Distinct words that a task holds before it hands their counts on.
HELD = 500_000
# Bytes of text whose words a task looks up at once; one text more may be among them.
TEXT = 1 << 22
# Tokens that a task holds before it scores them: few steps are for the longest texts alone.
SCORED = 1 << 22
# Weights that are averaged in one row.
TOGETHER = 1 << 10


def words_of(text: str) -> list[bytes]:
    """Words between blanks (space, and the controls 9 to 13), A to Z in lower case: the plain form of ``split_words``."""
    return text.encode().lower().split()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as ``words_of`` has them, one text after the other, and where each text's begin and end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, starts = lists.flatten().cast(pa.binary()), lists.offsets.to_numpy()
    starts = starts - starts[0]
    # Blanks at both ends of a text leave empty words there.
    real = pc.binary_length(words).to_numpy() > 0
    if not real.all():
        words, starts = words.filter(pa.array(real)), np.append(0, np.cumsum(real))[starts]
    return words, starts


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, cut where their texts have ``TEXT`` bytes."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index("text"))).to_numpy().astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // TEXT)) + 1
        for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if end > first:
                yield batch.slice(first, end - first)


@dataclass
class Corpus:
    """Counts of all training tokens: per word, their sum, and the number of words."""

    counts: DataFrame
    tokens: int
    words: int
    frequent: list[tuple[bytes, int]]


def count_words(docs: DataFrame) -> DataFrame:
    """``word, count`` of all texts; each text has an ``END``."""

    def count(batches):
        single_threaded()
        names = ["word", "count"]
        held, rows = [], 0

        def merged():
            counted = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("count", "sum")])
            return counted.rename_columns({"count_sum": "count"}).select(names)

        for part in parts_of(batches):
            words, _ = split_words(part.column(part.schema.get_field_index("text")))
            held.append(pa.Table.from_arrays(words.value_counts().flatten(), names))
            held.append(pa.table([pa.array([END], pa.binary()), pa.array([part.num_rows], pa.int64())], names))
            rows += len(held[-2]) + 1
            if rows > 2 * HELD:
                held = [merged()]
                rows = len(held[0])
                if rows > HELD:
                    yield from held[0].to_batches()
                    held, rows = [], 0
        if held:
            yield from merged().to_batches()

    counted = docs.select(text_or_empty().alias("text")).mapInArrow(count, "word binary, count long")
    return counted.groupBy("word").agg(F.sum("count").alias("count"))


def read_corpus(docs: DataFrame, training: Column, frequent: int = FREQUENT) -> Corpus:
    """Counts over all documents for which ``training`` holds.

    At most ``frequent`` words are listed as frequent: those of the highest counts, whole
    classes of about equal counts at a time, so that no order of all words is needed.
    """
    counts = stored(count_words(docs.where(training)), "counts")
    sums = counts.agg(F.sum("count").alias("tokens"), F.count(F.lit(1)).alias("words")).first()
    size = F.floor(F.log2("count") * 16)
    bins = sorted(counts.groupBy(size.alias("size")).count().collect(), key=lambda r: -r["size"])
    least, listed = None, 0
    for row in bins:
        if listed + row["count"] > frequent:
            break
        least, listed = row["size"], listed + row["count"]
    chosen = [] if least is None else [
        (bytes(r.word), r["count"]) for r in counts.where(size >= least).collect()
    ]
    chosen.sort(key=lambda x: (-x[1], x[0]))
    return Corpus(counts, int(sums.tokens or 0), int(sums.words), chosen)


@dataclass
class LanguageModel:
    """A vocabulary, the weights of the recurrent model, and what all other words share."""

    vocabulary: dict[bytes, int]
    weights: dict[str, np.ndarray]
    rare_tokens: int
    rare_words: int


def _positions(text: str, vocabulary: dict[bytes, int]) -> np.ndarray:
    """The plain form of ``positions_of``, for one text."""
    rare = len(vocabulary)
    found = [vocabulary.get(w, rare) for w in words_of(text)]
    found.append(recurrent.END)
    return np.array(found, np.int32)


def positions_of(texts: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What ``_positions`` gives for each of the texts, one after the other, and where each begins and ends."""
    found, starts = split_words(texts)
    at = pc.index_in(found, value_set=words).fill_null(len(words)).to_numpy()
    return np.insert(at, starts[1:], recurrent.END), starts + np.arange(len(starts))


def fit(docs: DataFrame, training: Column, corpus: Corpus) -> LanguageModel:
    """The recurrent model, trained on all documents for which ``training`` holds.

    The vocabulary are the most frequent words, more of them the more distinct words the
    corpus has, as far as they are listed as frequent; others are one class, in which their
    smoothed counts tell them apart. One task trains a start on a bounded number of
    documents. From there each task trains on all of its own documents, and the weights are
    averaged by tokens, each block of them in one task: what comes to the driver is one set.
    """
    known = [(w, c) for w, c in corpus.frequent if w != END][: recurrent.vocabulary_size(corpus.words) - 1]
    ends = next((c for w, c in corpus.frequent if w == END), 0)
    if not ends and corpus.tokens:
        ends = corpus.counts.where(F.col("word") == F.lit(END)).first()["count"]
    vocabulary = {END: recurrent.END} | {w: k + 1 for k, (w, _) in enumerate(known)}
    counts = np.array([ends] + [c for _, c in known], float)
    rare_tokens = corpus.tokens - int(counts.sum())
    weights = recurrent.initial(counts, rare_tokens)
    rows = docs.where(training).select("doc_id", text_or_empty().alias("text"))
    first = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(START_DOCUMENTS)
    start = rows.join(F.broadcast(first), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).repartition(1)
    weights = _trained(start, weights, vocabulary, START_PASSES)
    weights = _trained(rows, weights, vocabulary, 1)
    return LanguageModel(vocabulary, weights, rare_tokens, corpus.words - len(counts) + (ends == 0))


def _trained(docs: DataFrame, weights: dict[str, np.ndarray], vocabulary: dict[bytes, int], passes: int) -> dict:
    """Weights after each task's training on its own documents, averaged by tokens."""
    shared = docs.sparkSession.sparkContext.broadcast((weights, sorted(vocabulary, key=vocabulary.get)))

    def blocks(values, tokens):
        starts = np.append(np.arange(0, len(values), TOGETHER), len(values))
        rows = len(starts) - 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(rows)), pa.array(np.full(rows, tokens, np.int64)),
                pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values.astype(np.float32))),
            ],
            ["block", "tokens", "value"],
        )

    def train(batches):
        single_threaded()
        start, known = shared.value
        known = pa.array(known, pa.binary())
        trainer, tokens = recurrent.Trainer(start), 0
        kept = []

        def learn(held):
            trainer.learn(np.concatenate(held))

        held, size = [], 0
        for part in parts_of(batches):
            positions, starts = positions_of(part.column(0), known)
            for first, end in zip(starts, starts[1:]):
                held.append(positions[first:end])
                size += int(end - first)
                if size >= 1 << 18:
                    learn(held)
                    tokens += size
                    if passes > 1:
                        kept.append(np.concatenate(held))
                    held, size = [], 0
        if size:
            learn(held)
            tokens += size
            kept += [np.concatenate(held)] if passes > 1 else []
        for _ in range(passes - 1):
            for part in kept:
                trainer.learn(part)
        if tokens:
            yield blocks(recurrent.flat(trainer.weights), tokens)

    shares = docs.select("text").mapInArrow(train, "block long, tokens long, value array<float>")
    found = shares.repartition("block").mapInArrow(_averages, "block long, value array<double>").toArrow()
    if not found.num_rows:
        return weights
    values = recurrent.flat(weights).astype(np.float64)
    for block, value in zip(found["block"].to_pylist(), found["value"]):
        values[block * TOGETHER :][: len(value)] = value.values.to_numpy()
    return recurrent.like(values, weights)


def _averages(batches):
    """Of each block its mean by tokens; what is held is a sum for each block of the task."""
    sums, tokens = {}, Counter()
    for batch in batches:
        for block, n, value in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("block", "tokens", "value"))):
            block, n = block.as_py(), n.as_py()
            value = value.values.to_numpy().astype(np.float64) * n
            sums[block] = sums[block] + value if block in sums else value
            tokens[block] += n
    for block, total in sums.items():
        value = pa.ListArray.from_arrays(pa.array([0, len(total)], pa.int32()), pa.array(total / tokens[block]))
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), value], ["block", "value"])


def score(docs: DataFrame, model: LanguageModel, corpus: Corpus) -> DataFrame:
    """The log10-likelihood of each whole text under the smoothed counts and under the model.

    Returns a row per input row: doc_id, n_tokens, n_known (tokens seen in training),
    base_score, score. Null text is empty text, which has its end alone; ids may be null,
    repeated rows get equal results each; very long texts are scored whole; other columns are not
    looked at; an empty table gives no rows. Of words of equal counts the first in byte order is
    in the vocabulary. The weights, and so the scores, depend on how the table is dealt to
    tasks. Without training tokens each token has probability 1 under the counts. Frequent words are looked up in the task; the others, one row per
    document and word, are joined with the counts.
    """
    spark = docs.sparkSession
    # One number for each frequent word, those of the vocabulary first and in its order.
    number = dict(model.vocabulary)
    for word, _ in corpus.frequent:
        number.setdefault(word, len(number))
    counts = dict(corpus.frequent)
    logs = np.array([np.log10(counts[w] + SMOOTHING) if w in counts else np.nan for w in number])
    shared = spark.sparkContext.broadcast((list(number), logs, model.weights, len(model.vocabulary)))
    base_sum = np.log10(corpus.tokens + SMOOTHING * (corpus.words + 1))
    rare_sum = np.log10(model.rare_tokens + SMOOTHING * (model.rare_words + 1))
    schema = (
        "row long, doc_id long, n_tokens long, n_known long, base_score double, score double, "
        "words array<binary>, times array<long>"
    )

    def parts(batches):
        single_threaded()
        listed, logs, weights, known = shared.value
        listed = pa.array(listed, pa.binary())
        # The end is in the vocabulary, as its first word, and may be there without being frequent.
        end = logs[recurrent.END]
        counts_end = not np.isnan(end)

        def columns(part):
            """All columns but the score, of which the words that are not in the model's vocabulary; positions of each text."""
            n = part.num_rows
            row, doc_id, text = (part.column(part.schema.get_field_index(c)) for c in ("row", "doc_id", "text"))
            words, starts = split_words(text)
            at = pc.index_in(words, value_set=listed).fill_null(-1).to_numpy()
            owner = np.repeat(np.arange(n), np.diff(starts))
            found = at >= 0
            value = np.where(found, logs[at], 0)
            n_known = np.bincount(owner[found], minlength=n) + counts_end
            base = np.bincount(owner, weights=value, minlength=n) - n_known * base_sum + (end if counts_end else 0)
            rare = at >= known
            rare_score = np.bincount(owner[rare], weights=value[rare] - rare_sum, minlength=n)
            positions = np.insert(np.where(found & ~rare, at, known), starts[1:], recurrent.END)
            limits = starts + np.arange(n + 1)
            texts = [positions[a:b] for a, b in zip(limits, limits[1:])]
            # Words that are not listed, once for each text.
            left = words.filter(pa.array(~found)).dictionary_encode()
            kinds = len(left.dictionary) + 1
            keys = owner[~found] * kinds + left.indices.to_numpy()
            if not counts_end:
                keys = np.append(keys, np.arange(n) * kinds + kinds - 1)
            keys, times = np.unique(keys, return_counts=True)
            names = pa.concat_arrays([left.dictionary, pa.array([END], pa.binary())])
            offsets = pa.array(np.searchsorted(keys, np.arange(n + 1) * kinds), pa.int32())
            return [
                row, doc_id.cast(pa.int64()), pa.array(np.diff(limits), pa.int64()), pa.array(n_known, pa.int64()),
                pa.array(base), rare_score,
                pa.ListArray.from_arrays(offsets, names.take(pa.array(keys % kinds))),
                pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
            ], texts

        def scored(held):
            scores = recurrent.score_texts([t for _, texts in held for t in texts], weights) / np.log(10)
            for out, texts in held:
                out[5], scores = pa.array(out[5] + scores[: len(texts)]), scores[len(texts) :]
                yield pa.RecordBatch.from_arrays(out, [c.split()[0] for c in schema.split(", ")])

        held, size = [], 0
        for part in parts_of(batches):
            held.append(columns(part))
            size += sum(map(len, held[-1][1]))
            if size >= SCORED:
                yield from scored(held)
                held, size = [], 0
        if held:
            yield from scored(held)

    given = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_or_empty().alias("text"))
    found = stored(given.mapInArrow(parts, schema), "scores")
    each = found.select("row", F.explode(F.arrays_zip("words", "times")).alias("pair"))
    others = each.select("row", F.col("pair.words").alias("word"), F.col("pair.times").alias("times")).join(
        corpus.counts, "word", "left"
    )
    value = F.log10(F.coalesce("count", F.lit(0)) + SMOOTHING) * F.col("times")
    outside = F.col("word") != F.lit(END)
    more = others.groupBy("row").agg(
        F.sum(F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(value - F.col("times") * F.lit(float(base_sum))).alias("more_base"),
        F.sum(F.when(outside, value - F.col("times") * F.lit(float(rare_sum))).otherwise(0.0)).alias("more_score"),
    )
    whole = found.drop("words", "times").join(more, "row", "left")
    none = F.lit(0)
    return whole.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", none)).alias("n_known"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
