"""Quality classifier: hashed word n-grams, logistic regression, follow the regularised leader."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import single_threaded, text_or_empty
from eventflow.llm.features import BITS, word_ngrams

# Bound of the sample that the classifier is fitted on; passes over it.
MOST_ROWS = 10_000
PASSES = 5
# Step size, its start, and the strengths of the absolute and the squared penalty.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
ACCEPT = 0.7
BIAS = 0


class Leader:
    """Follow-the-regularised-leader updates, each coordinate with its own step size."""

    def __init__(self, bits: int = BITS, absolute: float = L1):
        self.gradients = np.zeros(1 << bits)
        self.squares = np.zeros(1 << bits)
        self.absolute = absolute

    def weights(self, at) -> np.ndarray:
        total, squares = self.gradients[at], self.squares[at]
        pulled = np.sign(total) * np.maximum(np.abs(total) - self.absolute, 0)
        return -pulled / ((BETA + np.sqrt(squares)) / ALPHA + L2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: float) -> None:
        score = 1 / (1 + np.exp(-np.dot(self.weights(at), values)))
        self.step(at, (score - label) * values)

    def step(self, at: np.ndarray, gradient: np.ndarray) -> None:
        weights = self.weights(at)
        before = self.squares[at]
        after = before + gradient * gradient
        self.gradients[at] += gradient - (np.sqrt(after) - np.sqrt(before)) / ALPHA * weights
        self.squares[at] = after


def with_bias(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vector with the constant feature, which has position 0 to itself."""
    own = at != BIAS
    return np.append(at[own], np.int32(BIAS)), np.append(values[own], np.float32(1))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, training, most_rows: int = MOST_ROWS
) -> DataFrame:
    """Texts and labels of at most ``most_rows`` labelled rows, chosen by a hash of their id.

    ``training`` is the condition on the id for rows that may be learned from. Only ids go
    through the choice; texts of chosen rows are picked by a broadcast of these few ids.
    Repeated labels or rows of an id count once, by their smallest; those without label or
    id don't.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(training)
        .groupBy("doc_id").agg(F.min(label).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    )
    found = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    # Combined on the map side, so that an id of very many rows is one row of the sample.
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))


def fit_quality(sample: DataFrame) -> np.ndarray:
    """Weights fitted on a bounded sample of ``doc_id, text, label`` rows.

    Texts become vectors on the executors; what comes to the driver are the vectors of a
    sample whose size the caller has bounded. An empty sample gives weights of zero, with
    which every score is 0.5.
    """

    def vectors(batches):
        single_threaded()
        for frame in batches:
            both = [word_ngrams(t) for t in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "label": frame["label"].astype("int32"),
                "at": [a.tobytes() for a, _ in both], "value": [v.tobytes() for _, v in both],
            })

    found = sample.select("doc_id", "text", "label").mapInPandas(
        vectors, "doc_id long, label int, at binary, value binary"
    ).toArrow().sort_by("doc_id")
    rows = [
        (*with_bias(np.frombuffer(at.as_buffer(), np.int32), np.frombuffer(value.as_buffer(), np.float32)), float(label.as_py()))
        for label, at, value in zip(found["label"], found["at"], found["value"])
    ]
    leader = Leader()
    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for k in order.permutation(len(rows)):
            leader.learn(*rows[k])
    return leader.weights(slice(None)).astype(np.float32)


def score_quality(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows with a ``quality_score`` from 0 to 1, of the whole text.

    Null text is empty text, whose score is that of the bias alone; very long texts are read
    whole. Rows are scored each by itself: repeated rows get equal scores, an empty table gives
    no rows. All columns stay, but one that is called ``quality_score`` before.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        single_threaded()
        w = shared.value

        def one(text):
            at, values = with_bias(*word_ngrams(text))
            return 1 / (1 + np.exp(-float(np.dot(w[at], values))))

        return texts.map(one).astype(float)

    return docs.withColumn("quality_score", score(text_or_empty()))
