"""Toxicity classifier that does not mind which group a text mentions."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import single_threaded, text_or_empty
from eventflow.llm.features import word_beginnings
from eventflow.llm.quality import Leader, with_bias

PASSES = 5
PAIR = np.dtype([("at", np.int32), ("value", np.float32)])
# Strength of the absolute penalty, which leaves words without evidence at zero, and of the
# penalty on what a swap of identity terms changes in the score before the logistic function.
L1 = 1.0
COUNTERFACTUAL = 0.5
# Identity terms by what they can be swapped with; the first of each is neutral.
IDENTITIES = [
    "people women men girls boys".split(),
    "person woman man girl boy".split(),
    "believers christians muslims jews hindus buddhists atheists catholics protestants".split(),
    "religious christian muslim jewish hindu buddhist atheist catholic protestant".split(),
    "citizens immigrants refugees foreigners migrants natives".split(),
    "local african american asian european arab mexican chinese indian russian turkish black white latino".split(),
    "single gay lesbian straight bisexual transgender queer heterosexual homosexual".split(),
    "working old young elderly disabled blind deaf poor rich".split(),
    "leute frauen männer mädchen jungen juden muslime christen ausländer".split(),
    "gens femmes hommes filles garçons juifs musulmans chrétiens étrangers".split(),
    "gente mujeres hombres chicas chicos judíos musulmanes cristianos extranjeros".split(),
]
GROUP = {term: group for group in IDENTITIES for term in group}
TERM = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, GROUP), key=len, reverse=True)) + r")(?!\w)", re.I)


def swapped(text: str) -> str | None:
    """The text with each identity term replaced by another of its group, or None if it has none.

    Which one is told by a hash of text and term, the same wherever the term stands.
    """
    if not TERM.search(text):
        return None
    seed = crc32(text.encode())

    def other(found: re.Match) -> str:
        term = found.group().lower()
        group = GROUP[term]
        step = 1 + crc32(term.encode(), seed) % (len(group) - 1)
        return group[(group.index(term) + step) % len(group)]

    return TERM.sub(other, text)


def _packed(at: np.ndarray, values: np.ndarray) -> bytes:
    return np.rec.fromarrays([at, values], dtype=PAIR).tobytes()


def _unpacked(data) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(data, PAIR)
    return pairs["at"], pairs["value"]


def _difference(one: tuple, other: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The sparse vector that is one less the other."""
    at, back = np.unique(np.concatenate([one[0], other[0]]), return_inverse=True)
    values = np.bincount(back, weights=np.concatenate([one[1], -other[1]]), minlength=len(at)).astype(np.float32)
    return at[values != 0].astype(np.int32), values[values != 0]


def fit_toxicity(sample: DataFrame, strength: float = COUNTERFACTUAL) -> np.ndarray:
    """Weights fitted on a bounded sample of ``doc_id, text, label`` rows.

    Logistic loss, plus ``strength`` times the squared change of the linear score when
    identity terms are swapped. Texts become word positions on the executors; these come to
    the driver, for a sample whose size the caller has bounded. An empty sample gives
    weights of zero.
    """

    def positions(batches):
        single_threaded()
        for frame in batches:
            rows = []
            for text in frame["text"]:
                own, other = word_beginnings(text), swapped(text)
                rows.append((_packed(*own), None if other is None else _packed(*_difference(own, word_beginnings(other)))))
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "label": frame["label"].astype("int32"),
                "vector": [a for a, _ in rows], "change": pd.Series([b for _, b in rows], dtype=object),
            })

    found = sample.select("doc_id", "text", "label").mapInPandas(
        positions, "doc_id long, label int, vector binary, change binary"
    ).toArrow().sort_by("doc_id")
    rows = [
        (_unpacked(vector.as_buffer()), _unpacked(change.as_buffer()) if change.is_valid else None, float(label.as_py()))
        for label, vector, change in zip(found["label"], found["vector"], found["change"])
    ]
    return fitted(rows, strength)


def fitted(rows: list[tuple], strength: float) -> np.ndarray:
    """Weights from rows of vector, change of the vector by the swap (or None), and label."""
    leader = Leader(absolute=L1)
    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for k in order.permutation(len(rows)):
            vector, change, label = rows[k]
            leader.learn(*with_bias(*vector), label)
            if change is not None and len(change[0]):
                at, values = change
                leader.step(at, 2 * strength * np.dot(leader.weights(at), values) * values)
    return leader.weights(slice(None)).astype(np.float32)


def score_toxicity(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows with a ``toxicity`` from 0 to 1, of the whole text.

    Null text is empty text, whose score is that of the bias alone; very long texts are read
    whole. Rows are scored each by itself: repeated rows get equal scores, an empty table gives
    no rows. All columns stay, but one that is called ``toxicity`` before.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        single_threaded()
        w = shared.value

        def one(text):
            at, values = with_bias(*word_beginnings(text))
            return 1 / (1 + np.exp(-float(np.dot(w[at], values))))

        return texts.map(one).astype(float)

    return docs.withColumn("toxicity", score(text_or_empty()))
