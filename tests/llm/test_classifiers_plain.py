"""Scores and updates of both classifiers against plain dictionaries, one feature at a time."""

import math
import random
import re
from zlib import crc32

import numpy as np
import pytest
from tables import EDGES, documents

from eventflow.llm import quality, toxicity
from eventflow.llm.features import BEGINNINGS, LENGTH, word_beginnings, word_ngrams

MASK = (1 << 18) - 1
TEXTS = EDGES + ["Same same SAME", "the the the", "He said: well, well!! And 12 more.", "ÉTÉ été Straße", "one-two_three 4.5"]


def vector(features, length):
    counts = {}
    for feature in features:
        counts[feature & MASK] = counts.get(feature & MASK, 0) + 1
    norm = math.sqrt(sum(math.log1p(n) ** 2 for n in counts.values()))
    return {at: length * math.log1p(n) / norm for at, n in counts.items()}


def plain_ngrams(text):
    words = text.encode().split()
    features = [crc32(p) for p in re.findall(rb"[0-9A-Za-z_\x80-\xff]+|[^\s0-9A-Za-z_\x80-\xff]+", text.encode())]
    for a, b in zip(words, words[1:]):
        features.append(1 if crc32(a) == crc32(b) else crc32(a) * 0x9E3779B1 % (1 << 32) ^ crc32(b))
    return vector(features + [2 if w.isupper() else 3 for w in words], 1.0)


def plain_beginnings(text):
    features = []
    for word in re.findall(rb"[a-z\x80-\xff]+", text.lower().encode()):
        features.append(crc32(word))
        features += [crc32(word[:size] + b"-") for size in BEGINNINGS if len(word) > size]
    return vector(features, LENGTH)


@pytest.mark.parametrize("fast, plain", [(word_ngrams, plain_ngrams), (word_beginnings, plain_beginnings)])
def test_vectors_are_the_plain_ones(fast, plain):
    for text in TEXTS:
        at, values = fast(text or "")
        assert dict(zip(at.tolist(), values.tolist())) == pytest.approx(plain(text or ""), rel=1e-5)


def biased(features):
    return {k: v for k, v in features.items() if k != quality.BIAS} | {quality.BIAS: 1.0}


@pytest.mark.parametrize("score, plain, name", [
    (quality.score_quality, plain_ngrams, "quality_score"), (toxicity.score_toxicity, plain_beginnings, "toxicity"),
])
def test_scores_are_sums_over_features(spark, score, plain, name):
    weights = np.random.default_rng(3).normal(0, 1, 1 << 18).astype(np.float32)
    rows = score(documents(spark, TEXTS), weights).collect()
    for r in rows:
        total = sum(float(weights[k]) * v for k, v in biased(plain(TEXTS[r.doc_id] or "")).items())
        assert r[name] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-5)


class PlainLeader:
    """The update as it is written in the literature, a coordinate at a time."""

    def __init__(self, absolute):
        self.absolute, self.z, self.n = absolute, {}, {}

    def weight(self, k):
        z, n = self.z.get(k, 0.0), self.n.get(k, 0.0)
        if abs(z) <= self.absolute:
            return 0.0
        return -(z - math.copysign(self.absolute, z)) / ((quality.BETA + math.sqrt(n)) / quality.ALPHA + quality.L2)

    def step(self, gradient):
        for k, g in gradient.items():
            n, w = self.n.get(k, 0.0), self.weight(k)
            self.z[k] = self.z.get(k, 0.0) + g - (math.sqrt(n + g * g) - math.sqrt(n)) / quality.ALPHA * w
            self.n[k] = n + g * g

    def learn(self, features, label):
        p = 1 / (1 + math.exp(-sum(self.weight(k) * v for k, v in features.items())))
        self.step({k: (p - label) * v for k, v in features.items()})


def some_rows(seed):
    random.seed(seed)
    return [({random.randrange(40): random.uniform(-2, 2) for _ in range(random.randint(1, 8))}, random.random() < 0.5) for _ in range(60)]


def arrays(features):
    return np.array(list(features), np.int32), np.array(list(features.values()), np.float64)


@pytest.mark.parametrize("absolute", [0.0, 0.3])
def test_updates_are_the_plain_ones(absolute):
    fast, plain = quality.Leader(bits=6, absolute=absolute), PlainLeader(absolute)
    for features, label in some_rows(int(absolute * 10)):
        fast.learn(*arrays(features), float(label))
        plain.learn(features, float(label))
    assert fast.weights(slice(None))[:40].tolist() == pytest.approx([plain.weight(k) for k in range(40)], abs=1e-9)


def test_fit_with_the_penalty_is_the_plain_one():
    """The penalty's gradient is that of ``strength`` times the squared change of the linear score."""
    rows = []
    for features, label in some_rows(9):
        change = {k: v for k, v in features.items() if k % 3 == 0}
        rows.append((arrays(features), arrays(change) if change else None, float(label)))
    found = toxicity.fitted(rows, 0.7)
    plain, order = PlainLeader(toxicity.L1), np.random.default_rng(7)
    for _ in range(toxicity.PASSES):
        for k in order.permutation(len(rows)):
            vector_, change, label = rows[k]
            plain.learn(biased(dict(zip(vector_[0].tolist(), vector_[1].astype(np.float32).tolist()))), label)
            if change is not None:
                moved = sum(plain.weight(i) * v for i, v in zip(change[0].tolist(), change[1]))
                plain.step({i: 2 * 0.7 * moved * v for i, v in zip(change[0].tolist(), change[1])})
    touched = sorted(plain.z)
    assert found[touched].tolist() == pytest.approx([plain.weight(k) for k in touched], abs=1e-4)
    assert np.count_nonzero(found) == sum(plain.weight(k) != 0 for k in touched)
