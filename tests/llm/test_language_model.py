import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tables import EDGES, documents

from eventflow.llm import lm, recurrent


def small_weights(words=150, seed=3):
    rng = np.random.default_rng(seed)
    weights = recurrent.initial(rng.integers(1, 50, words).astype(float), 30.0)
    return {k: w + (w > -1e8) * rng.normal(0, 0.2, w.shape).astype(np.float32) for k, w in weights.items()}


def test_probabilities_sum_to_one():
    weights = small_weights()
    states = np.random.default_rng(1).normal(size=(4, recurrent.STATE)).astype(np.float32)
    for state in states:
        every = np.arange(151)
        logs = recurrent.log_probabilities(np.repeat(state[None], 151, axis=0), every, weights)
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_scores_do_not_depend_on_what_is_read_beside():
    weights, rng = small_weights(), np.random.default_rng(2)
    texts = [np.append(rng.integers(1, 151, n), 0) for n in (0, 1, 5, 24, 25, 100, 300, 5)]
    alone = [recurrent.score_texts([t], weights)[0] for t in texts]
    assert recurrent.score_texts(texts, weights) == pytest.approx(alone, rel=1e-4)
    assert recurrent.score_texts(texts, weights, 3) == pytest.approx(alone, rel=1e-4)
    assert len(recurrent.score_texts([], weights)) == 0


def test_gradients_are_those_of_differences(monkeypatch):
    weights = {k: w.astype(np.float64) for k, w in small_weights(70).items()}
    tokens = np.append(np.random.default_rng(4).integers(0, 71, 23), 0)
    seen = {}
    monkeypatch.setattr(recurrent.Trainer, "_apply", lambda self, g: seen.update(g))
    trainer = recurrent.Trainer(weights)

    def loss(w):
        trainer.weights = w
        return -trainer.learn(tokens)

    loss(weights)
    gradients = {k: g.copy() for k, g in seen.items()}
    rng = np.random.default_rng(5)
    for name, g in gradients.items():
        for at in rng.integers(0, g.size, 6):
            if abs(weights[name].flat[at]) > 1e8:
                continue
            moved = [{k: w.copy() for k, w in weights.items()} for _ in range(2)]
            moved[0][name].flat[at] += 1e-3
            moved[1][name].flat[at] -= 1e-3
            slope = (loss(moved[0]) - loss(moved[1])) / 2e-3
            assert g.flat[at] == pytest.approx(slope, abs=2e-4), name


def test_training_helps():
    rng = np.random.default_rng(6)
    stream = np.concatenate([np.append(np.repeat(rng.integers(1, 20), 12), 0) for _ in range(800)])
    counts = np.bincount(stream, minlength=20).astype(float)
    trainer = recurrent.Trainer(recurrent.initial(counts, 0.0), 0.02)
    first = trainer.learn(stream)
    for _ in range(5):
        last = trainer.learn(stream)
    assert last > first + 0.5


def test_vocabulary_grows_with_the_corpus(spark):
    texts = [" ".join(f"w{k}" for k in range(start, start + 1000)) for start in range(0, 300_000, 1000)]
    docs = documents(spark, texts)
    corpus = lm.read_corpus(docs, F.lit(True), frequent=1 << 19)
    first = documents(spark, texts[:1])
    sizes = [len(lm.fit(first, F.lit(True), c).vocabulary) for c in (lm.read_corpus(first, F.lit(True)), corpus)]
    assert sizes == [1001, 300_001 // recurrent.DISTINCT]
    assert recurrent.vocabulary_size(0) == recurrent.WORDS >= 2048 and recurrent.CLASS >= 64
    assert min(recurrent.INPUTS, recurrent.STATE) >= 16


def test_classes_grow_with_the_vocabulary():
    weights = small_weights(5000)
    assert weights["words"].shape[:2] == (71, 71)
    state = np.random.default_rng(1).normal(size=(1, recurrent.STATE)).astype(np.float32)
    logs = recurrent.log_probabilities(np.repeat(state, 5001, axis=0), np.arange(5001), weights)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-3)


def slow(texts, ids, held):
    words = [(t or "").encode().lower().split() + [b"\n"] for t in texts]
    counts = Counter(w for i, ws in zip(ids, words) if i not in held for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws) for ws in words]
    return [(len(ws), sum(counts[w] > 0 for w in ws), b) for ws, b in zip(words, base)], total


@pytest.mark.parametrize("frequent", [1 << 17, 12, 0])
def test_counts_and_base_scores(spark, frequent):
    texts = EDGES + ["the cat and the dog", "The Cat\x0bsat", "unseen words only", "the the the", "a b"] * 3
    ids = list(range(len(texts)))
    held = {k for k in ids if k % 3 == 2}
    docs = documents(spark, texts, ids)
    corpus = lm.read_corpus(docs, F.col("doc_id") % 3 != 2, frequent)
    model = lm.fit(docs, F.col("doc_id") % 3 != 2, corpus)
    rows = {r.doc_id: r for r in lm.score(docs, model, corpus).collect()}
    want, total = slow(texts, ids, held)
    assert corpus.tokens == total and len(rows) == len(texts)
    for i, (n, known, base) in zip(ids, want):
        assert (rows[i].n_tokens, rows[i].n_known) == (n, known)
        assert rows[i].base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert rows[i].score < 0


def test_repeated_rows_nulls_and_empty_tables(spark):
    docs = documents(spark, ["a b", "a b", None, "c"], [1, 1, None, None])
    corpus = lm.read_corpus(docs, F.lit(True))
    rows = lm.score(docs, lm.fit(docs, F.lit(True), corpus), corpus).collect()
    assert len(rows) == 4 and len({r.score for r in rows if r.doc_id == 1}) == 1
    nothing = documents(spark, [])
    corpus = lm.read_corpus(nothing, F.lit(True))
    model = lm.fit(nothing, F.lit(True), corpus)
    assert lm.score(nothing, model, corpus).count() == 0
    assert [r.base_score for r in lm.score(docs, model, corpus).collect()] == [0.0] * 4


def test_sparse_steps_follow_their_rule():
    """Rows that a window does not have keep weights and moments; all others take dense steps by the window's gradient."""
    start, rng = small_weights(5000), np.random.default_rng(8)
    windows = [np.append(rng.integers(first, first + 400, 60), 0) for first in (1, 300, 4000)]
    trainer, taken = recurrent.Trainer(start), []
    apply = trainer._apply
    trainer._apply = lambda g: (taken.append({k: v.copy() for k, v in g.items()}), apply(g))
    want = {k: w.astype(float) for k, w in start.items()}
    mean, square = ({k: np.zeros(w.shape) for k, w in start.items()} for _ in range(2))
    count = 0
    for tokens in windows:
        trainer.learn(tokens)
        assert len(taken) > count
        for g in taken[count:]:
            count += 1
            shrink = min(1.0, 1 / math.sqrt(sum((v.astype(float) ** 2).sum() for v in g.values())))
            rate = trainer.rate * math.sqrt(1 - 0.99**count) / (1 - 0.9**count)
            for k, v in g.items():
                rows = np.abs(v).reshape(len(v), -1).max(axis=1) > 0
                if k not in ("inputs", "words", "word_bias"):
                    rows[:] = True
                mean[k][rows] = 0.9 * mean[k][rows] + 0.1 * shrink * v[rows]
                square[k][rows] = 0.99 * square[k][rows] + 0.01 * (shrink * v[rows].astype(float)) ** 2
                want[k][rows] -= rate * mean[k][rows] / (np.sqrt(square[k][rows]) + 1e-6)
    untouched = ~np.isin(np.arange(5001), np.concatenate(windows))
    assert (trainer.weights["inputs"][untouched] == start["inputs"][untouched]).all() and 0 < untouched.sum()
    for k, w in want.items():
        fine = w > -1e8
        assert trainer.weights[k][fine] == pytest.approx(w[fine], abs=2e-4), k
    assert recurrent._limit(trainer.weights) <= trainer.limit


def test_training_and_scoring_in_parts(monkeypatch):
    """Rows worked on at once and states held until they are scored change no result."""
    weights, rng = small_weights(), np.random.default_rng(9)
    texts = [np.append(rng.integers(1, 151, n), 0) for n in (0, 3, 40, 400, 90, 7)]
    tokens = np.concatenate(texts)

    def run():
        trainer = recurrent.Trainer(weights)
        gained = [trainer.learn(tokens) for _ in range(3)]
        return recurrent.score_texts(texts, weights), gained, recurrent.flat(trainer.weights)

    whole = run()
    for name, value in (("BLOCK", 3), ("HELD", 50), ("SCORED", 7)):
        monkeypatch.setattr(recurrent, name, value)
    for some, every in zip(run(), whole):
        assert some == pytest.approx(every, rel=1e-3, abs=1e-3)


def test_large_scores_are_taken_down():
    weights = small_weights()
    weights["words"] *= 200
    weights["classes"] *= 200
    tokens = np.append(np.random.default_rng(3).integers(0, 151, 300), 0)
    assert recurrent._limit(weights) > 88 and np.isfinite(recurrent.score_texts([tokens], weights)).all()
    trainer = recurrent.Trainer(weights)
    assert np.isfinite([trainer.learn(tokens) for _ in range(2)]).all()
    assert all(np.isfinite(w).all() for w in trainer.weights.values())


def test_weights_are_averaged_by_tokens_in_blocks(spark):
    texts = [" ".join(f"w{(k * j) % 50}" for j in range(40 + 20 * k)) for k in range(6)]
    vocabulary = {b"\n": 0} | {f"w{k}".encode(): k + 1 for k in range(49)}
    start = recurrent.initial(np.ones(50), 1.0)
    docs = documents(spark, texts).repartitionByRange(3, "doc_id")
    parts = [[r.text for r in p] for p in docs.rdd.glom().collect()]
    want, tokens = 0, 0
    for part in filter(None, parts):
        positions = np.concatenate([lm._positions(t, vocabulary) for t in part])
        trainer = recurrent.Trainer(start)
        trainer.learn(positions)
        want, tokens = want + recurrent.flat(trainer.weights).astype(float) * len(positions), tokens + len(positions)
    found = recurrent.flat(lm._trained(docs, start, vocabulary, 1))
    assert found == pytest.approx(want / tokens, rel=1e-5, abs=1e-5)


def test_words_are_split_as_in_their_plain_form(monkeypatch):
    texts = [t or "" for t in EDGES] + ["", " \t", "\x0bA\x0c b\r\nC\x1c\x85\u00a0\u2003d ", "\u00c4\u0130 \x00 a", "the the", " x" * 50]
    vocabulary = {b"\n": 0, b"the": 1, b"a": 2, b"x": 3}
    plain = [lm._positions(t, vocabulary).tolist() for t in texts]
    batch = pa.record_batch({"row": pa.array(range(len(texts))), "text": pa.array(texts)})
    for size in (1 << 24, 8, 1):
        monkeypatch.setattr(lm, "TEXT", size)
        parts = list(lm.parts_of(iter([batch.slice(0, 3), batch.slice(3)])))
        assert pa.Table.from_batches(parts) == pa.Table.from_batches([batch]) and (size > 8 or len(parts) > 4)
        found, positions = [], []
        for part in parts:
            words, starts = lm.split_words(part["text"])
            found += [words[a:b].to_pylist() for a, b in zip(starts, starts[1:])]
            every, starts = lm.positions_of(part["text"], pa.array(list(vocabulary), pa.binary()))
            positions += [every[a:b].tolist() for a, b in zip(starts, starts[1:])]
        assert found == [lm.words_of(t) for t in texts] and positions == plain


def test_windows_take_little_new_memory():
    """What a window works on stays with the trainer: what is new is under 16 states a token."""
    rng = np.random.default_rng(11)
    trainer = recurrent.Trainer(small_weights(3000))
    tokens = rng.integers(0, 3001, 4 * recurrent.STEPS * recurrent.STREAMS)
    trainer.learn(tokens)
    tracemalloc.start()
    trainer.learn(tokens)
    peak = tracemalloc.get_traced_memory()[1] - 2 * 8 * len(tokens)
    tracemalloc.stop()
    assert peak < 16 * 4 * recurrent.STATE * recurrent.STEPS * recurrent.STREAMS
