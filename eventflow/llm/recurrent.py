"""A gated recurrent language model in numpy, its output softmax factored by classes."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

# Least words of the vocabulary, which grows by one for so many distinct words; least words of a class.
WORDS, DISTINCT = 2048, 128
CLASS = 64
# Sizes of inputs and state.
INPUTS, STATE = 16, 16
# Steps through which gradients flow back, and streams that are trained side by side.
STEPS, STREAMS = 24, 192
RATE = 0.004
# Position of the end of a text in the vocabulary.
END = 0
FLOOR = np.float32(-1e9)
# Scores are in bits while they are worked on, for powers of two take half the time of others.
BITS = np.float32(1 / math.log(2))
# Scores under which no maximum is taken off; the most that a step moves a weight, as a multiple of
# its rate: the root of the sum of (0.9 * 0.9 / 0.99)**k over all k, by Cauchy and Schwarz.
SMALL, MOST_STEP = 40, (1 - 0.9 * 0.9 / 0.99) ** -0.5
# Rows that are worked on and that are summed at once, values of a step, and states held until they are scored.
BLOCK, SUMMED, HELD, SCORED = 1024, 256, 1 << 15, 1 << 16
# Weights of which a window has few rows.
LARGE = ("inputs", "own")


@dataclass
class Shape:
    """How many words there are, in how many classes. One class more holds all other words."""

    words: int

    @property
    def size(self) -> int:
        """Words of a class: about as many as there are classes, so that neither sum outgrows the other."""
        return max(CLASS, math.isqrt(max(0, self.words - 1)) + 1)

    @property
    def classes(self) -> int:
        return -(-self.words // self.size)


def vocabulary_size(distinct: int) -> int:
    """Words that the model of a corpus of so many distinct words tells apart."""
    return max(WORDS, distinct // DISTINCT)


def initial(counts: np.ndarray, rare: float, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights that predict words by their frequency, whatever came before.

    ``counts``: of the words of the vocabulary, in its order; ``rare``: of all other tokens.
    """
    shape, random = Shape(len(counts)), np.random.default_rng(seed)
    padded = np.zeros(shape.classes * shape.size)
    padded[: len(counts)] = counts + 0.1
    by_class = padded.reshape(shape.classes, shape.size)
    mass = np.append(by_class.sum(axis=1), rare + 0.1)
    words = np.where(by_class > 0, np.log(np.maximum(by_class, 1e-9) / by_class.sum(axis=1, keepdims=True)), FLOOR)

    def matrix(*size, scale):
        return random.normal(0, scale, size).astype(np.float32)

    return {
        "inputs": matrix(len(counts) + 1, INPUTS, scale=0.3),
        "gates": matrix(INPUTS, 3 * STATE, scale=INPUTS**-0.5),
        "recurrent": matrix(STATE, 3 * STATE, scale=STATE**-0.5),
        "bias": np.zeros(3 * STATE, np.float32),
        "classes": matrix(STATE, shape.classes + 1, scale=0.1),
        "class_bias": np.log(mass / mass.sum()).astype(np.float32),
        "words": matrix(shape.classes, shape.size, STATE, scale=0.1),
        "word_bias": words.astype(np.float32),
    }


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights.values()])


def like(values: np.ndarray, weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The inverse of ``flat``."""
    out, at = {}, 0
    for name, w in weights.items():
        out[name] = values[at : at + w.size].reshape(w.shape).astype(np.float32)
        at += w.size
    return out


def _planes(given: np.ndarray, recurrent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Projected inputs and recurrent weights as one plane each for update, reset and candidate.

    Those of the gates are halved, for 1 / (1 + exp(-x)) is (1 + tanh(x / 2)) / 2.
    """
    both = [w.reshape(len(w), 3, STATE).transpose(1, 0, 2).copy() for w in (given, recurrent)]
    for planes in both:
        planes[:2] *= 0.5
    return tuple(both)


def _step(given: np.ndarray, state: np.ndarray, recurrent: np.ndarray, gates=None, candidate=None) -> np.ndarray:
    """The state after one step of the gated unit from planes of inputs.

    ``gates`` take update, reset and what moves the candidate, ``candidate`` the candidate.
    """
    gates = np.matmul(state, recurrent, out=gates)
    both = gates[:2]
    both += given[:2]
    np.tanh(both, out=both)
    both *= 0.5
    both += 0.5
    candidate = np.multiply(both[1], gates[2], out=candidate)
    candidate += given[2]
    np.tanh(candidate, out=candidate)
    new = state - candidate
    new *= both[0]
    new += candidate
    return new


def _limit(weights: dict[str, np.ndarray]) -> float:
    """What no score exceeds. States lie between -1 and 1, so a score is at most its weights' sum and its bias.

    Below ``SMALL`` scores can be raised without taking the maximum off first.
    """
    by_class = np.abs(weights["classes"]).sum(axis=0) + weights["class_bias"]
    by_word = np.abs(weights["words"]).sum(axis=2) + weights["word_bias"]
    return max(float(by_class.max()), float(by_word.max()))


def _with_ones(states: np.ndarray, factor: float = 1) -> np.ndarray:
    """States with a one behind each, which takes up a bias; all times a factor."""
    out = np.empty((len(states), states.shape[1] + 1), states.dtype)
    np.multiply(states, factor, out=out[:, :-1])
    out[:, -1] = factor
    return out


def _joined(weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Weights with their biases as a last row, in new arrays."""
    words = np.ascontiguousarray(weights["words"].transpose(0, 2, 1))
    return {
        "inputs": weights["inputs"].copy(),
        "unit": np.concatenate([weights["gates"], weights["bias"][None]]),
        "recurrent": weights["recurrent"].copy(),
        "head": np.concatenate([weights["classes"], weights["class_bias"][None]]),
        "own": np.ascontiguousarray(np.concatenate([words, weights["word_bias"][:, None]], axis=1)),
    }


def _named(joined: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Views of joined weights by the names that ``initial`` gives them."""
    unit, head, own = joined["unit"], joined["head"], joined["own"]
    return {
        "inputs": joined["inputs"], "gates": unit[:-1], "recurrent": joined["recurrent"], "bias": unit[-1],
        "classes": head[:-1], "class_bias": head[-1],
        "words": own[:, :-1].transpose(0, 2, 1), "word_bias": own[:, -1],
    }


def _pieces(classes: np.ndarray, number: int):
    """Of ordered classes, at most ``BLOCK`` rows at once and the classes among them: (from, to, [(k, from, to)])."""
    starts = np.searchsorted(classes, np.arange(number + 1)).tolist()
    first, some = 0, []
    for k, (start, end) in enumerate(zip(starts, starts[1:])):
        while start < end:
            stop = min(end, first + BLOCK)
            some.append((k, start, stop))
            start = stop
            if stop - first == BLOCK:
                yield first, stop, some
                first, some = stop, []
    if some:
        yield first, starts[-1], some


def log_probabilities(
    states: np.ndarray, targets: np.ndarray, weights: dict[str, np.ndarray], small: bool | None = None,
    joined: dict[str, np.ndarray] | None = None,
) -> np.ndarray:
    """Natural logarithms of the targets' probabilities; for a rare word, of being one."""
    rare = len(weights["inputs"]) - 1
    number, size = weights["word_bias"].shape
    small = _limit(weights) < SMALL if small is None else small
    joined = _joined(weights) if joined is None else joined
    # Rare words are the last, so this orders the classes too.
    order = np.argsort(targets)
    targets = targets[order]
    classes = np.where(targets == rare, number, targets // size)
    states = _with_ones(states.take(order, axis=0), BITS)
    found = np.empty(len(targets), states.dtype)
    scores = np.empty((BLOCK, max(size, number + 1)), states.dtype)
    for first in range(0, len(targets), BLOCK):
        part = slice(first, first + BLOCK)
        mine = states[part]
        outer = np.matmul(mine, joined["head"], out=_front(scores, len(mine), number + 1))
        found[part] = _picked(outer, classes[part], small)
    for first, end, some in _pieces(classes, number):
        inner = _front(scores, end - first, size)
        for k, start, stop in some:
            np.matmul(states[start:stop], joined["own"][k], out=inner[start - first : stop - first])
        found[first:end] += _picked(inner, targets[first:end] - classes[first:end] * size, small)
    out = np.empty_like(found)
    out[order] = found
    return out


def _front(room: np.ndarray, *shape: int) -> np.ndarray:
    """The first values of a room as an array without gaps."""
    return room.ravel()[: math.prod(shape)].reshape(shape)


def _places(scores: np.ndarray, which: np.ndarray) -> np.ndarray:
    return np.arange(len(which)) * scores.shape[1] + which


def _picked(scores: np.ndarray, which: np.ndarray, small: bool) -> np.ndarray:
    """The logarithm of each row's normalised score, in bits, at the place picked. Overwrites the scores."""
    if not small:
        scores -= scores.max(axis=1, keepdims=True)
    picked = scores.ravel().take(_places(scores, which))
    np.exp2(scores, out=scores)
    picked -= np.log2(scores @ np.ones(scores.shape[1], scores.dtype))
    picked /= BITS
    return picked


def _summed(left: np.ndarray, right: np.ndarray, out: np.ndarray) -> None:
    """Sets the product of turned rows and rows, some rows at a time, which the library multiplies as they lie."""
    np.dot(left[:SUMMED].T, right[:SUMMED], out)
    for first in range(SUMMED, len(left), SUMMED):
        out += np.dot(left[first : first + SUMMED].T, right[first : first + SUMMED])


def score_texts(texts: list[np.ndarray], weights: dict[str, np.ndarray], side_by_side: int = 2048) -> np.ndarray:
    """Natural log-likelihood of each whole sequence of word positions, each ended by ``END``.

    Texts of similar length go through side by side. The state is carried from step to
    step, and states are scored some at a time, so memory does not depend on the length of a text.
    """
    out = np.zeros(len(texts))
    table, recurrent = _planes(weights["inputs"] @ weights["gates"] + weights["bias"], weights["recurrent"])
    small, joined = _limit(weights) < SMALL, _joined(weights)
    order = np.argsort([-len(t) for t in texts], kind="stable")
    states, targets, owners, held = [], [], [], 0

    def scored():
        found = log_probabilities(np.concatenate(states), np.concatenate(targets), weights, small, joined)
        return np.bincount(np.concatenate(owners), weights=found, minlength=len(texts))

    for first in range(0, len(order), side_by_side):
        group = order[first : first + side_by_side]
        lengths = np.array([len(texts[k]) for k in group])
        every, starts = np.concatenate([texts[k] for k in group]), np.cumsum(lengths) - lengths
        # How many texts, the longest first, go on at each step.
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left").tolist()
        state = np.zeros((len(group), STATE), np.float32)
        before = np.full(len(group), END)
        for t, n in enumerate(active):
            state = _step(table.take(before[:n], axis=1), state[:n], recurrent)
            before = every[starts[:n] + t]
            states.append(state)
            targets.append(before)
            owners.append(group[:n])
            held += n
            if held >= SCORED:
                out += scored()
                states, targets, owners, held = [], [], [], 0
    return out + scored() if held else out


class Trainer:
    """Truncated back-propagation with adaptive steps.

    Steps are sparse: rows of ``inputs`` whose word and classes of ``words`` of which no target
    is in a window keep their weights and both moments in it. So a window costs what occurs in it.
    """

    def __init__(self, weights: dict[str, np.ndarray], rate: float = RATE):
        self.rate, self.count = rate, 0
        # What belongs to the same weights lies in one large array, which the system can keep in large pages.
        kept = {k: np.zeros((4, *w.shape), w.dtype) for k, w in _joined(weights).items()}
        # Sums of gradients and of their squares, which fade; means are the tenth and the hundredth of them.
        self.joined, self.gradient, self.mean, self.square = ({k: w[part] for k, w in kept.items()} for part in range(4))
        self.weights = weights
        # The classes' weights, without biases, and their gradients: items of lists are found faster.
        own = self.joined["own"]
        self.classes = list(own), list(own[:, :-1].transpose(0, 2, 1)), list(self.gradient["own"])
        # Rows of the large weights that the last window had; in all others their gradients are zero.
        self.present = {k: np.zeros(0, np.int64) for k in LARGE}
        self.limit = _limit(weights)
        self.rooms = {}

    @property
    def weights(self) -> dict[str, np.ndarray]:
        return self._weights

    @weights.setter
    def weights(self, weights: dict[str, np.ndarray]) -> None:
        for name, values in _joined(weights).items():
            self.joined[name][:] = values
        self._weights = _named(self.joined)

    def learn(self, tokens: np.ndarray) -> float:
        """One pass over texts written one after the other, each ended by ``END``; mean log-likelihood.

        The stream is cut into parts that are read side by side. Each part's state is carried
        from window to window, and starts anew with each text.
        """
        streams = int(max(1, min(STREAMS, len(tokens) // (4 * STEPS))))
        length = -(-len(tokens) // streams)
        padded = np.full(streams * length, -1)
        padded[: len(tokens)] = tokens
        targets = padded.reshape(streams, length)
        before = np.concatenate(([END], padded[:-1])).reshape(streams, length)
        state = np.zeros((streams, STATE), self.joined["unit"].dtype)
        total = 0.0
        for start in range(0, length, STEPS):
            state, gained = self._window(before[:, start : start + STEPS], targets[:, start : start + STEPS], state)
            total += gained
        return total / max(1, len(tokens))

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """An array of any values that is used again by each window, for fresh memory costs time."""
        size, dtype = math.prod(shape), self.joined["unit"].dtype
        if name not in self.rooms or self.rooms[name].size < size or self.rooms[name].dtype != dtype:
            self.rooms[name] = np.empty(size, dtype)
        return _front(self.rooms[name], *shape)

    def _cleared(self, name: str, rows: np.ndarray) -> np.ndarray:
        """The gradient of a large weight, zero in rows that were set before and that the window lacks."""
        gradient = self.gradient[name]
        lacks = np.ones(len(gradient), bool)
        lacks[rows] = False
        gone = self.present[name]
        gradient[gone[lacks[gone]]] = 0
        self.present[name] = rows
        return gradient

    def _window(self, before: np.ndarray, targets: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, float]:
        w, gradient = self.joined, self.gradient
        streams, steps = before.shape
        past = np.maximum(before.T, 0)
        ended = np.flatnonzero(past.ravel() == END)
        ends = np.split(ended % streams, np.searchsorted(ended, np.arange(1, steps) * streams))
        order = np.argsort(past.ravel())
        ordered = past.ravel()[order]
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        present = ordered[starts]
        at = np.empty(len(order), np.int64)
        at[order] = np.repeat(np.arange(len(present)), np.diff(np.append(starts, len(order))))
        inputs = _with_ones(w["inputs"].take(present, axis=0))
        table, recurrent = _planes(inputs @ w["unit"], w["recurrent"])
        given = self._room("given", 3, steps, streams, STATE)
        table.take(at, axis=1, out=given.reshape(3, -1, STATE), mode="clip")
        gates = self._room("gates", steps, 3, streams, STATE)
        entered, candidate, every = self._room("steps", 3, steps, streams, STATE)
        for t in range(steps):
            entered[t] = state
            entered[t][ends[t]] = 0
            every[t] = state = _step(given[:, t], entered[t], recurrent, gates[t], candidate[t])
        update, reset, moved = gates.swapaxes(0, 1)
        wanted = targets.T.ravel()
        d_states, gained = self._output(every.reshape(-1, STATE), wanted)
        d_states = d_states.reshape(every.shape)
        by_candidate, by_update, by_reset, rest, d_given = self._room("back", 5, *every.shape)
        np.subtract(1, update, out=rest)
        np.multiply(candidate, candidate, out=by_candidate)
        np.subtract(1, by_candidate, out=by_candidate)
        by_candidate *= rest
        np.subtract(entered, candidate, out=by_update)
        by_update *= update
        by_update *= rest
        np.subtract(1, reset, out=by_reset)
        by_reset *= reset
        by_reset *= moved
        d_moved = self._room("moved", *given.shape)
        d_state = np.zeros_like(state)
        back = np.ascontiguousarray(w["recurrent"].reshape(STATE, 3, STATE).transpose(1, 2, 0))
        for t in range(steps - 1, -1, -1):
            d_state += d_states[t]
            d_candidate = np.multiply(d_state, by_candidate[t], out=d_given[t])
            np.multiply(d_state, by_update[t], out=d_moved[0, t])
            np.multiply(d_candidate, by_reset[t], out=d_moved[1, t])
            np.multiply(d_candidate, reset[t], out=d_moved[2, t])
            d_state *= update[t]
            for moves in d_moved[:, t] @ back:
                d_state += moves
            d_state[ends[t]] = 0
        planes = [d.reshape(-1, STATE) for d in (d_moved[0], d_moved[1], d_given)]
        d_inputs = sum(d @ u.T for d, u in zip(planes, np.split(w["unit"][:-1], 3, axis=1)))
        summed = np.add.reduceat(d_inputs.take(order, axis=0), starts, axis=0)
        self._cleared("inputs", present)[present] = summed
        read = inputs.take(at, axis=0)
        for plane, d in enumerate(planes):
            gradient["unit"][:, plane * STATE : (plane + 1) * STATE] = read.T @ d
        by_plane = entered.reshape(-1, STATE).T @ d_moved.reshape(3, -1, STATE)
        gradient["recurrent"][:] = by_plane.transpose(1, 0, 2).reshape(STATE, 3 * STATE)
        self._apply(_named(gradient))
        return state, gained

    def _output(self, states: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, float]:
        """Sets gradients of the mean loss by the output weights; those by the states, and the sum of log-likelihoods.

        Targets below zero are none.
        """
        w, (number, size), rare = self.joined, self.weights["word_bias"].shape, len(self.joined["inputs"]) - 1
        d_head = self.gradient["head"]
        # Rare words are the last, so this orders the classes too.
        order = np.argsort(targets)
        order = order[np.searchsorted(targets[order], 0) :]
        targets = targets[order]
        n, classes = max(1, len(targets)), np.where(targets == rare, number, targets // size)
        if self.limit >= SMALL:
            self.limit = _limit(self.weights)
        small = self.limit < SMALL
        own = _with_ones(states.take(order, axis=0))
        in_bits = own * BITS
        gained, d_head[:], sums = 0.0, 0, np.empty_like(d_head)
        turned = np.ascontiguousarray(w["head"][:-1].T)
        d_own_states = self._room("states", len(order), STATE)
        room = self._room("scores", BLOCK, max(size, number + 1))
        for first in range(0, len(targets), BLOCK):
            mine = own[first : first + BLOCK]
            scores = _front(room, len(mine), number + 1)
            np.matmul(in_bits[first : first + BLOCK], w["head"], out=scores)
            scale, logs = self._differences(scores, classes[first : first + BLOCK], small, n)
            gained += logs
            np.multiply(scores @ turned, scale, out=d_own_states[first : first + BLOCK])
            _summed(mine * scale, scores, sums)
            d_head += sums
        present = np.flatnonzero(np.bincount(classes, minlength=number)[:number])
        self._cleared("own", present)
        (weights, without, d_own), last = self.classes, -1
        for first, end, some in _pieces(classes, number):
            scores = _front(room, end - first, size)
            for k, start, stop in some:
                np.dot(in_bits[start:stop], weights[k], scores[start - first : stop - first])
            scale, logs = self._differences(scores, targets[first:end] - classes[first:end] * size, small, n)
            gained += logs
            scaled, d_some = own[first:end] * scale, np.empty((end - first, STATE), own.dtype)
            turned = scaled.T
            for k, start, stop in some:
                part = slice(start - first, stop - first)
                mine = scores[part]
                np.dot(mine, without[k], d_some[part])
                if k == last:
                    d_own[k] += np.dot(turned[:, part], mine)
                elif stop - start > SUMMED:
                    _summed(scaled[part], mine, d_own[k])
                else:
                    np.dot(turned[:, part], mine, d_own[k])
                last = k
            d_some *= scale
            d_own_states[first:end] += d_some
        d_states = np.zeros_like(states)
        d_states[order] = d_own_states
        return d_states, gained

    @staticmethod
    def _differences(scores: np.ndarray, which: np.ndarray, small: bool, n: int) -> tuple[np.ndarray, float]:
        """Turns scores in bits into differences of shares and targets, up to a factor for each row.

        Returns the factors for a ``n``-th of the differences, and the sum of the logarithms of the targets' shares.
        """
        if not small:
            scores -= scores.max(axis=1, keepdims=True)
        places, values = _places(scores, which), scores.ravel()
        np.exp2(scores, out=scores)
        total = scores @ np.ones(scores.shape[1], scores.dtype)
        picked = values.take(places)
        values[places] = picked - total
        return (1 / (n * total))[:, None], float(np.log(np.maximum(picked / total, 1e-30)).sum())

    def _apply(self, gradients: dict[str, np.ndarray]) -> None:
        """A step of all weights by the gradients: views of the joined ones, which are used up where they are not zero."""
        self.count += 1
        parts = []
        for name, gradient in self.gradient.items():
            many = max(1, HELD // gradient[0].size)
            for at in _together(self.present[name], many) if name in LARGE else [slice(None)]:
                parts.append((name, at, _rows(gradient, at)))
        length = math.sqrt(sum(float(np.dot(g.ravel(), g.ravel())) for _, _, g in parts))
        shrink = min(1.0, 1.0 / max(length, 1e-9))
        rate = self.rate * math.sqrt(1 - 0.99**self.count) / (1 - 0.9**self.count)
        for name, at, g in parts:
            weights, mean, square = (_rows(w[name], at) for w in (self.joined, self.mean, self.square))
            if shrink < 1:
                g *= shrink
            mean *= 0.9
            mean += g
            g *= g
            square *= 0.99
            square += g
            root = np.sqrt(square, out=g)
            root += 1e-5
            np.divide(mean, root, out=root)
            root *= rate
            weights -= root
            if not isinstance(at, slice):
                self.joined[name][at], self.mean[name][at], self.square[name][at] = weights, mean, square
        self.limit += (STATE + 1) * MOST_STEP * rate


def _rows(values: np.ndarray, at) -> np.ndarray:
    return values[at] if isinstance(at, slice) else values.take(at, axis=0)


def _together(rows: np.ndarray, most: int) -> list:
    """Places of at most so many rows, which stay in the processor's cache; neighbours as slices, if most rows are."""
    ends = np.flatnonzero(np.diff(rows) != 1) + 1
    if 4 * len(ends) > len(rows):
        return [rows[first : first + most] for first in range(0, len(rows), most)]
    return [
        slice(int(first), min(int(first) + most, int(run[-1]) + 1))
        for run in np.split(rows, ends) if len(run) for first in range(run[0], run[-1] + 1, most)
    ]
