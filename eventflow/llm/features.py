"""Hashed word n-grams of whole texts."""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np

# Letters, digits or marks that stand together.
PIECE = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^\s0-9A-Za-z_\x80-\xff]+")
BITS = 18


def _hashed(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, parts), np.uint32, len(parts))


def _vector(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    index, counts = np.unique(hashes & np.uint32((1 << bits) - 1), return_counts=True)
    values = np.log1p(counts)
    norm = np.sqrt(np.dot(values, values))
    return index.astype(np.int32), (values / norm if len(values) else values).astype(np.float32)


def word_ngrams(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ascending order and values of a text's vector, which has length 1.

    Features are pieces, pairs of neighbouring words, and how many words are in capitals
    or not. A pair of equal words is the same feature whatever the word, so that
    repetition can be told. Values are dampened counts. An empty text has no positions.
    """
    data = text.encode()
    words = data.split()
    single = _hashed(words)
    with np.errstate(over="ignore"):
        pairs = (single[:-1] * np.uint32(0x9E3779B1)) ^ single[1:]
    pairs[single[:-1] == single[1:]] = 1
    upper = sum(map(bytes.isupper, words))
    case = np.repeat(np.array([2, 3], np.uint32), [upper, len(words) - upper])
    return _vector(np.concatenate([_hashed(PIECE.findall(data)), pairs, case]), bits)


LETTERS = re.compile(rb"[a-z\x80-\xff]+")
# Beginnings of words that are features, in bytes; the length of their vectors.
BEGINNINGS = range(4, 9)
LENGTH = 10.0


def word_beginnings(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ascending order and values of a text's lower-case words and their beginnings.

    Words of one stem share beginnings, so an inflected word counts as its stem does. Values
    are dampened counts; the vector has length ``LENGTH``. An empty text has no positions.
    """
    counts = Counter(LETTERS.findall(text.lower().encode()))
    parts, times = list(counts), list(counts.values())
    for size in BEGINNINGS:
        longer = [w for w in counts if len(w) > size]
        parts += [w[:size] + b"-" for w in longer]
        times += [counts[w] for w in longer]
    at, back = np.unique(_hashed(parts) & np.uint32((1 << bits) - 1), return_inverse=True)
    values = np.log1p(np.bincount(back, weights=times, minlength=len(at)))
    norm = np.sqrt(np.dot(values, values))
    return at.astype(np.int32), (LENGTH * values / norm if len(values) else values).astype(np.float32)
