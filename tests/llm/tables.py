"""Small tables with what real ones may hold."""

from __future__ import annotations

# Columns whose names the operators use themselves.
EXTRA = "row long, word string, same long, digest string, carried string, text_hash long, label int, score double"


def documents(spark, texts, ids=None):
    """``doc_id, text`` rows beside columns of clashing names."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, 1, "w", 2, "d", "c", 3, 4, 0.5) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + EXTRA)


def benchmark(spark, texts, ids=None):
    return spark.createDataFrame(list(zip(ids or range(len(texts)), texts)), "item_id long, text string")


EDGES = [None, "", " \t\n ", "a", "One word here", "One  word\there", "x" * 50_000, "y " * 20_000, "Ünïcode 文字 🙂 text"]
