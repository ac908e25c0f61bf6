import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from tables import EDGES, benchmark, documents

from eventflow.llm.lexical import Best, blocks_of_items, item_terms, search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def slow(docs, items, top=20):
    """``docs`` and ``items`` are (id, text); a list of (id, score) per item, by the definition."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(term for _, c in counted for term in c)
    out = []
    for _, text in items:
        scores = []
        for (i, c), n in zip(counted, sizes):
            score = 0
            for term in terms(text):
                if tf := c[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 100 - 25 + (25 * n * n_docs) // total
                    score += w * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out.append([(i, -s) for s, _, _, i in sorted(scores, key=lambda x: x[:3])[:top]])
    return out


def check(spark, texts, items, ids=None, item_ids=None, **more):
    ids, item_ids = ids or list(range(len(texts))), item_ids or list(range(len(items)))
    rows = search(documents(spark, texts, ids).repartition(5), benchmark(spark, items, item_ids), **more).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.item, r.rank)):
        assert r.rank == len(found.setdefault((r.item_id, r["item"]), [])) + 1
        found[r.item_id, r["item"]].append((r.doc_id, r.score))
    want = slow(list(zip(ids, texts)), list(zip(item_ids, items)), more.get("top", 20))
    got = sorted(((str(i), v) for (i, _), v in found.items()), key=repr)
    assert got == sorted(((str(i), v) for i, v in zip(item_ids, want) if v), key=repr)


@pytest.mark.parametrize("seed, most_bytes", [(0, 1 << 20), (1, 1000)])
def test_against_scoring_every_pair(spark, seed, most_bytes):
    random.seed(seed)
    letters = ["a", "B", "cc", "d1", "É", "é", "文", "rare", "x"]
    def text(most):
        return random.choice([" ", ", ", "\n", "--"]).join(random.choices(letters, k=random.randint(0, most)))

    check(spark, [text(40) for _ in range(150)], [text(6) for _ in range(12)], most_bytes=most_bytes)


def test_edges_ties_repeated_rows_and_ids(spark):
    texts = EDGES + ["same words", "same words", "SAME-words", "wordsame", "\ud83d one"[1:]]
    ids = [9, 8, 7, 6, 5, None, 3, 2, 1, 40, 40, None, 12, 13]
    items = [None, "", "One one same", "y", "One one same", "x" * 50_000, "文字 🙂", "absent"]
    check(spark, texts, items, ids, [1, 2, 3, 4, 3, None, 7, 8])
    check(spark, texts, items, ids, [1, 2, 3, 4, 3, None, 7, 8], top=1)


def test_empty_tables(spark):
    assert search(documents(spark, []), benchmark(spark, ["a"])).count() == 0
    assert search(documents(spark, ["a"]), benchmark(spark, [])).count() == 0
    assert search(documents(spark, [None]), benchmark(spark, ["a"])).count() == 0


def test_terms_are_whole(spark):
    docs = documents(spark, ["ab abc", "a b", "ab.", "xab", "AB2 ab"])
    assert [r.doc_id for r in search(docs, benchmark(spark, ["ab"])).orderBy("rank").collect()] == [2, 0, 4]


def test_blocks_are_bounded(spark):
    terms = item_terms(benchmark(spark, [f"a{k} b{k} c{k}" for k in range(200)] + [" ".join(f"w{k}" for k in range(500))]))
    dealt, blocks = blocks_of_items(terms, 3000)
    by_block = {}
    for r in dealt.collect():
        by_block.setdefault(r.block, []).append(r)
    assert sorted(by_block) == blocks and len(blocks) > 13
    for rows in by_block.values():
        assert sum(len(r.term) + 64 for r in rows) <= 3000 or len({r["item"] for r in rows}) == 1
    assert sum(map(len, by_block.values())) == 1100


def test_best_of_many_batches():
    random.seed(4)
    scores = np.array([[random.randint(0, 6) for _ in range(3)] for _ in range(500)])
    docs = np.array(random.sample(range(1000), 500))
    best = Best(3, 7)
    for k in range(0, 500, 13):
        best.add(scores[k : k + 13], docs[k : k + 13], np.zeros(len(docs[k : k + 13]), bool))
    for item in range(3):
        want = sorted((-s, d) for s, d in zip(scores[:, item], docs) if s > 0)[:7]
        assert [(-s, d) for s, d in zip(best.score[best.item == item], best.doc[best.item == item])] == want
