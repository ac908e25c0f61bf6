import random
import re

import pytest
from tables import EDGES, benchmark, documents

from eventflow.llm import decontaminate as d


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def slow(texts, items, window=10):
    out = []
    for text in texts:
        w, hit, named = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(window, len(v))
            for k in range(len(v) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[k : k + n]:
                        hit.update(range(p, p + n))
                        if item_id is not None:
                            named.add(str(item_id))
        out.append((len(w), len(hit), sorted(named)))
    return out


def check(spark, texts, items):
    found = d.contamination(documents(spark, texts), benchmark(spark, [t for _, t in items], [i for i, _ in items])).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, list(r.item_ids)) for r in found}
    assert got == dict(enumerate(slow(texts, items)))


@pytest.mark.parametrize("seed", range(2))
def test_against_comparing_everything(spark, seed):
    random.seed(seed)
    letters = "a b c d rare É 9".split()
    items = [(k, " ".join(random.choices(letters, k=random.choice([0, 1, 3, 9, 10, 11, 25])))) for k in range(30)]
    texts = []
    for _ in range(60):
        parts = random.choices(letters, k=random.randint(0, 30))
        parts += random.choice([t for _, t in items]).split() if random.random() < 0.6 else []
        texts.append(random.choice([" ", ", ", "\n"]).join(parts).upper() + random.choice(["", "!", " ."]))
    check(spark, texts, items + [(3, items[5][1]), (None, "a b c"), (31, None)])


def test_edges(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    check(spark, EDGES + ["." + passage + ".", passage.replace(" ", "--"), "p1 p2"], [(1, passage), (2, ""), (3, "a")])


def test_repeated_rows_and_empty_tables(spark):
    passage = " ".join(f"p{k}" for k in range(12))
    docs = documents(spark, [passage, passage, "other", passage, None], [4, 4, 4, None, None])
    rows = d.contamination(docs, benchmark(spark, [passage])).collect()
    assert sorted((str(r.doc_id), r.n_hit) for r in rows) == [("4", 0), ("4", 12), ("4", 12), ("None", 0), ("None", 12)]
    kept = d.drop_contaminated(docs, benchmark(spark, [passage])).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.text) == [("4", "other")] and len(kept) == 2
    assert d.contamination(documents(spark, []), benchmark(spark, ["a"])).count() == 0
    assert [r.n_hit for r in d.contamination(docs, benchmark(spark, [])).collect()] == [0] * 5


def test_proximity(spark):
    docs = documents(spark, ["x alpha b c beta", "beta alpha", "alpha 1 2 3 4 5 6 beta", "alpha", "beta b alpha alpha beta"])
    items = d.benchmark_words(benchmark(spark, ["alpha beta"]))
    index = d.build_index(docs, items)
    found = d.proximity_matches(index, d.item_terms(index, items), within=3).collect()
    assert {r.doc for r in found} == {0, 1, 4}
