import random

import numpy as np
import pytest
import xxhash
from tables import EDGES, documents

from eventflow.llm import simhash
from eventflow.llm.components import smallest_reachable


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    up = list(range(n))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(k) for k in range(n)]


@pytest.mark.parametrize("text", EDGES + ["A b C d", "a b c d e f g a b c d"])
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") == slow_fingerprint(text)


def near_prints(n, seed=1):
    """Random fingerprints, some of them a few bits from another."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    for k in range(1, n, 3):
        value = int(base[rng.integers(0, k)])
        for bit in rng.choice(64, rng.integers(1, 7), replace=False):
            value ^= 1 << int(bit)
        base[k] = value
    return np.unique(base)


def all_links(prints):
    return [
        (i, i + 1 + int(j))
        for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[i + 1 :]) <= 4)
    ]


def test_tiles_find_every_link():
    prints = near_prints(1500)
    want = components(len(prints), all_links(prints))
    at = {int(p): k for k, p in enumerate(prints)}
    half = len(prints) // 2
    found = []
    for left, right in ((prints[:half], None), (prints[half:], None), (prints[:half], prints[half:])):
        a, b = simhash.link_tiles(left, right)
        assert (np.bitwise_count(a ^ b) > 0).all()
        found += [(at[int(x)], at[int(y)]) for x, y in zip(a, b)]
    assert components(len(prints), found) == want


def test_links_over_several_tiles(spark):
    prints = near_prints(900, 5)
    table = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fingerprint long")
    found = simhash.links(table, tile=100).collect()
    at = {int(p): k for k, p in enumerate(prints.view(np.int64))}
    assert components(len(prints), [(at[r.a], at[r.b]) for r in found]) == components(len(prints), all_links(prints))


def test_components_of_a_long_chain(spark):
    random.seed(2)
    nodes = random.sample(range(-500, 500), 200)
    links = list(zip(nodes[:150], nodes[1:150])) + [(n, n) for n in nodes[150:160]] + list(zip(nodes[160:], nodes[161:]))
    random.shuffle(links)
    found = {r.node: r.root for r in smallest_reachable(spark.createDataFrame(links, "a long, b long")).collect()}
    for part in (nodes[:150], nodes[160:]):
        assert all(found.get(n, n) == min(part) for n in part)
    assert set(found) <= set(nodes[:150] + nodes[160:])


def test_classes(spark):
    text = " ".join(f"w{k}" for k in range(400))
    texts = EDGES + [text, text + " extra", text.upper(), "another one altogether", text, None]
    ids = [*range(10, 10 + len(EDGES)), 40, 41, 5, 42, None, 3]
    rows = simhash.near_duplicates(documents(spark, texts, ids)).collect()
    prints = [slow_fingerprint(t) for t in texts]
    roots = components(len(texts), [
        (i, j) for i in range(len(texts)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 4
    ])
    want = {}
    for i, r in zip(ids, roots):
        own = [j for j, other in zip(ids, roots) if other == r and j is not None]
        want[str(i)] = min(own) if own else None
    assert {str(r.doc_id): r.component_id for r in rows} == want
    assert sorted(r.fingerprint & (1 << 64) - 1 for r in rows) == sorted(prints)
    kept = simhash.drop_near_duplicates(documents(spark, texts, ids)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))


def test_repeated_rows_and_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    again = documents(spark, ["one two three"] * 3, [7, 7, 7])
    assert [r.component_id for r in simhash.near_duplicates(again).collect()] == [7, 7, 7]
    assert simhash.drop_near_duplicates(again).count() == 1
