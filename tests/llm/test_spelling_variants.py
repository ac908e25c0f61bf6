import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from tables import EDGES, documents

from eventflow.llm.variants import Pivots, count_words, letters_of, near_pairs, spelling_variants


def slow_words(docs, least_length=7, least_count=2):
    counted = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least_length:
                counted[run] += 1
    return {w: n for w, n in counted.items() if n >= least_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def slow(words, ratio=10):
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    best = {w: min(near[w], key=lambda o: (-words[o], o), default=None) for w in words}
    form = {w: o if o and words[o] >= ratio * words[w] else None for w, o in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def check(spark, texts, ids=None, **more):
    ids = ids or list(range(len(texts)))
    rows = spelling_variants(documents(spark, texts, ids), **more).collect()
    want = slow(slow_words(list(zip(ids, texts))), more.get("ratio", 10))
    assert sorted(tuple(r) for r in rows) == sorted(want)
    return want


def vary(word, letters):
    k = random.randrange(len(word) + 1)
    kind = random.randrange(3)
    return word[:k] + ("" if kind == 1 else random.choice(letters)) + word[k + (kind > 0) :]


@pytest.mark.parametrize("seed, letters, most", [(0, "abÉé", 4096), (1, "abcdefghijklmnoéÿ÷", 20)])
def test_against_comparing_every_pair(spark, seed, letters, most):
    """Two and three letters make bigrams repeat within words; ``most`` deals keys to several places."""
    random.seed(seed)
    stems = ["".join(random.choices(letters, k=random.randint(6, 12))) for _ in range(25)]
    words = stems + [vary(random.choice(stems), letters) for _ in range(300)]
    words += [vary(w, letters) for w in words]
    texts = [random.choice([" ", ", ", "1"]).join(random.choices(words, k=60) + random.choices(stems[:5], k=30)) for _ in range(60)]
    want = check(spark, texts, most=most)
    assert sum(w[4] > 0 for w in want) > 100 and sum(w[1] is not None for w in want) > 5


def test_chains_of_forms(spark):
    words = {"aaaaaaab": 1000, "aaaaaabb": 100, "aaaaabbb": 10, "aaaabbbb": 2, "zzzzzzz": 3, "zzzzzzzz": 30, "zzzzzzzy": 30}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    found = {(r.word, r.other) for r in near_pairs(table).collect()}
    assert found == {(a, b) for a in words for b in words if one_edit(a, b)}
    texts = [" ".join([w] * n) for w, n in words.items()]
    check(spark, texts, ratio=2)
    check(spark, texts, ratio=5)


def test_edges(spark):
    texts = EDGES + ["Ünïcødes ÜNÏCØDES unicodes", "seventh seventh", "seventh", "seventhseventh seventhsevent", "×÷×÷×÷× ×÷×÷×÷×"]
    check(spark, texts * 2, [*range(2 * len(texts) - 2), None, 5])
    check(spark, [None, ""])
    check(spark, [])


def test_counts_are_of_all_rows(spark):
    docs = [(k % 7, "Thirteen longwords, thirteen LONGWORDS.") for k in range(40)]
    got = {r.word: r.n for r in count_words(documents(spark, [t for _, t in docs], [i for i, _ in docs])).collect()}
    assert got == slow_words(docs)


@pytest.mark.parametrize("seed", range(3))
def test_pivots_are_disjoint_and_of_least_cost(seed):
    random.seed(seed)
    words = ["".join(random.choices("abcde", k=random.randint(3, 12))) for _ in range(200)]
    counts = Counter(w[k : k + 2] for w in words for k in range(len(w) - 1))
    pivots = Pivots(counts, 5)
    for w in words:
        last, held, first, second = pivots(w)
        grams = [w[k : k + 2] for k in range(len(w) - 1)]
        ordered = sorted(range(len(grams)), key=lambda k: (counts[grams[k]], grams[k], k))
        assert held == [k for k in ordered if pivots.rank[grams[k]] <= last][:7] and held[:5] == ordered[:5]
        if len(w) < 4:
            continue

        def share(part):
            out = 1.0
            for k in range(len(part) - 1):
                out *= counts[part[k : k + 2]] / (sum(n for g, n in counts.items() if g[0] == part[k]) if k else 1)
            return out

        cost = {(a, b): share(w[: a + 2]) + share(w[b:]) for a in ordered[:5] for b in ordered[:5] if b - a >= 2}
        assert cost[first, second] == pytest.approx(min(cost.values()))


def test_one_edit_changes_two_bits_at_most():
    random.seed(2)
    letters = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
    for _ in range(2000):
        word = "".join(random.choices(letters, k=8))
        other = vary(word, letters)
        assert ((letters_of(word) ^ letters_of(other)) & (1 << 64) - 1).bit_count() <= 2
