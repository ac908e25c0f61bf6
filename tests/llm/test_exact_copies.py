import hashlib
import re

from tables import EDGES, documents

from eventflow.llm.exact_dedup import drop_copies, label_copies


def expected(rows):
    """Per row: which row stays, and how many are equal, by comparing all."""
    keys = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    out = []
    for key in keys:
        group = [k for k, other in enumerate(keys) if other == key]
        best = min(group, key=lambda k: (-len(rows[k][1] or ""), rows[k][0] is None, rows[k][0] or 0, k))
        out.append((rows[best][0], len(group), hashlib.sha256(key.encode()).hexdigest()))
    return out


def check(spark, texts, ids):
    found = label_copies(documents(spark, texts, ids)).collect()
    want = expected(list(zip(ids, texts)))
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.digest) for r in found) == sorted(
        (str(i), str(k), n, d) for i, (k, n, d) in zip(ids, want)
    )
    groups = {}
    for r in found:
        groups.setdefault(r.digest, []).append(r)
    for rows in groups.values():
        assert sum(r.kept for r in rows) == 1
        assert next(r for r in rows if r.kept).id == rows[0].keep_id


def test_edges_ties_and_repeated_rows(spark):
    texts = EDGES + ["a b c", "ab c", "abc", "a  bc"] + ["same row"] * 2 + ["no id"] * 2
    ids = [*range(len(texts) - 4), 77, 77, None, None]
    check(spark, texts, ids)
    kept = drop_copies(documents(spark, texts, ids)).collect()
    assert len(kept) == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for t in texts})
    assert kept[0].asDict().keys() == set(documents(spark, []).columns)


def test_frequent_digests_go_their_own_way(spark):
    texts = ["hot text"] * 700 + [" hot\ttext "] * 3 + [f"other {k % 900}" for k in range(1500)]
    check(spark, texts, list(range(len(texts)))[::-1])


def test_empty_table(spark):
    assert label_copies(documents(spark, [])).count() == 0
    assert drop_copies(documents(spark, [])).count() == 0
