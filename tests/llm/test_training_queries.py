"""The registered queries against their SQL, and the pipeline against a brute-force version."""

import re

import pytest
from compare import connect, difference

import __spark_entry__ as entry_points
import corpus_pipeline
from eventflow.llm.common import read_table
from eventflow.llm.packing import cut
from eventflow.llm.quality import ACCEPT, score_quality
from eventflow.llm.queries import ORACLE_SQL, QUERIES, quality_weights
from test_benchmark_passages import slow as slow_contamination
from test_exact_copies import expected as slow_copies
from test_near_copies import components, slow_fingerprint

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck.sql(ORACLE_SQL[name])) is None


def test_operators_and_the_pipeline_are_registered():
    names = set(entry_points.queries())
    assert {re.match(r"op\d+", n)[0] for n in names if re.match(r"op\d", n)} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"


def test_pipeline_is_the_brute_force_one(spark):
    docs = read_table(spark, SF_DIR, "documents")
    scored = score_quality(docs, quality_weights(spark, SF_DIR, docs)).collect()
    left = [(r.doc_id, r.text) for r in scored if r.quality_score >= ACCEPT]
    keep = [k for k, _, _ in slow_copies(left)]
    left = [row for row, k in zip(left, keep) if row[0] == k]
    prints = [slow_fingerprint(t) for _, t in left]
    roots = components(len(left), [
        (i, j) for i in range(len(left)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 4
    ])
    firsts = {}
    for (i, _), r in zip(left, roots):
        firsts[r] = min(i, firsts.get(r, i))
    left = [row for row, r in zip(left, roots) if row[0] == firsts[r]]
    items = [(r.item_id, r.text) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    hits = slow_contamination([t for _, t in left], items)
    left = [row for row, (_, n, _) in zip(left, hits) if not n]
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    want = cut(docs.where(docs.doc_id.isin([i for i, _ in left]))).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, found)) == sorted(map(key, want))


def test_stages_keep_the_columns(spark):
    docs = read_table(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns


def test_stages_take_empty_tables(spark):
    docs = read_table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0
