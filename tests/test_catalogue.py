"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, difference
from eventflow.plans.catalogue import QUERIES
from eventflow.plans.oracles import ORACLES as SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck.sql(SQL[name])) is None


def test_fingerprint_ignores_row_order_and_sees_changes(spark):
    from pyspark.sql import functions as F

    from eventflow.operators.verify import fingerprint
    from eventflow.plans.derived import lineitem

    table = lineitem(spark, SF_DIR)
    one = fingerprint(table).first()
    assert fingerprint(table.repartition(7)).first() == one
    assert fingerprint(table.withColumn("l_tax", F.col("l_tax") + 1)).first() != one


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["event_type", "total_cents", "event_count", "max_ts"]
    assert [r.event_type for r in result.collect()] == ["click", "error", "purchase", "signup", "view"]


@pytest.mark.parametrize("name", ["summary_violations", "all_violations_of_documents"])
def test_documents_of_one_file_are_judged_by_many_tasks(spark, name):
    assert QUERIES[name](spark, SF_DIR).rdd.getNumPartitions() > 8
