"""The physical plans the operators are meant to get."""

import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from eventflow.operators.summary import grouped_summary, key_counts, parse_messages
from eventflow.operators.running import nth_event, running_counts
from eventflow.plans import derived
from eventflow.plans.catalogue import QUERIES
from eventflow.sources.messages import as_messages

SF_DIR = "/root/testdata/sf0.001"
STREAMS = {"stream_restart", "stream_until_complete", "batch_job_rows", "stream_counts", "stream_counts_update", "count_changelog_stream", "pipeline_summary", "stream_batch_diff"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_reads_only_its_columns_and_combines_first(spark):
    text = plan(grouped_summary(derived.events(spark, SF_DIR), time="ts"))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text
    assert "partial_sum" in text and text.count("Exchange") == 1


def test_filters_reach_the_scan(spark):
    text = plan(key_counts(derived.events(spark, SF_DIR).filter("event_type = 'click'")))
    assert re.search(r"PushedFilters: \[.*EqualTo\(event_type,click\)", text)


def test_messages_are_parsed_and_combined_before_the_shuffle(spark):
    text = plan(key_counts(parse_messages(as_messages(derived.events(spark, SF_DIR)))))
    shuffle = text.index("Exchange")
    assert text.index("partial_count") > shuffle and text.index("substring_index") > shuffle


def test_no_window_over_a_whole_key_of_events(spark):
    """Events meet windows of one block only; those over a key see counts of spans."""
    text = plan(running_counts(derived.events(spark, SF_DIR), ["event_type"], "event_id"))
    groups = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", text)
    names = [re.sub(r"#\w+", "", g) for g in groups]
    # Twice: cells with few copies and with many share one exchange.
    assert names == 2 * ["event_type, _block", "event_type, _span", "event_type"]
    below_last = text[text.rindex("Window"):]
    assert below_last.index("HashAggregate(keys=[event_type") < below_last.index("FileScan")


def test_the_nth_event_takes_two_passes(spark, folder):
    """Also if one rare key reaches its n-th event long after all others."""
    rows = spark.range(20_000).selectExpr("'often' as k", "id as seq").unionByName(
        spark.range(5).selectExpr("'rare' as k", "(id + 1) * 100000000000 as seq")
    )
    rows.write.parquet(f"{folder}/rows")
    seen = Observation()
    table = spark.read.parquet(f"{folder}/rows").observe(seen, F.count(F.lit(1)).alias("n"))
    found = nth_event(table, ["k"], "seq", F.col("seq"), 5)
    scans = re.findall(r"Scan parquet", plan(found))
    assert {(r.k, r.seq) for r in found.collect()} == {("often", 4), ("rare", 500_000_000_000)}
    executed = found._jdf.queryExecution().executedPlan().toString()
    final = executed[: executed.index("== Initial Plan ==")]
    read = len(re.findall(r"Scan parquet", final))
    assert scans and 1 <= read <= 2


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
