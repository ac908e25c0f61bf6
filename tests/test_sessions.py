import os
import random

import pytest
from pyspark.sql import functions as F

from eventflow.streaming.counter import ConfigurationMissing, run_to_end
from eventflow.streaming.sessions import read_ended, read_open, session_counts, start_session_counter

SCHEMA = "k string, s long"


def slow(rows, idle):
    """(key, first, last, count) of each stretch of a key's events without a longer gap."""
    found, last = [], {}
    for k, s in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        if k in last and s - last[k][2] <= idle:
            last[k][2], last[k][3] = s, last[k][3] + 1
        else:
            last[k] = [k, s, s, 1]
            found.append(last[k])
    return sorted(map(tuple, found), key=str)


def seconds(frame):
    named = frame.select("k", F.unix_seconds("started"), F.unix_seconds("last_seen"), "event_count")
    return sorted((tuple(r) for r in named.collect()), key=str)


def timed(frame):
    return frame.withColumn("at", F.timestamp_seconds("s"))


def test_batch_is_the_slow_one(spark):
    random.seed(1)
    rows = [(random.choice(["a", "b", "", None]), random.randint(0, 400)) for _ in range(150)]
    assert seconds(session_counts(timed(spark.createDataFrame(rows, SCHEMA)), ["k"], "at", "5 seconds")) == slow(rows, 5)
    assert session_counts(timed(spark.createDataFrame([], SCHEMA)), ["k"], "at", "5 seconds").count() == 0
    assert session_counts(timed(spark.createDataFrame([("a", None)], SCHEMA)), ["k"], "at", "5 seconds").count() == 0


def test_idle_keys_leave_the_state(spark, folder):
    """Events come in order of time, in several runs; what has ended is written, the rest is in the state."""
    random.seed(2)
    os.makedirs(f"{folder}/in")
    rows = sorted([(random.choice("abcd"), random.randint(0, 300)) for _ in range(120)], key=lambda r: r[1])
    source = spark.readStream.schema(SCHEMA).json(f"{folder}/in")
    schema = session_counts(timed(spark.createDataFrame([], SCHEMA)), ["k"], "at", "9 seconds").schema
    for part in range(4):
        share = rows[30 * part : 30 * (part + 1)]
        spark.createDataFrame(share, SCHEMA).coalesce(1).write.mode("append").json(f"{folder}/in")
        query = start_session_counter(timed(source), out=folder, checkpoint=f"{folder}/ck", keys=["k"], time="at", idle="9 seconds", late="1 second")
        run_to_end(query, 120)
        latest = share[-1][1]
        want = slow(rows[: 30 * (part + 1)], 9)
        ended, open_ = seconds(read_ended(spark, folder, schema)), seconds(read_open(spark, f"{folder}/ck", ["k"]))
        assert sorted(ended + open_, key=str) == want
        assert ended == [w for w in want if w[2] + 9 <= latest - 1] and len(open_) <= 4


def test_needs_its_folders(spark, folder):
    events = timed(spark.readStream.schema(SCHEMA).json(folder))
    with pytest.raises(ConfigurationMissing):
        start_session_counter(events, out=None, checkpoint=folder, keys=["k"], time="at", idle="1 second")
