import threading
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_streaming import generate, land

from eventflow.operators.summary import parse_messages
from eventflow.sinks.snapshots import SnapshotStore
from eventflow.sources.messages import read_messages
from eventflow.streaming.counter import start_counter
from eventflow.streaming.progress import BATCHES, RunProgress, completion


def progress_of(spark, folder, **source):
    return RunProgress(spark, parse_messages(read_messages(spark, f"{folder}/landing", **source)))


def start(progress, folder, **options):
    return start_counter(progress.events, out=f"{folder}/out", checkpoint=f"{folder}/ck", **options)


def test_rows_of_micro_batches_add_up(spark, folder):
    for k, (a, b) in enumerate(((0, 10), (10, 25), (25, 26))):
        land(f"{folder}/landing", f"f{k}", generate(a, b))
    with progress_of(spark, folder, max_files=1) as progress:
        progress.wait_for_end(start(progress, folder), 120)
        assert [(b["batch_id"], b["rows"], b["rows_before"]) for b in progress.batches()] == [(0, 10, 0), (1, 15, 10), (2, 1, 25)]
        assert all(b["milliseconds"] > 0 for b in progress.batches()) and progress.rows == 26
        # Nothing new, then one more file: batches of a restart go on.
        progress.wait_for_end(start(progress, folder), 120)
        land(f"{folder}/landing", "f3", generate(26, 30))
        progress.wait_for_end(start(progress, folder), 120)
    assert [r.rows for r in progress.table().orderBy("batch_id").collect()] == [10, 15, 1, 4]
    found = completion(progress.table(), 12).first()
    assert found.reached and found.batch_id == 1 and 0 < found.busy_ms <= found.latency_ms + 1000


def test_wait_is_woken_by_the_report(spark, folder):
    land(f"{folder}/landing", "one", generate(0, 5))
    with progress_of(spark, folder) as progress:
        running = start(progress, folder, trigger={"processingTime": "100 milliseconds"})
        try:
            assert progress.wait_for(5, running, 120)
            assert not progress.wait_for(6, running, 0.5)
            later = threading.Timer(0.5, land, (f"{folder}/landing", "two", generate(5, 8)))
            later.start()
            assert progress.wait_for(8, running, 120)
        finally:
            running.stop()
        assert sum(r.event_count for r in SnapshotStore(spark, f"{folder}/out/counts").read().collect()) == 8
        # A stream that has ended does not keep anyone waiting.
        began = time.monotonic()
        assert not progress.wait_for(9, running, 600) and time.monotonic() - began < 60


def test_other_streams_do_not_count(spark, folder):
    for name in ("a", "b"):
        land(f"{folder}/{name}/landing", "one", generate(0, 7))
    with progress_of(spark, f"{folder}/a") as progress, progress_of(spark, f"{folder}/b") as other:
        progress.wait_for_end(start(progress, f"{folder}/a"), 120)
        assert (progress.rows, other.rows) == (7, 0)


def test_a_stream_that_fails_raises(spark, folder):
    land(f"{folder}/landing", "one", generate(0, 3))
    with progress_of(spark, folder) as progress:
        broken = progress.events.select(F.raise_error(F.lit("broken")).cast("string").alias("event_type"))
        query = start_counter(broken, out=f"{folder}/out", checkpoint=f"{folder}/ck")
        with pytest.raises(Exception, match="broken"):
            progress.wait_for_end(query, 120)
        assert progress.rows == 0


@pytest.mark.parametrize("n, want", [(1, (True, 0, 50, 50)), (10, (True, 0, 50, 50)), (11, (True, 2, 130, 80)), (31, (False, None, None, None))])
def test_completion(spark, n, want):
    at = datetime(2024, 1, 1)
    rows = [(0, 10, 0, at, 50), (2, 20, 10, at + timedelta(milliseconds=100), 30)]
    assert tuple(completion(spark.createDataFrame(rows, BATCHES), n).first()) == want
