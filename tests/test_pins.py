import os
import threading

from pyspark.sql import functions as F

from eventflow import files
from eventflow.sinks import snapshots
from eventflow.sinks.snapshots import SnapshotStore


def counts(spark, n):
    return spark.range(4).select(F.concat(F.lit("k"), "id").alias("event_type"), F.lit(n).cast("bigint").alias("event_count"))


def batches(store):
    return store._batches("full"), store._batches("delta")


def test_readers_beside_compactions_never_fail(spark, folder):
    """Every batch is compacted and drops folders; a reader in a loop sees whole states, never older ones."""
    store, done, failures, seen = SnapshotStore(spark, f"{folder}/s"), threading.Event(), [], []
    store.write_delta(counts(spark, 0), 0, 1)

    def read():
        try:
            while not done.is_set():
                with SnapshotStore(spark, f"{folder}/s").pinned() as frame:
                    found = {r.event_count for r in frame.collect()}
                assert len(found) == 1
                seen.append(found.pop())
        except Exception as error:
            failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for batch in range(1, 15):
        store.write_delta(counts(spark, batch), batch, 1)
    done.set()
    reader.join()
    assert not failures and seen == sorted(seen) and len(seen) > 2
    assert files.children(spark, f"{folder}/s/pins") == []


def test_a_pin_keeps_what_was_there(spark, folder, monkeypatch):
    store = SnapshotStore(spark, f"{folder}/s")
    for batch in range(3):
        store.write_delta(counts(spark, batch), batch, 1)
    with store.pinned() as frame:
        for batch in range(3, 8):
            store.write_delta(counts(spark, batch), batch, 1)
        assert min(batches(store)[0]) == 2
        assert {r.event_count for r in frame.collect()} == {2}
    store.write_delta(counts(spark, 8), 8, 1)
    assert batches(store) == ([7, 8], [7, 8])
    # A reader that died keeps nothing for ever.
    files.touch(spark, f"{folder}/s/pins/2_dead")
    os.utime(f"{folder}/s/pins/2_dead", (1, 1))
    store.write_delta(counts(spark, 9), 9, 1)
    assert batches(store) == ([8, 9], [8, 9]) and files.children(spark, f"{folder}/s/pins") == []
    files.touch(spark, f"{folder}/s/pins/{snapshots.NOTHING}_early")
    store.write_delta(counts(spark, 10), 10, 1)
    assert batches(store)[0] == [8, 9, 10]
