import glob
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow import schemas
from eventflow.functions.text import event_key, event_sequence
from eventflow.operators.running import running_counts
from eventflow.operators.summary import key_counts, parse_messages
from eventflow.operators.verify import key_diff
from eventflow.sinks.snapshots import SnapshotStore, write_snapshot_text
from eventflow.sources.messages import read_messages
from eventflow.streaming.counter import (
    ConfigurationMissing, changelog_path, read_changelog, run_to_end, start_changelog, start_counter, wait_for_total,
)


def land(folder, name, messages):
    """Files are taken in the order of their times, so these must not be equal."""
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.tmp", "w") as f:
        f.write("".join(m + "\n" for m in messages))
    moment = 1_700_000_000 + 10 * len(os.listdir(folder))
    os.utime(f"{folder}/{name}.tmp", (moment, moment))
    os.rename(f"{folder}/{name}.tmp", f"{folder}/{name}.txt")


def generate(first, last):
    return [f"event_type_{i % 5}:{i}" for i in range(first, last)]


def counts(store):
    return {r.event_type: r.event_count for r in store.read().collect()}


class Run:
    """One landing folder, checkpoint and output."""

    def __init__(self, spark, folder, mode="complete", **options):
        self.spark, self.folder, self.mode, self.options = spark, folder, mode, options
        self.landing = f"{folder}/landing"
        os.makedirs(self.landing, exist_ok=True)
        self.store = SnapshotStore(spark, f"{folder}/out/counts")

    def start(self, **source):
        events = parse_messages(read_messages(self.spark, self.landing, **source))
        return start_counter(
            events, out=f"{self.folder}/out", checkpoint=f"{self.folder}/checkpoint", mode=self.mode, **self.options
        )

    def go(self, **source):
        run_to_end(self.start(**source), 120)
        return counts(self.store)


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_restart_continues_and_counts_nothing_twice(spark, folder, mode):
    run = Run(spark, folder, mode)
    land(run.landing, "one", generate(0, 500))
    assert run.go() == {f"event_type_{i}": 100 for i in range(5)}
    # Nothing new: there is no batch, and the snapshot stays.
    assert run.go() == {f"event_type_{i}": 100 for i in range(5)}
    land(run.landing, "two", generate(500, 1003))
    assert sum(run.go().values()) == 1003


def test_idle_keys_survive_in_update_mode(spark, folder):
    run = Run(spark, folder, "update")
    land(run.landing, "one", ["idle:1", "busy:2"])
    run.go()
    land(run.landing, "two", ["busy:3"])
    assert run.go() == {"idle": 1, "busy": 2}


@pytest.mark.parametrize("mode", ["complete", "update"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_failed_batch_is_written_again(spark, folder, monkeypatch, mode, when):
    """The job dies before or after writing a batch that is not committed yet."""
    run = Run(spark, folder, mode)
    land(run.landing, "one", generate(0, 50))
    run.go()
    land(run.landing, "two", generate(50, 100))
    name = "write_full" if mode == "complete" else "write_delta"
    original = getattr(SnapshotStore, name)

    def dies(self, *args):
        if when == "after":
            original(self, *args)
        raise RuntimeError("killed")

    monkeypatch.setattr(SnapshotStore, name, dies)
    with pytest.raises(Exception):
        run_to_end(run.start(), 120)
    monkeypatch.setattr(SnapshotStore, name, original)
    assert run.go() == {f"event_type_{i}": 20 for i in range(5)}


@pytest.mark.parametrize("step", range(1, 5))
def test_a_compaction_that_dies_at_any_step_is_repeated_once(spark, folder, monkeypatch, step):
    """Before or after the delta, before or after the full folder; one restart has to do."""
    run = Run(spark, folder, "update", compact_every=1)
    for part in range(3):
        land(run.landing, f"p{part}", generate(50 * part, 50 * part + 50))
        if part < 2:
            run.go()
    original, calls = SnapshotStore._write, []

    def dies(self, *args):
        calls.append(args[1])
        if len(calls) == (step + 1) // 2:
            if step % 2 == 0:
                original(self, *args)
            raise RuntimeError("killed")
        original(self, *args)

    monkeypatch.setattr(SnapshotStore, "_write", dies)
    with pytest.raises(Exception):
        run_to_end(run.start(), 120)
    monkeypatch.setattr(SnapshotStore, "_write", original)
    assert run.go() == {f"event_type_{i}": 30 for i in range(5)}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("mode", ["complete", "update"])
def test_stream_equals_batch_on_any_split(spark, folder, seed, mode):
    rng = random.Random(seed)
    run = Run(spark, folder, mode, compact_every=2)
    messages = [rng.choice(["hot:1", "hot:2", " hot :3", "a", "", ":x", f"k{rng.randrange(20)}:7"]) for _ in range(300)]
    cuts = sorted(rng.sample(range(300), 5))
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, 300])):
        land(run.landing, f"part{i}", messages[a:b])
    run.go(max_files=1)
    batch = key_counts(parse_messages(read_messages(spark, run.landing, streaming=False)))
    assert key_diff(run.store.read(), batch, ["event_type"], ["event_count"]).filter("status <> 'same'").isEmpty()
    assert sum(counts(run.store).values()) == 300


def test_store_overwrites_compacts_and_skips_interrupted_batches(spark, folder):
    store = SnapshotStore(spark, folder)
    frame = lambda **kv: spark.createDataFrame(list(kv.items()), schemas.COUNTS)
    assert store.is_empty() and counts(store) == {}
    store.write_delta(frame(a=1, b=1), 0, compact_every=2)
    store.write_delta(frame(a=2), 1, compact_every=2)
    store.write_delta(frame(a=2), 1, compact_every=2)
    assert counts(store) == {"a": 2, "b": 1}
    store.write_delta(frame(a=3), 2, compact_every=2)
    assert glob.glob(f"{folder}/full/batch_id=2")
    store.write_delta(frame(b=5), 3, compact_every=2)
    assert counts(store) == {"a": 3, "b": 5}
    assert {r.event_type: r.event_count for r in store.read(before=3).collect()} == {"a": 3, "b": 1}
    store.write_delta(frame(c=1), 4, compact_every=2)
    assert sorted(os.path.basename(p) for p in glob.glob(f"{folder}/delta/*")) == [f"batch_id={i}" for i in (2, 3, 4)]
    store.write_delta(frame(c=9), 5, compact_every=2)
    os.remove(f"{folder}/delta/batch_id=5/_SUCCESS")
    assert counts(store) == {"a": 3, "b": 5, "c": 1}


def test_refused_starts(spark, folder):
    events = parse_messages(read_messages(spark, folder))
    for given, missing in (({"out": "x", "checkpoint": None}, ["checkpoint"]), ({"out": "", "checkpoint": ""}, ["checkpoint", "out"])):
        with pytest.raises(ConfigurationMissing) as refused:
            start_counter(events, **given)
        assert refused.value.record["error"] == "configuration_missing"
        assert sorted(refused.value.record["missing"]) == missing
    with pytest.raises(ValueError, match="mode"):
        start_counter(events, out=f"{folder}/o", checkpoint=f"{folder}/c", mode="append")
    run = Run(spark, folder)
    land(run.landing, "one", ["a:1"])
    run.go()
    with pytest.raises(ValueError, match="another run"):
        start_counter(events, out=f"{folder}/out", checkpoint=f"{folder}/fresh")


def changelog(spark, out):
    schema = "event_type string, seq bigint, running_count bigint"
    rows = read_changelog(spark, out, T.StructType.fromDDL(schema)).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_changelog_over_restarts_and_failures(spark, folder, monkeypatch):
    landing, out = f"{folder}/landing", f"{folder}/out"

    def go():
        value = F.col("value")
        parsed = read_messages(spark, landing, max_files=1).select(
            event_key(value).alias("event_type"), event_sequence(value).alias("seq")
        )
        run_to_end(start_changelog(parsed, out=out, checkpoint=f"{folder}/checkpoint", sequence="seq", compact_every=2), 180)

    messages = generate(0, 203) + ["event_type_1:9999"]
    land(landing, "a", messages[:60])
    land(landing, "b", messages[60:100])
    go()
    land(landing, "c", messages[100:])
    original = SnapshotStore.write_delta

    def dies(self, *args):
        raise RuntimeError("killed")

    monkeypatch.setattr(SnapshotStore, "write_delta", dies)
    with pytest.raises(Exception):
        go()
    monkeypatch.setattr(SnapshotStore, "write_delta", original)
    os.makedirs(f"{changelog_path(out)}/batch_id=99")
    go()
    parsed = spark.createDataFrame([(m.split(":")[0], int(m.split(":")[1])) for m in messages], "event_type string, seq bigint")
    expected = running_counts(parsed, ["event_type"], "seq").collect()
    assert changelog(spark, out) == sorted((tuple(r) for r in expected), key=repr)


def test_wait_for_total(spark, folder):
    run = Run(spark, folder, trigger={"processingTime": "200 milliseconds"})
    land(run.landing, "one", generate(0, 100))
    query = run.start()
    try:
        assert wait_for_total(run.store, 100, 120, poll=0.3)
        assert wait_for_total(run.store, 100, 5, poll=0.3, keys=5)
        assert not wait_for_total(run.store, 101, 1, poll=0.3)
        assert not wait_for_total(run.store, 100, 1, poll=0.3, keys=6)
    finally:
        query.stop()


def test_timeout_stops_the_stream(spark, folder):
    run = Run(spark, folder, trigger={"processingTime": "1 second"})
    query = run.start()
    with pytest.raises(TimeoutError):
        run_to_end(query, 2)
    assert not query.isActive


def test_several_keys(spark, folder):
    source = f"{folder}/table"
    rows = [(i % 3, f"t{i % 2}") for i in range(30)] + [(None, "t0")]
    spark.createDataFrame(rows, "user_id bigint, event_type string").write.parquet(source)
    schema = T.StructType.fromDDL("user_id bigint, event_type string")
    stream = spark.readStream.schema(schema).parquet(source)
    run_to_end(start_counter(stream, out=f"{folder}/out", checkpoint=f"{folder}/c", keys=["user_id", "event_type"], mode="update"), 120)
    store = SnapshotStore(spark, f"{folder}/out/counts", T.StructType.fromDDL("user_id bigint, event_type string, event_count bigint"))
    found = {(r.user_id, r.event_type): r.event_count for r in store.read().collect()}
    assert found == {**{(u, t): 5 for u in range(3) for t in ("t0", "t1")}, (None, "t0"): 1}


def test_snapshot_text(spark, folder):
    frame = spark.createDataFrame([("b", 2), ("a", 1), ("", 3)], schemas.COUNTS)
    write_snapshot_text(frame, f"{folder}/counts.txt")
    text = "".join(open(p).read() for p in sorted(glob.glob(f"{folder}/counts.txt/part-*")))
    assert text == "\t3\na\t1\nb\t2\n"
