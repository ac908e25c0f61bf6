import json
import os
import random

import pytest
from pyspark.sql import functions as F

from eventflow import schemas
from eventflow.operators.summary import parse_messages
from eventflow.session import setting
from eventflow.sinks.snapshots import SnapshotStore
from eventflow.sinks.tables import write_segment
from eventflow.sources import landing
from eventflow.sources.landing import LandingReader, last_position
from eventflow.sources.messages import read_messages
from eventflow.streaming.counter import run_to_end, start_counter
from eventflow.streaming.rescale import read_state, rescale_counter, state_partitions


def put(folder, name, text, mode="wb"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", mode) as f:
        f.write(text.encode())


def read_all(reader, start, end):
    return [line for part in reader.partitions(start, end) for batch in reader.read(part) for line in batch["value"].to_pylist()]


@pytest.mark.parametrize("seed", range(6))
def test_ranges_have_every_line_once(folder, seed, monkeypatch):
    random.seed(seed)
    monkeypatch.setattr(landing, "CHUNK", random.choice([1, 3, 7, 100]))
    lines = []
    for k in range(4):
        own = ["é" * random.choice([0, 0, 1, 2, 5, 30]) + str(k) * random.randint(0, 3) for _ in range(random.randint(0, 25))]
        put(folder, f"{k:03d}", "".join(x + random.choice(["\n", "\r\n"]) for x in own))
        lines += own
    for split in (1, 2, 5, 16, 1000):
        reader = LandingReader(folder, "earliest", split)
        assert read_all(reader, reader.initialOffset(), reader.latestOffset()) == lines


@pytest.mark.parametrize("split", [1, 4, 100])
def test_positions_cut_a_log_in_two(folder, split):
    reader = LandingReader(folder, "earliest", split)
    put(folder, "a", "one\ntwo\n")
    first = reader.latestOffset()
    put(folder, "a", "three\nfo", "ab")
    second = reader.latestOffset()
    put(folder, "a", "ur\n", "ab")
    put(folder, "b", "five")
    put(folder, "c", "six\n")
    put(folder, ".d", "hidden\n")
    third = reader.latestOffset()
    assert read_all(reader, landing.BEGINNING, first) == ["one", "two"]
    assert read_all(reader, first, second) == ["three"]
    assert read_all(reader, second, third) == ["four", "five", "six"]
    assert read_all(reader, third, third) == [] and third == {"file": "c", "bytes": 4}
    assert LandingReader(folder, json.dumps(second), 9).initialOffset() == second
    assert LandingReader(folder, "latest", 9).initialOffset() == third


def test_empty_folder_and_bad_positions(folder):
    reader = LandingReader(f"{folder}/none", "earliest", 9)
    assert reader.latestOffset() == landing.BEGINNING and reader.partitions(landing.BEGINNING, landing.BEGINNING) == []
    for text in ("[]", '{"file": "a"}', "nowhere"):
        with pytest.raises(ValueError):
            LandingReader(folder, text, 9).initialOffset()


def segment(spark, folder, number, first, last):
    rows = spark.range(first, last, 1, 3).select(F.concat(F.lit("k"), F.col("id") % 7, F.lit(":"), "id").alias("value"))
    return write_segment(rows, f"{folder}/log", number)


def wanted(first, last):
    out = {}
    for i in range(first, last):
        out[f"k{i % 7}"] = out.get(f"k{i % 7}", 0) + 1
    return out


def counts(spark, out):
    return {r.event_type: r.event_count for r in SnapshotStore(spark, f"{out}/counts", schemas.COUNTS).read().collect()}


def read_log(spark, folder):
    return lambda start: parse_messages(read_messages(spark, f"{folder}/log", format="landing", start=start))


def test_stream_from_a_position_goes_on(spark, folder):
    segment(spark, folder, 1, 0, 100)
    names = segment(spark, folder, 2, 100, 250)
    start = json.dumps({"file": min(names), "bytes": 0})

    def go():
        run_to_end(start_counter(read_log(spark, folder)(start), out=f"{folder}/out", checkpoint=f"{folder}/ck"), 120)
        return counts(spark, f"{folder}/out")

    assert go() == wanted(100, 250)
    segment(spark, folder, 3, 250, 300)
    assert go() == wanted(100, 300)
    assert json.loads(last_position(spark, f"{folder}/ck"))["file"].startswith("000000000003-")


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_count_goes_on_with_other_parallelisms(spark, folder, mode):
    """4, then 8, then 3 partitions, a restart in between; idle keys keep their counts."""
    segment(spark, folder, 1, 0, 100)
    at = [f"{folder}/run{k}" for k in range(3)]
    with setting(spark, "spark.sql.shuffle.partitions", "4"):
        events = read_log(spark, folder)("earliest")
        run_to_end(start_counter(events, out=at[0], checkpoint=f"{at[0]}/ck", mode=mode), 120)
    for k, partitions in ((1, 8), (2, 3)):
        segment(spark, folder, 2 * k, 100 * k, 100 * k + 3)
        for part in (0, 1):
            run_to_end(rescale_counter(
                spark, read_log(spark, folder), partitions, old_out=at[k - 1], old_checkpoint=f"{at[k - 1]}/ck",
                out=at[k], checkpoint=f"{at[k]}/ck", mode=mode,
            ), 120)
            if not part:
                segment(spark, folder, 2 * k + 1, 100 * k + 3, 100 * (k + 1))
        assert counts(spark, at[k]) == wanted(0, 100 * (k + 1))
        assert state_partitions(spark, f"{at[k]}/ck") == partitions
    assert counts(spark, at[0]) == wanted(0, 100)
    assert {r.event_type: r.event_count for r in read_state(spark, f"{at[0]}/ck").collect()} == wanted(0, 100)


def test_nothing_to_go_on_from(spark, folder):
    with pytest.raises(ValueError, match="no finished batch"):
        rescale_counter(spark, read_log(spark, folder), 2, old_out=folder, old_checkpoint=folder, out=f"{folder}/o", checkpoint=f"{folder}/c")


def test_segments_have_new_numbers(spark, folder):
    segment(spark, folder, 5, 0, 3)
    with pytest.raises(ValueError):
        segment(spark, folder, 5, 0, 3)
