"""Latest count per key, materialised batch by batch (SNK-1, STR-4).

Each micro-batch overwrites a folder of its own, so writing a batch again after a failure
changes nothing. ``full/batch_id=N`` holds every key as of batch N, ``delta/batch_id=N``
only the keys that batch N changed. A reader takes the newest finished full folder and the
finished deltas after it, and of each key the row of the highest batch. ``base`` holds what an
earlier run has counted; it is added when the store is read.

A reader beside a running stream pins what it reads: an empty file below ``pins`` names the
newest full folder that there was, and no folder from that one on is removed while it is there.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow import files, schemas
from eventflow.functions.text import render_line

FULL, DELTA, BASE, PINS = "full", "delta", "base", "pins"
# Named by a pin if there is no full folder yet.
NOTHING = -2
# A pin that is older was left behind by a reader that has died.
LEASE_SECONDS = 24 * 3600.0


class SnapshotStore:
    """Counts per key in a folder; ``schema`` is the key columns and ``event_count``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = schemas.COUNTS) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    @property
    def keys(self) -> list[str]:
        return [name for name in self.schema.fieldNames() if name != "event_count"]

    def write_full(self, counts: DataFrame, batch_id: int) -> None:
        self._write(counts, FULL, batch_id)
        self._drop_obsolete()

    def write_delta(self, changed: DataFrame, batch_id: int, compact_every: int = 50) -> None:
        """Write changed keys; every so many batches merge them into a full folder."""
        self._write(changed, DELTA, batch_id)
        if batch_id and batch_id % compact_every == 0:
            # Never from a full folder of this batch, which a run before a failure may have left.
            self._write(self._latest(batch_id, batch_id + 1), FULL, batch_id)
            self._drop_obsolete()

    def read(self, before: int | None = None) -> DataFrame:
        """Latest count of every key, as of the batches below ``before`` if given."""
        latest, base = self._latest(before, before), self.base()
        if base is None:
            return latest
        return latest.unionByName(base).groupBy(*self.keys).agg(F.sum("event_count").alias("event_count"))

    @contextmanager
    def pinned(self) -> Iterator[DataFrame]:
        """``read`` for a reader beside a running stream: what it reads stays until it leaves.

        The pin is set before the folders are listed. A writer that does not see it yet has listed
        them earlier, and removes only what is older than the newest full folder of that moment,
        which this reader no longer takes.
        """
        newest = max(self._batches(FULL), default=NOTHING)
        pin = f"{self.path}/{PINS}/{newest}_{uuid.uuid4().hex}"
        files.touch(self.spark, pin)
        try:
            yield self.read()
        finally:
            files.remove(self.spark, pin)

    def write_base(self, counts: DataFrame) -> None:
        """What an earlier run has counted; written once, before the first batch."""
        if self.base() is None:
            counts.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).write.mode("overwrite").parquet(f"{self.path}/{BASE}")

    def base(self) -> DataFrame | None:
        if not files.exists(self.spark, f"{self.path}/{BASE}/_SUCCESS"):
            return None
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{BASE}")

    def _latest(self, fulls_before: int | None, deltas_before: int | None) -> DataFrame:
        fulls = [b for b in self._batches(FULL) if fulls_before is None or b < fulls_before]
        deltas = [b for b in self._batches(DELTA) if deltas_before is None or b < deltas_before]
        base = max(fulls, default=None)
        later = [b for b in deltas if base is None or b > base]
        if base is None and not later:
            return self.spark.createDataFrame([], self.schema)
        if not later:
            return self._load(FULL, [base]).select(*self.keys, "event_count")
        rows = self._load(DELTA, later)
        if base is not None:
            rows = rows.unionByName(self._load(FULL, [base]))
        latest = rows.groupBy(*self.keys).agg(F.max_by("event_count", "batch_id").alias("event_count"))
        return latest.select(*self.keys, "event_count")

    def is_empty(self) -> bool:
        return not (files.children(self.spark, f"{self.path}/{FULL}") or files.children(self.spark, f"{self.path}/{DELTA}"))

    def _write(self, counts: DataFrame, kind: str, batch_id: int) -> None:
        rows = counts.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        rows.write.mode("overwrite").parquet(f"{self.path}/{kind}/batch_id={batch_id}")

    def _load(self, kind: str, batches: Sequence[int]) -> DataFrame:
        root = f"{self.path}/{kind}"
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        paths = [f"{root}/batch_id={b}" for b in batches]
        return self.spark.read.schema(schema).option("basePath", root).parquet(*paths)

    def _batches(self, kind: str) -> list[int]:
        """Finished batches only: a folder without its success marker was interrupted."""
        names = files.children(self.spark, f"{self.path}/{kind}")
        found = [n for n in names if n.startswith("batch_id=")]
        done = [n for n in found if files.exists(self.spark, f"{self.path}/{kind}/{n}/_SUCCESS")]
        return sorted(int(n.split("=", 1)[1]) for n in done)

    def _drop_obsolete(self) -> None:
        """Folders older than the last full folder but one, which a batch run again may still need,
        and older than any that a reader has pinned."""
        fulls = self._batches(FULL)
        if len(fulls) < 2:
            return
        oldest = min(fulls[-2], *self._pinned())
        for kind in (FULL, DELTA):
            for batch in self._batches(kind):
                if batch < oldest:
                    files.remove(self.spark, f"{self.path}/{kind}/batch_id={batch}")


    def _pinned(self) -> list[int]:
        """Full folders that readers have named; pins beyond their lease are removed."""
        held = [max(self._batches(FULL))]
        for name, at in files.written(self.spark, f"{self.path}/{PINS}").items():
            if time.time() - at > LEASE_SECONDS:
                files.remove(self.spark, f"{self.path}/{PINS}/{name}")
            elif not name.startswith("."):
                held.append(int(name.split("_")[0]))
        return held


def write_snapshot_text(counts: DataFrame, path: str) -> None:
    """The snapshot as sorted lines ``key<TAB>count`` (SRT-2)."""
    line = render_line(F.col("event_type"), F.col("event_count"))
    counts.orderBy("event_type").select(line.alias("value")).write.mode("overwrite").text(path)
