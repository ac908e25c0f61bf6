"""What a piece of work has really shuffled (MET-6)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

LISTENER_MS = 10_000


@dataclass
class Shuffles:
    """``configured`` is the setting; ``used`` are the tasks of the widest stage that read a
    shuffle, after adaptive execution has merged or split partitions; bytes are those of all stages."""

    configured: int
    used: int = 0
    written_bytes: int = 0
    read_bytes: int = 0
    tasks: list[int] = field(default_factory=list)


def shuffle_partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the running session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


@contextmanager
def measured(spark: SparkSession) -> Iterator[Shuffles]:
    """Fills in what the jobs started inside have shuffled, from the reports of their stages.

    The jobs of this thread are told apart by a tag, so work beside does not count.
    """
    found, tag, context = Shuffles(shuffle_partitions(spark)), f"eventflow-{uuid.uuid4().hex}", spark.sparkContext
    context.addJobTag(tag)
    try:
        yield found
    finally:
        context.removeJobTag(tag)
    scala = context._jsc.sc()
    scala.listenerBus().waitUntilEmpty(LISTENER_MS)
    store, tracker = scala.statusStore(), scala.statusTracker()
    stages = {stage for job in tracker.getJobIdsForTag(tag) for stage in tracker.getJobInfo(job).get().stageIds()}
    for stage in sorted(stages):
        # A stage whose shuffle files were there already is skipped: it has moved nothing. The
        # session forgets skipped stages before any other.
        if not tracker.getStageInfo(stage).isDefined():
            continue
        data = store.lastStageAttempt(stage)
        if data.status().toString() == "SKIPPED":
            continue
        found.written_bytes += data.shuffleWriteBytes()
        found.read_bytes += data.shuffleReadBytes()
        if data.shuffleReadRecords():
            found.tasks.append(data.numTasks())
    found.used = max(found.tasks, default=0)
