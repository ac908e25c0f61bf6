"""Completion and latency of a run, as the engine reports them (STR-6, MET-1).

The stream counts its events while it reads them, and a listener gets a report after each
micro-batch has been written. Nothing asks the results again and again: who waits for a number
of events is woken by the report that reaches it.
"""

from __future__ import annotations

import threading
import time
import uuid
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

BATCHES = "batch_id long, rows long, rows_before long, started timestamp, milliseconds long"


class RunProgress(StreamingQueryListener):
    """Reports of the stream made of ``events``, which is to be used in place of what it was given.

    Used as a context: reports come in between. What is kept is a small row for each
    micro-batch; a batch that runs again after a failure replaces its row.
    """

    def __init__(self, spark: SparkSession, events: DataFrame):
        self._spark, self._name = spark, f"events-{uuid.uuid4().hex}"
        self._changed = threading.Condition()
        self._batches: dict[int, dict[str, Any]] = {}
        self._ended: dict[str, str | None] = {}
        self.events = events.observe(self._name, F.count(F.lit(1)).alias("rows"))

    def __enter__(self) -> RunProgress:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self._name)
        if seen is None or not seen["rows"]:
            return
        row = {
            "batch_id": progress.batchId, "rows": seen["rows"],
            "started": datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")),
            "milliseconds": int(progress.durationMs.get("triggerExecution", 0)),
        }
        with self._changed:
            self._batches[progress.batchId] = row
            self._changed.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended[str(event.runId)] = event.exception
            self._changed.notify_all()

    @property
    def rows(self) -> int:
        """Events of all micro-batches reported so far."""
        with self._changed:
            return sum(b["rows"] for b in self._batches.values())

    def wait_for(self, n: int, query: StreamingQuery, timeout: float) -> bool:
        """Whether ``n`` events have been worked off in time. A stream that ends before ends the wait."""
        run, deadline = str(query.runId), time.monotonic() + timeout
        with self._changed:
            while sum(b["rows"] for b in self._batches.values()) < n:
                left = deadline - time.monotonic()
                if run in self._ended or left <= 0:
                    return False
                self._changed.wait(left)
        return True

    def wait_for_end(self, query: StreamingQuery, timeout: float) -> None:
        """Until the stream has ended by itself and all its reports are in; raises what it failed with."""
        if not query.awaitTermination(timeout):
            query.stop()
            raise TimeoutError(f"stream did not finish within {timeout} s")
        run, deadline = str(query.runId), time.monotonic() + timeout
        with self._changed:
            while run not in self._ended and (left := deadline - time.monotonic()) > 0:
                self._changed.wait(left)

    def batches(self) -> list[dict[str, Any]]:
        """A row per micro-batch with events: its events, those before it, its start and its time."""
        with self._changed:
            found, before = [], 0
            for batch_id in sorted(self._batches):
                found.append({**self._batches[batch_id], "rows_before": before})
                before += self._batches[batch_id]["rows"]
            return found

    def table(self) -> DataFrame:
        rows = [tuple(b[name.split(" ")[0]] for name in BATCHES.split(", ")) for b in self.batches()]
        return self._spark.createDataFrame(rows, BATCHES)


def completion(batches: DataFrame, n: int) -> DataFrame:
    """When a run had worked off ``n`` events, from the rows of its micro-batches (MET-1).

    One row: ``reached``, ``batch_id`` that reached them, ``latency_ms`` from the start of the
    first micro-batch to the end of that one, and ``busy_ms`` that the batches up to it took.
    """
    reaches = (F.col("rows_before") < n) & (F.col("rows_before") + F.col("rows") >= n)
    facts = batches.agg(
        F.min(F.unix_millis("started")).alias("first"),
        F.max(F.when(reaches, F.col("batch_id"))).alias("batch_id"),
        F.max(F.when(reaches, F.unix_millis("started") + F.col("milliseconds"))).alias("end"),
        F.sum(F.when(F.col("rows_before") < n, F.col("milliseconds"))).alias("busy"),
    )
    reached = F.col("batch_id").isNotNull()
    return facts.select(
        reached.alias("reached"), "batch_id", (F.col("end") - F.col("first")).alias("latency_ms"),
        F.when(reached, F.col("busy")).alias("busy_ms"),
    )
