"""The progress of running queries as metric points, judged by the same rules as all others.

A listener turns every progress report into a few points (rows read, rate, time of the batch, state kept) named after the
query. Reports come on the driver, a handful of numbers each; they are kept and appended to the metrics table together, on a
thread of their own, so that no query waits for them.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from clickloom.schema import METRIC_POINT
from clickloom.sources.metrics import put_points

FLUSH_SECONDS = 10.0


def points_of(progress) -> list[tuple]:
    """Rows of ``METRIC_POINT`` for one progress report. A batch without rows is reported too: its rate is 0."""
    at = int(datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).timestamp() * 1000)
    state = list(progress.stateOperators)
    figures = (
        ("EventsReceived", float(progress.numInputRows), "count"),
        ("EventsPerSecond", _number(progress.processedRowsPerSecond), "count/sec"),
        ("ProcessingLatency", float(progress.durationMs.get("triggerExecution", progress.batchDuration or 0)), "ms"),
        ("StateRows", float(sum(s.numRowsTotal for s in state)), "count"),
        ("StateBytes", float(sum(s.memoryUsedBytes for s in state)), "bytes"),
    )
    who = {"query": progress.name or str(progress.id)}
    return [(name, int(progress.batchId), value, "gauge", at, who, unit) for name, value, unit in figures]


def _number(value: float) -> float:
    return value if value == value and abs(value) != float("inf") else 0.0


class ProgressMetrics(StreamingQueryListener):
    """Append the points of all queries of a session to the metrics table at ``path``.

    ``spark.streams.addListener(ProgressMetrics(spark, path))``; ``close()`` writes what is left. Points that cannot be written are
    kept for the next try. A query that ends with an error leaves one ``QueryFailed`` point.
    """

    def __init__(self, spark: SparkSession, path: str, flush_seconds: float = FLUSH_SECONDS):
        self.spark, self.path = spark, path
        self.kept: list[tuple] = []
        self.lock, self.writing, self.ended = threading.Lock(), threading.Lock(), threading.Event()
        self.thread = threading.Thread(target=self._run, args=(flush_seconds,), daemon=True)
        self.thread.start()

    def _run(self, seconds: float) -> None:
        while not self.ended.wait(seconds):
            try:
                self.flush()
            except Exception:  # noqa: BLE001 - kept for the next try; close() raises
                continue

    def flush(self) -> None:
        with self.writing:
            with self.lock:
                taken, self.kept = self.kept, []
            if not taken:
                return
            try:
                put_points(self.spark.createDataFrame(taken, METRIC_POINT).coalesce(1), self.path)
            except Exception:
                with self.lock:
                    self.kept = taken + self.kept
                raise

    def close(self) -> None:
        self.ended.set()
        self.flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        points = points_of(event.progress)
        with self.lock:
            self.kept += points

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            at = int(datetime.now().timestamp() * 1000)
            with self.lock:
                self.kept.append(("QueryFailed", 0, 1.0, "gauge", at, {"query": str(event.id)}, "count"))
