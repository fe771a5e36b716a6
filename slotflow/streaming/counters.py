"""The observed counts of micro-batches, kept as a table by a listener.

Every batch reports the metrics it observed (``observe``) with its progress; no job counts again.
The listener collects them while streams run and writes them when a stream ends, keyed by (query,
batch, metric, name), so that a batch reported twice counts once.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from slotflow.sources import readers, tables

COLUMNS = {"batch": "long", "metric": "string", "name": "string", "value": "long", "input_rows": "long", "at": "string", "query": "string"}
KEYS = ["query", "batch", "metric", "name"]


class Counters(StreamingQueryListener):
    """Attach with ``spark.streams.addListener``; ``wait`` for a stream's counts to be written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._rows: dict[str, list[tuple]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [
            (p.batchId, metric, name, int(value), p.numInputRows, p.timestamp, str(p.id))
            for metric, row in p.observedMetrics.items() for name, value in row.asDict().items() if value is not None
        ]
        with self._lock:
            self._rows.setdefault(str(p.runId), []).extend(rows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Writes the counts of a stream that has ended (events arrive a moment after its end)."""
        run = str(query.runId)
        if not self._end_of(run).wait(timeout):
            raise TimeoutError(f"no end reported for stream {run}")
        with self._lock:
            rows = self._rows.pop(run, [])
        if rows:
            df = self.spark.createDataFrame(rows, ", ".join(f"{k} {v}" for k, v in COLUMNS.items()))
            tables.upsert_table(self.spark, self.path, df.dropDuplicates(KEYS), KEYS, ["query"], partitions_follow_keys=True)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """(batch, metric, name, value, input_rows, at, query) of all streams."""
    return readers.read_silver(spark, path, COLUMNS)
