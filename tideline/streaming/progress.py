"""Streaming progress as a table, query lifecycle log, and in-flight quality metrics."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("at", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("rows", T.LongType()),
        T.StructField("input_rate", T.DoubleType()),
        T.StructField("processing_rate", T.DoubleType()),
        T.StructField("dropped_late", T.LongType()),
    ]
)
LIFECYCLE_SCHEMA = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("detail", T.StringType()),
    ]
)


def progress_row(progress) -> tuple:
    """One micro-batch; zero and missing measurements are left out, as null."""
    duration = progress.batchDuration / 1000.0 if progress.batchDuration else None
    dropped = sum(op.numRowsDroppedByWatermark or 0 for op in progress.stateOperators or [])
    return (
        progress.name or str(progress.id)[:8],
        progress.batchId,
        progress.timestamp,
        duration,
        progress.numInputRows or None,
        progress.inputRowsPerSecond or None,
        progress.processedRowsPerSecond or None,
        dropped,
    )


class ProgressLog(StreamingQueryListener):
    """Writes progress rows under ``path/progress`` and lifecycle events under ``path/lifecycle``.

    Only what has not filled a buffer yet is held in memory; ``table`` and ``lifecycle`` write
    that out first, so they have everything.  Register with ``spark.streams.addListener(log)``.
    """

    def __init__(self, spark: SparkSession, path: str, buffer: int = 500):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buffer = buffer
        self._rows: list[tuple] = []
        self._events: list[tuple] = []
        self._names: dict[str, str] = {}
        self._ended: set[str] = set()
        self._written: set[str] = set()
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        name = event.name or str(event.id)[:8]
        with self._lock:
            self._names[str(event.id)] = name
            self._events.append((name, "started", None))
            self._ended.discard(name)
            full = len(self._events) >= self.buffer
        if full:
            self.flush()

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._rows.append(progress_row(event.progress))
            full = len(self._rows) >= self.buffer
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            name = self._names.pop(str(event.id), str(event.id)[:8])
            state = "failed" if event.exception else "terminated"
            self._events.append((name, state, event.exception))
            self._ended.add(name)
            full = len(self._events) >= self.buffer
        if full:
            self.flush()

    def await_end(self, query: str, seconds: float = 60.0) -> bool:
        """Wait until the end of a query has been reported; reports arrive asynchronously."""
        deadline = time.monotonic() + seconds
        while time.monotonic() < deadline:
            with self._lock:
                if query in self._ended:
                    return True
            time.sleep(0.05)
        return False

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
            events, self._events = self._events, []
        self._append("progress", rows, PROGRESS_SCHEMA)
        self._append("lifecycle", events, LIFECYCLE_SCHEMA)

    def _append(self, name: str, rows: list[tuple], schema: T.StructType) -> None:
        if rows:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")
            self._written.add(name)

    def _stored(self, name: str, schema: T.StructType) -> DataFrame:
        self.flush()
        if name not in self._written:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def table(self) -> DataFrame:
        """All progress so far."""
        return self._stored("progress", PROGRESS_SCHEMA)

    def lifecycle(self) -> DataFrame:
        """Every start and end of a query so far."""
        return self._stored("lifecycle", LIFECYCLE_SCHEMA)


def observe_quality(df: DataFrame, time: str, bad, name: str = "quality") -> DataFrame:
    """Rows in, rows bad and newest event time of every micro-batch, read from its progress."""
    return df.observe(
        name,
        F.count("*").alias("rows_in"),
        F.count_if(bad).alias("rows_bad"),
        F.max(time).alias("max_event_time"),
    )
