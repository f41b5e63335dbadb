"""Starting, awaiting and stopping streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

OUTPUT_MODES = ("append", "update", "complete")


class StreamRunner:
    """One checkpoint folder per query name, one trigger for all queries.

    ``trigger`` is a processing-time interval, or ``None`` to take all available input
    and stop.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, trigger: str | None = "10 seconds"):
        self.spark = spark
        self.checkpoint = checkpoint.rstrip("/")
        self.trigger = trigger
        self.queries: list[StreamingQuery] = []

    def _writer(self, df: DataFrame, name: str, mode: str) -> DataStreamWriter:
        if mode not in OUTPUT_MODES:
            raise ValueError(f"unknown output mode: {mode}")
        writer = df.writeStream.outputMode(mode).queryName(name)
        writer = writer.option("checkpointLocation", f"{self.checkpoint}/{name}")
        if self.trigger is None:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=self.trigger)

    def _start(self, writer: DataStreamWriter) -> StreamingQuery:
        query = writer.start()
        self.queries.append(query)
        return query

    def console(self, df: DataFrame, name: str, mode: str = "update") -> StreamingQuery:
        return self._start(self._writer(df, name, mode).format("console").option("truncate", "false"))

    def memory(self, df: DataFrame, name: str, mode: str = "complete") -> StreamingQuery:
        """Result table on the driver: for tests only.  Complete mode restarts from scratch."""
        writer = df.writeStream.outputMode(mode).format("memory").queryName(name)
        if self.trigger is None:
            writer = writer.trigger(availableNow=True)
        return self._start(writer)

    def foreach_batch(
        self, df: DataFrame, function: Callable[[DataFrame, int], None], name: str, mode: str = "update"
    ) -> StreamingQuery:
        return self._start(self._writer(df, name, mode).foreachBatch(function))

    def files(self, df: DataFrame, path: str, name: str, partition_by: list[str] | None = None) -> StreamingQuery:
        """Parquet files with exactly-once commits; any Hadoop-compatible URI."""
        writer = self._writer(df, name, "append").format("parquet").option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        return self._start(writer)

    def await_any(self, timeout: float | None = None) -> bool | None:
        """Wait until any query ends; ``timeout`` is in seconds."""
        if timeout is None:
            return self.spark.streams.awaitAnyTermination()
        return self.spark.streams.awaitAnyTermination(timeout)

    def await_all(self) -> None:
        for query in self.queries:
            query.awaitTermination()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()
