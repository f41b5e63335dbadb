"""Per-batch routing: late rows, alerts in cooldown, and bad messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators import cdc
from tideline.operators.alerts import cooldown
from tideline.operators.dlq import dead_letters, retries_so_far, split
from tideline.operators.late import interval
from tideline.plans.spec import Domain
from tideline.sinks import files
from tideline.sinks.keyed import KeyedTable
from tideline.sources.decode import checked

BatchSink = Callable[[DataFrame, int], None]


class LateRouter:
    """``foreachBatch`` function: on-time rows to one sink, late rows to another.

    Late means before the largest event time of all earlier batches minus ``delay``.  Each
    batch leaves the largest time so far in a one-row folder named after it and reads only
    its predecessor's, so a replayed batch meets the same watermark even on a new driver.
    """

    def __init__(self, state: str, time: str, delay: str, on_time: BatchSink, late: BatchSink):
        self.state = state.rstrip("/")
        self.time = time
        self.delay = delay
        self.on_time = on_time
        self.late = late

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        kind = batch.schema[self.time].dataType
        batch.persist()
        try:
            before = None
            if batch_id > 0:
                schema = T.StructType([T.StructField("seen", kind)])
                before = batch.sparkSession.read.schema(schema).parquet(f"{self.state}/{batch_id - 1}").first().seen
            before = F.lit(before).cast(kind)
            seen = batch.agg(F.greatest(F.max(self.time), before).alias("seen"))
            seen.coalesce(1).write.mode("overwrite").parquet(f"{self.state}/{batch_id}")
            files.remove(batch.sparkSession, f"{self.state}/{batch_id - 2}")  # only the last may be replayed
            is_late = F.coalesce(F.col(self.time) < before - interval(self.delay), F.lit(False))
            self.on_time(batch.filter(~is_late), batch_id)
            self.late(batch.filter(is_late), batch_id)
        finally:
            batch.unpersist()


class CooldownSink:
    """``foreachBatch`` function: alert rows in, alerts that fire out to ``path``.

    The state is what earlier batches fired: each batch leaves, in a folder named after it,
    the last firing of every alert so far and reads only its predecessor's.  Inside a batch
    rows are taken in event-time order by the same distributed operator tables use; a row
    that arrives after a later one has fired is judged against that firing.
    """

    def __init__(self, path: str, period: str, ties: list[str]):
        self.path = path.rstrip("/")
        self.period = period
        self.ties = ties

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = T.StructType([batch.schema["alert"], T.StructField("last", batch.schema["alert_time"].dataType)])
        before = spark.createDataFrame([], schema)
        if batch_id > 0:
            before = spark.read.schema(schema).parquet(f"{self.path}/state/{batch_id - 1}")
        free = F.col("last").isNull() | (F.col("alert_time") >= F.col("last") + interval(self.period))
        open_rows = batch.join(before, "alert", "left").filter(free).drop("last").persist()
        try:
            folder = f"{self.path}/fired/batch_id={batch_id}"
            cooldown(open_rows, self.period, self.ties).write.mode("overwrite").parquet(folder)
            fired = spark.read.schema(batch.schema).parquet(folder)
            last = fired.select("alert", F.col("alert_time").alias("last")).unionByName(before)
            last = last.groupBy("alert").agg(F.max("last").alias("last"))
            last.write.mode("overwrite").parquet(f"{self.path}/state/{batch_id}")
            files.remove(spark, f"{self.path}/state/{batch_id - 2}")  # only the last may be replayed
        finally:
            open_rows.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/fired").drop("batch_id")


class ChangeTable:
    """``ChangeRouter`` handler: one table's current rows, kept by key.

    A batch adds its last change of each key to the buckets of these keys; a change that arrives
    after a later one of its key is kept behind it.  A replayed batch changes nothing.
    """

    def __init__(self, path: str, row: T.StructType, keys: list[str], buckets: int = 16, fold_after: int = 8):
        self.row = row
        self.keys = keys
        self.table = KeyedTable(path, keys, ["lsn", "offset"], buckets, fold_after)

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        self.table(cdc.last_changes(changes, self.row, self.keys), batch_id)

    def read(self, spark: SparkSession, at: dict | None = None) -> DataFrame:
        """The rows that exist, without those whose last change is a delete."""
        return cdc.live_rows(self.table.read(spark, at))


class DeadLetterSplit:
    """``foreachBatch`` function: good messages to one sink, failed ones as dead letters.

    A message that was replayed says how often, so its retries add up.  Letters carry the
    message's own time where it has one, so a repeated batch leaves the same letters.
    """

    def __init__(self, domain: Domain, good: BatchSink, bad: BatchSink):
        self.domain = domain
        self.good = good
        self.bad = bad

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        rows = checked(messages, self.domain).persist()
        try:
            good, bad = split(rows)
            self.good(good, batch_id)
            at = F.unix_millis("timestamp") if "timestamp" in messages.columns else None
            self.bad(dead_letters(bad, failed_at=at, retry_count=retries_so_far(bad)), batch_id)
        finally:
            rows.unpersist()
