"""Windows without events on a stream: closed up to now, whoever is silent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.late import interval
from tideline.sinks.keyed import KeyedTable
from tideline.sinks.writers import batch_folder


class AbsentWindows:
    """``foreachBatch`` function: closed windows in, the same with a row of 0 for each silent window out.

    Input is an append-mode count per tumbling window and group, flattened: a window comes once,
    when the watermark has passed it.  The newest window that any group has closed is *now*.  Every
    group known so far gets its windows up to now, with 0 where it had no events, until it has been
    silent for ``silent_for``; if it speaks again its windows go on from there.  A group's first
    window is the first that had events.

    When all groups are silent nothing moves now; ``heartbeat`` names a boolean column that marks
    windows of heartbeat rows (any rows that keep the watermark going): they move now and are left
    out of the result.

    Groups and their last window are a :class:`KeyedTable`; the output of a batch is a folder of
    its own, written before the state, so a repeated batch changes nothing.
    """

    def __init__(self, path: str, keys: list[str], measure: str, step: str, silent_for: str = "1 day", heartbeat: str | None = None):
        self.path = path.rstrip("/")
        self.keys = keys
        self.measure = measure
        self.step = step
        self.silent_for = silent_for
        self.heartbeat = heartbeat
        # The one row with nulls for keys and ``now`` stands for the clock of all groups.
        self.state = KeyedTable(f"{self.path}/state", [*keys, "clock"], ["last"])
        self.out = batch_folder(f"{self.path}/windows")

    def __call__(self, closed: DataFrame, batch_id: int) -> None:
        spark = closed.sparkSession
        seen = self.state.snapshot(spark)
        if seen is not None and batch_id <= seen["batch"]:
            return
        closed = closed.persist()
        try:
            own = closed.filter(~F.coalesce(F.col(self.heartbeat), F.lit(False))) if self.heartbeat else closed
            own = own.select("window_start", "window_end", *self.keys, self.measure)
            kind = closed.schema["window_start"].dataType
            blank = [F.lit(None).cast(closed.schema[k].dataType).alias(k) for k in self.keys]
            clock = closed.agg(F.max("window_start").alias("last")).filter("last IS NOT NULL")
            clock = clock.select(*blank, F.lit(True).alias("clock"), "last", F.col("last").alias("spoke"))
            if seen is not None:
                clock = clock.unionByName(self.state.read(spark, seen).filter("clock"))
            now = clock.agg(F.max("last")).first()[0]
            if now is None:
                return
            now = F.lit(now).cast(kind)
            spoken = own.groupBy(*self.keys).agg(F.min("window_start").alias("first"), F.max("window_start").alias("newest"))
            spoken = spoken.select(*self.keys, "first", "newest", F.lit(None).cast(kind).alias("last"), F.lit(None).cast(kind).alias("spoke"))
            known = spoken
            if seen is not None:
                before = self.state.read(spark, seen).filter("NOT clock")
                known = spoken.unionByName(before.select(*self.keys, "last", "spoke"), allowMissingColumns=True)
            groups = known.groupBy(*self.keys).agg(*[F.max(c).alias(c) for c in ("first", "newest", "last", "spoke")])
            step, silent = interval(self.step), interval(self.silent_for)
            # What the last batch had not filled, but no further than a silence that has lasted too long.
            awake = F.greatest("newest", "spoke") + silent
            begin = F.when(F.col("last").isNull(), F.col("first")).otherwise(F.col("last") + step)
            spans = groups.withColumns({"begin__": begin, "upto__": F.least(now, awake)})
            spine = spans.filter("begin__ <= upto__").select(*self.keys, F.explode(F.sequence("begin__", "upto__", step)).alias("window_start"))
            # Windows with events always come out, also after a silence.
            spine = spine.unionByName(own.select(*self.keys, "window_start")).distinct()
            filled = _same(spine, own.drop("window_end"), [*self.keys, "window_start"])
            filled = filled.withColumn(self.measure, F.coalesce(self.measure, F.lit(0))).withColumn("window_end", F.col("window_start") + step)
            self.out(filled.select("window_start", "window_end", *self.keys, self.measure), batch_id)
            last = F.greatest("last", "newest", F.least(now, awake))
            rows = groups.select(*self.keys, F.lit(False).alias("clock"), last.alias("last"), F.greatest("newest", "spoke").alias("spoke"))
            # The clock is one row, whatever came in.
            self.state(rows.unionByName(clock.groupBy(*self.keys, "clock").agg(F.max("last").alias("last"), F.max("spoke").alias("spoke"))), batch_id)
        finally:
            closed.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        """All windows so far."""
        return spark.read.parquet(f"{self.path}/windows").drop("batch_id")


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    on = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    rest = [f"r.{c}" for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), on, "left").select("l.*", *rest)
