"""Sessions and funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tideline.operators.late import interval
from tideline.session import stored


def sessionize(events: DataFrame, keys: list[str], time: str, gap: str) -> DataFrame:
    """Sessions of a table: ``session_start, session_end (last event + gap), events`` per key.

    Two events in the same gap-wide slot of the clock always share a session, so rows are
    first reduced to one row per (key, slot) with a map-side combine.  Only those rows are
    ordered per key: a key holding a third of all events still contributes at most one row
    per slot.
    """
    slots = events.groupBy(*keys, F.window(time, gap).start.alias("slot__")).agg(
        F.min(time).alias("first__"), F.max(time).alias("last__"), F.count("*").alias("n__")
    )
    order = W.partitionBy(*keys).orderBy("slot__")
    before = F.lag("last__").over(order)
    starts = F.when(F.col("first__") <= before + interval(gap), 0).otherwise(1)
    numbered = slots.withColumn("new__", starts).withColumn("session__", F.sum("new__").over(order))
    return (
        numbered.groupBy(*keys, "session__")
        .agg(
            F.min("first__").alias("session_start"),
            (F.max("last__") + interval(gap)).alias("session_end"),
            F.sum("n__").alias("events"),
        )
        .drop("session__")
    )


def sessionize_stream(events: DataFrame, keys: list[str], time: str, gap: str) -> DataFrame:
    """The streaming form, closed by the watermark (append mode)."""
    return (
        events.groupBy(*keys, F.session_window(time, gap).alias("s__"))
        .agg(F.count("*").alias("events"))
        .select(*keys, F.col("s__.start").alias("session_start"), F.col("s__.end").alias("session_end"), "events")
    )


def funnel(events: DataFrame, key: str, time: str, kind: str, steps: list[str]) -> DataFrame:
    """How far each key gets through ordered steps.

    ``<step>_at`` is the first time of that step at or after the previous step's; ``stage``
    counts the steps reached.  Each step reads the events once: they meet the one row per key
    reached so far in an inner join, whose skewed keys adaptive execution splits, and are reduced
    to one row per key again.  What is reached is a stored table, so no step repeats another.
    """
    first = f"{steps[0]}_at"
    reached = events.filter(F.col(kind) == steps[0]).groupBy(key).agg(F.min(time).alias(first))
    for previous, step in zip(steps, steps[1:]):
        reached = stored(reached, "funnel")
        since = reached.select(key, F.col(f"{previous}_at").alias("since__")).filter("since__ IS NOT NULL")
        after = events.filter(F.col(kind) == step).select(key, F.col(time).alias("t__")).join(since, key)
        found = after.filter("t__ >= since__").groupBy(key).agg(F.min("t__").alias(f"{step}_at"))
        reached = reached.join(found, key, "left")
    stage = sum((F.col(f"{s}_at").isNotNull().cast("int") for s in steps), F.lit(0))
    return reached.withColumn("stage", stage)
