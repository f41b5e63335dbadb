"""Separating late rows from on-time rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.ordered import max_before
from tideline.session import stored


def interval(text: str) -> Column:
    return F.expr(f"interval {text}")


def flag_late(events: DataFrame, batch: str, time: str, delay: str) -> DataFrame:
    """Add ``watermark`` and ``is_late``.

    A row is late when its time is before the largest time of all *earlier* batches minus
    ``delay``.  The table of one row per batch is stored, so that the events are read twice and
    not once for each use of it.  Nothing is hinted: it is broadcast only if Spark finds it small
    enough, else joined by a skew-aware sort-merge join.
    """
    maxima = stored(events.groupBy(batch).agg(F.max(time).alias("m__")), "batch-maxima")
    marks = max_before(maxima, batch, "m__", "seen__")
    flagged = events.join(marks, batch, "left")
    watermark = F.col("seen__") - interval(delay)
    return (
        flagged.withColumn("watermark", watermark)
        .withColumn("is_late", F.coalesce(F.col(time) < F.col("watermark"), F.lit(False)))
        .drop("seen__")
    )
