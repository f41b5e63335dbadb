"""Top-k per window, latest row per key, duplicate elimination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def top_per_window(aggregated: DataFrame, measure: str, k: int, ties: list[str], window: str = "window_start") -> DataFrame:
    """The ``k`` largest rows of every window, ties by ``ties``; adds ``rank``.

    Spark keeps only the best ``k`` of each window in every map task before the shuffle.
    """
    order = W.partitionBy(window).orderBy(F.desc(measure), *ties)
    return aggregated.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def latest(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The last row per key by ``order``.

    The filter on the row number lets Spark keep one row per key in every map task, so a
    key with a long history sends one row per task into the shuffle.
    """
    descending = [F.desc_nulls_last(o) if isinstance(o, str) else o.desc_nulls_last() for o in order]
    numbered = rows.withColumn("rn__", F.row_number().over(W.partitionBy(*keys).orderBy(*descending)))
    return numbered.filter("rn__ = 1").drop("rn__")


def deduplicate(events: DataFrame, keys: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """One row per key; on a stream, within the watermark the stream already carries.

    On a table the first row by ``order`` stays, by default the least in all other columns, so
    rows that differ under one key give the same result every time.
    """
    if events.isStreaming:
        return events.dropDuplicatesWithinWatermark(keys)
    by = order or [c for c in events.columns if c not in keys] or keys
    numbered = events.withColumn("rn__", F.row_number().over(W.partitionBy(*keys).orderBy(*by)))
    return numbered.filter("rn__ = 1").drop("rn__")
