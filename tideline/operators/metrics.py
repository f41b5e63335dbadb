"""Counters, histograms, quantiles and rates as aggregates over events or progress rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.times import duration_micros

# Histogram bounds (upper bounds, inclusive).
PRODUCE_LATENCY_SECONDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0)
BATCH_DURATION_SECONDS = (0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0)
BATCH_ROWS = (10, 50, 100, 500, 1000, 5000, 10000)
SINK_LATENCY_SECONDS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)


def count_by_label(rows: DataFrame, labels: list[str], amount: str | None = None) -> DataFrame:
    """A labelled counter: occurrences and, where ``amount`` is given, its total."""
    measures = [F.count("*").alias("count")]
    if amount:
        measures.append(F.sum(amount).alias("total"))
    return rows.groupBy(*labels).agg(*measures)


def histogram(rows: DataFrame, value: str, bounds: tuple[float, ...], labels: list[str]) -> DataFrame:
    """Cumulative counts per upper bound in one pass: ``buckets`` (array), ``sum``, ``count``."""
    v = F.col(value)
    # Counting each bound on its own keeps the buffer fixed-width, so it hashes map-side.
    cells = [F.count_if(v <= F.lit(float(b))).alias(f"le_{i}__") for i, b in enumerate(bounds)]
    wide = rows.groupBy(*labels).agg(*cells, F.sum(value).alias("sum"), F.count(value).alias("count"))
    buckets = F.array(*[F.col(f"le_{i}__") for i in range(len(bounds))])
    return wide.select(*labels, buckets.alias("buckets"), "sum", "count")


def bucket_rows(hist: DataFrame, bounds: tuple[float, ...], labels: list[str]) -> DataFrame:
    """One row per (labels, ``le``); the last, unbounded bucket has a null ``le``."""
    limits = F.array(*[F.lit(float(b)) for b in bounds], F.lit(None).cast("double"))
    cells = F.arrays_zip(limits.alias("le"), F.concat("buckets", F.array("count")).alias("n"))
    return hist.select(*labels, F.explode(cells).alias("c")).select(
        *labels, F.col("c.le").alias("le"), F.col("c.n").alias("cumulative_count")
    )


def histogram_quantile(q: float, bounds: tuple[float, ...]) -> Column:
    """Quantile from ``buckets`` and ``count``, linear inside a bucket whose floor is 0 or the
    previous bound; a rank past the last bound gives that bound, an empty histogram null."""
    result = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        rank = F.col("count") * q
        here = F.col("buckets")[i]
        below = F.col("buckets")[i - 1] if i else F.lit(0)
        floor = float(bounds[i - 1]) if i else min(0.0, float(bounds[0]))
        share = F.try_divide(rank - below, here - below)
        inside = F.lit(floor) + (float(bounds[i]) - floor) * F.coalesce(share, F.lit(1.0))
        result = F.when(here >= rank, inside).otherwise(result)
    return F.when(F.col("count") > 0, result)


def rate(rows: DataFrame, time: str, window: str, labels: list[str]) -> DataFrame:
    """Per-second rate of occurrences per tumbling window."""
    seconds = duration_micros(window) / 1_000_000
    counted = rows.groupBy(F.window(time, window), *labels).agg(F.count("*").alias("count"))
    return counted.withColumn("per_second", F.col("count") / F.lit(seconds))


def delivery_stats(rows: DataFrame, status: str = "status", retries: str | None = None) -> DataFrame:
    """Totals of sent, failed and retried deliveries."""
    retried = F.count_if(F.col(retries) > 0) if retries else F.lit(0).cast("bigint")
    return rows.agg(
        F.count_if(F.col(status) == "success").alias("sent"),
        F.count_if(F.col(status) == "error").alias("errors"),
        retried.alias("retried"),
    )
