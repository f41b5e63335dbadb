"""Alerts on aggregates and on single events, their cooldown, and windows without events."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tideline.functions.predicates import condition_column
from tideline.functions.times import duration_micros, wall_micros
from tideline.operators.late import interval
from tideline.operators.ordered import join_null_safe, lag_over_time
from tideline.operators.scan import carry_forward
from tideline.plans.spec import AggregationSpec, AlertSpec, resolve_path
from tideline.session import discard, scratch_path, ship, stored


def metric_alerts(aggregated: DataFrame, alert: AlertSpec, spec: AggregationSpec, time: str = "window_end") -> DataFrame:
    """Windows (flattened) whose measure meets the alert's condition."""
    hit = condition_column(alert.condition, lambda path: path, default_field=spec.measure)
    return aggregated.filter(hit).withColumns(
        {"alert": F.lit(alert.name), "severity": F.lit(alert.severity), "alert_time": F.col(time)}
    )


def event_alerts(events: DataFrame, alert: AlertSpec, entity_key: str | None = None, time: str = "event_time") -> DataFrame:
    """Events of the alert's type that meet its condition."""
    columns = events.columns
    hit = condition_column(alert.condition, lambda path: resolve_path(path, entity_key, columns))
    return events.filter((F.col("event_type") == alert.event_type) & hit).withColumns(
        {"alert": F.lit(alert.name), "severity": F.lit(alert.severity), "alert_time": F.col(time)}
    )


# ---------------------------------------------------------------- cooldown on a table


def _next_firing(times: DataFrame, period: int) -> DataFrame:
    """(alert, t, next): the first time of the alert at or after t + period, or null."""
    points = times.select("alert", "t", F.col("t").alias("hit"), F.lit(None).cast("long").alias("since"), F.lit(0).alias("side"))
    asked = times.select(
        "alert", (F.col("t") + period).alias("t"), F.lit(None).cast("long").alias("hit"), F.col("t").alias("since"), F.lit(1).alias("side")
    )
    mixed = carry_forward(points.unionByName(asked), ["alert"], [F.desc("t"), F.asc("side")], "hit", "next")
    return mixed.where("side = 1").select("alert", F.col("since").alias("t"), "next")


# The edges that may enter blocks of twice the width: those of the first half, and that of the
# least time of the second.  An edge from the first half into the second goes on from there.
_LEVEL = """
WITH e AS (SELECT alert, t, next, (t - {lo}L) div {width}L AS block FROM {edges}),
     least AS (SELECT alert, min(t) AS t FROM e WHERE block % 2 = 1 GROUP BY alert, block),
     l AS (SELECT * FROM e WHERE block % 2 = 0 UNION ALL SELECT e.* FROM e LEFT SEMI JOIN least USING (alert, t))
SELECT l.alert, l.t, if(r.block IS NOT NULL, r.next, l.next) AS next
FROM l LEFT JOIN e r ON r.alert = l.alert AND r.t = l.next AND r.block = l.block + 1 AND l.block % 2 = 0
"""
# The entries of blocks of half the width: each entry, and where it leads from the first half.
_ENTERED = """
SELECT n.alert, explode(if(e.next IS NOT NULL AND (e.t - {lo}L) div {width}L % 2 = 0
                           AND (e.next - {lo}L) div {width}L = (e.t - {lo}L) div {width}L + 1,
                        array(e.t, e.next), array(n.t))) AS t
FROM {entered} n JOIN {edges} e ON e.alert = n.alert AND e.t = n.t
"""


#: Times (of 16 bytes or little more) whose chains one task follows.
SMALL = 1_000_000


def _followed(times: DataFrame, period: int) -> DataFrame:
    """The firings of times that fit one task, chain by chain."""
    ship(times.sparkSession)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for r in batches]
        if not rows:
            return
        table = pa.Table.from_batches(rows).sort_by([("alert", "ascending"), ("t", "ascending")])
        alerts, times = table.column("alert").to_pylist(), table.column("t").to_numpy()
        fired, first = [], 0
        for end in [k for k in range(1, len(alerts) + 1) if k == len(alerts) or alerts[k] != alerts[k - 1]]:
            own = times[first:end]
            after = np.searchsorted(own, own + period).tolist()
            at = 0
            while at < len(own):
                fired.append(first + at)
                at = after[at]
            first = end
        yield from table.take(pa.array(fired, pa.int64())).combine_chunks().to_batches()

    return times.coalesce(1).mapInArrow(follow, times.schema)


def cooldown(alerts: DataFrame, period: str, ties: list[str], small: int = SMALL) -> DataFrame:
    """Suppress an alert until ``period`` has passed since it last *fired* (event time).

    Input needs ``alert`` and ``alert_time``; of rows with equal time the first by ``ties``
    stands for all, rows without a time or alert never fire.  Exact, although each firing depends
    on the one before, and no task sees a whole alert.

    Each time has an edge to its alert's first time a period later.  The firings are the chain
    of edges from the first time; it is found by doubling.  Time is cut into blocks of one
    period, of two, of four...  A block can only be entered in its first period or, where that
    is empty further on, at its first time after; from there the edges of its halves give the
    first firing behind it with one join.  So each level keeps about half the edges of the one
    below.  Back down the levels, the entry of a block enters its first half, and the edge of
    the first half enters the second: in blocks of one period the entries are the firings.

    At most ``small`` distinct times are followed in one task instead, with the same result.
    The levels and the result are stored; all but the result is removed again.
    """
    spark = alerts.sparkSession
    folder = scratch_path(spark, "cooldown")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    micros = duration_micros(period)
    # The row number keeps a single row per map task and (alert, instant).
    first = W.partitionBy("alert", "alert_time").orderBy(*ties)
    known = alerts.filter("alert IS NOT NULL AND alert_time IS NOT NULL")
    distinct = known.withColumn("rn__", F.row_number().over(first)).filter("rn__ = 1").drop("rn__")
    distinct = kept(distinct.withColumn("t", _micros_of(alerts, "alert_time")), "alerts")
    span = distinct.agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.count("*").alias("n")).first()
    times = distinct.select("alert", "t")
    entered = _followed(times, micros) if span.n <= small else _doubled(times, micros, span.lo, span.hi, kept)
    fired = stored(distinct.join(entered, ["alert", "t"], "left_semi").drop("t"), "cooldown-fired")
    discard(spark, folder)
    return fired


def _doubled(times: DataFrame, micros: int, lo: int, hi: int, kept: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The firings, by the edges of blocks of more and more periods and back."""
    spark = times.sparkSession
    height = ((hi - lo) // micros).bit_length()  # blocks of 2 ** height periods hold all

    levels = [kept(_next_firing(times, micros), "level_0")]
    for level in range(height):
        above = spark.sql(_LEVEL.format(edges="{edges}", lo=lo, width=micros << level), edges=levels[-1])
        levels.append(kept(above, f"level_{level + 1}"))
    entered = levels[-1].groupBy("alert").agg(F.min("t").alias("t"))
    for level in reversed(range(height)):
        below = _ENTERED.format(entered="{entered}", edges="{edges}", lo=lo, width=micros << level)
        entered = spark.sql(below, entered=entered, edges=levels[level])
        if level and level % 8 == 0:  # a plan of a few joins at a time
            entered = kept(entered, f"entered_{level}")
    return entered


def _micros_of(df: DataFrame, name: str) -> Column:
    if dict(df.dtypes)[name] == "timestamp_ntz":
        return wall_micros(name)
    return F.unix_micros(name)


# ------------------------------------------------------------- windows without events


def fill_absent_windows(
    aggregated: DataFrame, keys: list[str], measure: str, step: str, chunk: int = 4096, until: Column | None = None
) -> DataFrame:
    """Every window from a group's first to its last, with measure 0 where it had no events.

    ``until`` (a window start, such as that of the newest event or the watermark) carries every
    group on to there, so that one which falls silent is seen.

    Input is flattened (``window_start``, ``window_end``) and tumbling by ``step``.  The
    spine is exploded in two levels, so no array holds more than ``chunk`` windows.  The input is
    stored first, as it is read for the bounds and for the values.
    """
    aggregated = stored(aggregated, "windows")
    micros = duration_micros(step)
    wide = interval(f"{micros * chunk} microseconds")
    bounds = aggregated.groupBy(*keys).agg(F.min("window_start").alias("lo__"), F.max("window_start").alias("hi__"))
    if until is not None:
        bounds = bounds.withColumn("hi__", F.greatest("hi__", until))
    blocks = bounds.select("*", F.explode(F.sequence("lo__", "hi__", wide)).alias("from__"))
    last = F.least(F.col("hi__"), F.col("from__") + interval(f"{micros * (chunk - 1)} microseconds"))
    spine = blocks.select(*keys, F.explode(F.sequence("from__", last, interval(step))).alias("window_start"))
    spine = spine.withColumn("window_end", F.col("window_start") + interval(step))
    filled = join_null_safe(spine, aggregated.select("window_start", *keys, measure), ["window_start", *keys])
    return filled.withColumn(measure, F.coalesce(F.col(measure), F.lit(0)))


def change_since_previous(
    aggregated: DataFrame, keys: list[str], measure: str, time: str = "window_start", chunk: str = "7 days"
) -> DataFrame:
    """Each window with the measure of the group's previous window and the difference."""
    lagged = lag_over_time(aggregated, keys, time, measure, "previous", chunk)
    return lagged.withColumn("delta", F.col(measure) - F.col("previous"))
