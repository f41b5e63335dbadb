"""Joins between event types, reference data and current-state tables."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tideline.functions.times import duration_micros

from tideline.operators.late import interval
from tideline.operators.ordered import next_match
from tideline.session import ship


def without_follow_up(first: DataFrame, second: DataFrame, key: str, time: str, within: str) -> DataFrame:
    """Rows of ``first`` with no ``second`` of the same key in [time, time + within].

    With time cut into slots as wide as ``within``, a follow-up exists exactly when the last
    ``second`` in the row's own slot is not before it, or the first ``second`` of the next
    slot is not too late.  So ``second`` shrinks to its least and greatest time per (key,
    slot) before anything is joined, and the join can neither multiply rows nor compare pairs.
    """
    slot = F.window(time, within).start
    spread = second.select(
        key,
        F.col(time).alias("t__"),
        F.explode(
            F.array(
                F.struct(slot.alias("slot"), F.lit(True).alias("own")),
                F.struct((slot - interval(within)).alias("slot"), F.lit(False).alias("own")),
            )
        ).alias("at__"),
    )
    marks = spread.groupBy(key, F.col("at__.slot").alias("slot__")).agg(
        F.max(F.when(F.col("at__.own"), F.col("t__"))).alias("last_own__"),
        F.min(F.when(~F.col("at__.own"), F.col("t__"))).alias("first_next__"),
    )
    joined = first.withColumn("slot__", slot).join(marks, [key, "slot__"], "left")
    followed = (F.col("last_own__") >= F.col(time)) | (F.col("first_next__") <= F.col(time) + interval(within))
    return joined.filter(~F.coalesce(followed, F.lit(False))).select(*first.columns)


def first_follow_up(
    first: DataFrame, second: DataFrame, key: str, time: str, within: str, payload: list[str], runs: int | None = None
) -> DataFrame:
    """Every row of ``first`` with its earliest follow-up inside ``within``, or null."""
    return next_match(first, second, key, time, interval(within), payload, runs=runs)


def without_follow_up_stream(
    first: DataFrame, second: DataFrame, key: str, time: str, within: str, delay: str, shards: int | None = None
) -> DataFrame:
    """The streaming form (append): a row is emitted once the watermark rules a follow-up out.

    As on a table, rows meet by slot of time and never as pairs: of the ``second`` rows the state
    keeps one greatest and one least time per key and slot, of the ``first`` rows those that are
    still open.  State is held by (shard of the keys, slot), so a key's rows of all time are never
    in one place; a timer wakes a group when its next row falls due, and it is gone when the
    watermark has passed its slot and all its rows.  The watermark is that of the side that lags.
    Rows behind it are dropped, as are ``first`` rows without a time; one without a key has no
    follow-up.  By default there are as many shards as shuffle partitions; like these, their number
    should stay what it was when the query was first started.
    """
    ship(first.sparkSession)
    shards = shards or int(first.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = duration_micros(within)
    names = first.columns
    clash = {"side__", "micros__", "key__", "shard__", "slot__"} & set(names)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in use")
    kind = first.schema[key].dataType
    opened = first.withWatermark(time, delay).withColumn("side__", F.lit(0))
    closing = second.select(F.col(key).cast(kind).alias(key), F.col(time)).withWatermark(time, delay)
    closing = closing.filter(F.col(key).isNotNull()).withColumn("side__", F.explode(F.array(F.lit(1), F.lit(2))))
    mixed = opened.unionByName(closing, allowMissingColumns=True).withColumn("micros__", F.unix_micros(time))
    # A second row stands in its own slot and, as one that comes after, in the slot before.
    slot = F.expr(f"floor(micros__ / {width}D) - IF(side__ = 2, 1, 0)").cast("long")
    shard = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(shards)).cast("int")
    grouped = mixed.filter("micros__ IS NOT NULL").withColumns({"shard__": shard, "slot__": slot}).groupBy("shard__", "slot__")
    decide = FollowUps(names, key, width)
    return grouped.applyInPandasWithState(
        decide, first.schema, "held binary", "append", GroupStateTimeout.EventTimeTimeout
    )


class FollowUps:
    """What happens to the open rows of one shard and slot as rows and the watermark come in."""

    def __init__(self, names: list[str], key: str, width: int):
        self.names = names
        self.key = key
        self.width = width

    def __call__(self, group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs()
        # Open rows; the last second row of each key in the slot; its first in the next slot.
        held, last, after = pickle.loads(state.get[0]) if state.exists else (None, {}, {})
        if not state.hasTimedOut:
            for frame in frames:
                frame = frame[frame["micros__"] >= passed * 1000]
                own = frame[frame["side__"] == 1].groupby(self.key)["micros__"].max()
                last = _merged(last, own, max)
                after = _merged(after, frame[frame["side__"] == 2].groupby(self.key)["micros__"].min(), min)
                rows = frame.loc[frame["side__"] == 0, [*self.names, "micros__"]]
                if len(rows):
                    held = rows if held is None else pd.concat([held, rows], ignore_index=True)
        due = None
        if held is not None and len(held):
            at, keys = held["micros__"], held[self.key]
            followed = (keys.map(last).fillna(-(2**62)) >= at) | (keys.map(after).fillna(2**62) <= at + self.width)
            held = held[~(followed & keys.notna())]
            ends = (held["micros__"] + self.width) // 1000
            ready = ends < passed
            if ready.any():
                yield held.loc[ready, self.names]
            held, ends = held[~ready], ends[~ready]
            due = int(ends.min()) if len(held) else None
        slot_end = (int(group[1]) + 1) * self.width // 1000
        if due is None and passed > slot_end:
            if state.exists:
                state.remove()
            return
        state.update((pickle.dumps((held, last, after)),))
        state.setTimeoutTimestamp(max(passed + 1, slot_end if due is None else due))


def _merged(held: dict, new: pd.Series, better) -> dict:
    for key, micros in new.items():
        held[key] = better(held.get(key, micros), micros)
    return held


def enrich(facts: DataFrame, reference: DataFrame, on: str | list[str] | Column, how: str = "left") -> DataFrame:
    """Add reference columns to a table or stream.

    No broadcast hint: Spark broadcasts the reference side when its statistics or the size
    seen at run time are below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise uses
    a sort-merge join whose skewed partitions adaptive execution splits.
    """
    return facts.join(reference, on, how)
