"""Order-dependent building blocks that never put a whole key, or a whole table, in one task.

Time is cut into chunks.  Rows are only sorted inside (key, chunk); what must cross a chunk
border is first reduced to one row per (key, chunk) by an ordinary aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tideline.operators.scan import carry_forward


def chunk_of(time: str, width: str) -> Column:
    return F.window(time, width).start


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which null group keys match; keeps the left side's key columns."""
    renamed = right.select(*[F.col(k).alias(f"{k}__r") if k in keys else F.col(k) for k in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}__r")) for k in keys], F.lit(True))
    return left.join(renamed, on, how).drop(*[f"{k}__r" for k in keys])


def max_before(rows: DataFrame, order: str, value: str, alias: str, chunk: int = 4096) -> DataFrame:
    """For one row per integer ``order``: the largest ``value`` of all smaller orders."""
    chunked = rows.withColumn("c__", F.floor(F.col(order) / chunk))
    inside = W.partitionBy("c__").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    # One row per chunk of orders is left for the only unpartitioned window.
    above = W.orderBy("c__").rowsBetween(W.unboundedPreceding, -1)
    chunks = chunked.groupBy("c__").agg(F.max(value).alias("m__")).select("c__", F.max("m__").over(above).alias("b__"))
    return (
        chunked.withColumn("i__", F.max(value).over(inside))
        .join(chunks, "c__", "left")
        .select(order, F.greatest("i__", "b__").alias(alias))
    )


def lag_over_time(rows: DataFrame, keys: list[str], time: str, value: str, alias: str, chunk: str = "7 days") -> DataFrame:
    """``lag(value)`` per key in time order, for rows that are unique per (key, time)."""
    chunked = rows.withColumn("c__", chunk_of(time, chunk))
    inside = W.partitionBy(*keys, "c__").orderBy(time)
    lasts = chunked.groupBy(*keys, "c__").agg(F.max_by(value, time).alias("last__"))
    across = W.partitionBy(*(keys or [F.lit(0)])).orderBy("c__")
    previous = lasts.select(*keys, "c__", F.lag("last__").over(across).alias("before__"))
    marked = chunked.withColumns(
        {"i__": F.lag(value).over(inside), "first__": F.row_number().over(inside) == 1}
    )
    joined = join_null_safe(marked, previous, [*keys, "c__"])
    return joined.select(*rows.columns, F.when(F.col("first__"), F.col("before__")).otherwise(F.col("i__")).alias(alias))


def next_match(
    left: DataFrame,
    right: DataFrame,
    key: str,
    time: str,
    within: Column,
    payload: list[str],
    alias: str = "match",
    runs: int | None = None,
) -> DataFrame:
    """Each left row with the earliest right row of its key at or after it, or null.

    A match later than ``within`` after the left row does not count.  Both sides call their
    time ``time``; the match is a struct of that time and ``payload``, ties by payload order.
    Output has one row per left row: no pairs are ever materialised.  Both sides are scanned
    backwards in time in runs of equal size, so a key with very many rows at one time is split
    like any other.  A null key matches nothing.
    """
    match = F.struct(F.col(time).alias("time"), *payload)
    left_rows = left.withColumns({"side__": F.lit(1), "n__": F.monotonically_increasing_id()})
    right_rows = right.filter(F.col(key).isNotNull()).select(
        F.col(key), F.col(time), match.alias("m__"), F.lit(0).alias("side__"), F.lit(0).cast("long").alias("n__")
    )
    mixed = left_rows.unionByName(right_rows, allowMissingColumns=True)
    # Of equal times the right rows come first, the least payload last.
    order = [F.desc(time), F.asc("side__"), F.desc("m__"), F.asc("n__")]
    found = carry_forward(mixed, [key], order, "m__", "near__", runs).filter("side__ = 1")
    valid = F.col("near__.time") <= F.col(time) + within
    return found.select(*left.columns, F.when(valid, F.col("near__")).alias(alias))
