"""Running values over rows in order, in runs: no task sees a whole key, whatever its size.

Rows are dealt out by ranges of (key, order), so a key with a third of all rows fills a third of
the runs.  Each run is scanned on its own and leaves one summary row per key; what a key carries
from its earlier runs comes from these rows alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tideline.session import stored


def in_runs(rows: DataFrame, keys: list[str], order: list[Column], runs: int | None = None) -> DataFrame:
    """``rows`` with the number ``run__`` of their range of (keys, order), stored.

    By default as many ranges as there are shuffle partitions, fewer if adaptive execution finds
    them small.
    """
    ranges = [*[F.col(k) for k in keys], *order]
    dealt = rows.repartitionByRange(runs, *ranges) if runs else rows.repartitionByRange(*ranges)
    return stored(dealt.withColumn("run__", F.spark_partition_id()), "runs")


def carry_forward(
    rows: DataFrame, keys: list[str], order: list[Column], value: str, alias: str, runs: int | None = None
) -> DataFrame:
    """Each row with the last ``value`` that is not null among the rows of its keys up to it.

    ``order`` should tell rows apart: among equal rows any may be first.  Null keys are a key.
    """
    dealt = in_runs(rows, keys, order, runs)
    inside = W.partitionBy("run__", *keys).orderBy(*order)
    scanned = dealt.withColumns(
        {
            alias: F.last(value, ignorenulls=True).over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)),
            "place__": F.row_number().over(inside),
        }
    )
    # One row per run and key; the last value of a run is the one at its last row.
    ends = scanned.groupBy("run__", *keys).agg(F.max_by(F.struct(alias), "place__").alias("end__"))
    earlier = W.partitionBy(*keys).orderBy("run__").rowsBetween(W.unboundedPreceding, -1)
    carried = F.last(F.col(f"end__.{alias}"), ignorenulls=True).over(earlier)
    # Only keys of several runs carry anything: at most two rows per run are left.
    carries = ends.select("run__", *keys, carried.alias("carry__")).where("carry__ IS NOT NULL")
    same = reduce(
        lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys], F.col("l.run__") == F.col("r.run__")
    )
    joined = scanned.alias("l").join(carries.alias("r"), same, "left")
    return joined.select(*[f"l.{c}" for c in rows.columns], F.coalesce(f"l.{alias}", "r.carry__").alias(alias))
