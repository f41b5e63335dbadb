"""Mergeable state per pane of time: distinct counts and quantiles for any window made of panes.

A pane's row is a sketch of its values, small and of bounded size, that can be stored, added to
and merged.  One table of panes answers every window whose bounds fall on panes, of one batch, of
many, or of a stream that has added a few rows per micro-batch; the events are read once.

Distinct counts are HyperLogLog sketches: relative error 1.04 / sqrt(2 ** lg_k) per standard
deviation, exact for few values.  Quantiles are KLL sketches: the rank of an answer is off by
about 2.3 / k ** 0.9 of the rows in 99 of 100 cases, and exact up to about ``k`` values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.times import duration_micros
from tideline.operators.aggregate import window_column
from tideline.plans.spec import SpecError, WindowSpec

LG_K = 12
QUANTILE_K = 400


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative error of a distinct count, one standard deviation."""
    return 1.04 / (1 << lg_k) ** 0.5


def rank_error(k: int = QUANTILE_K) -> float:
    """Error of the rank of a quantile as a share of the rows, exceeded once in a hundred times."""
    return 2.296 / k**0.9021


def distinct_panes(events: DataFrame, field: str, pane: str, keys: list[str], time: str, lg_k: int = LG_K) -> DataFrame:
    """``pane_start``, the keys, ``rows`` and a sketch of the distinct values of ``field``.

    Nulls are no values; a pane of nulls alone has a sketch of nothing.  Works on tables and, as
    one state row per pane and group, on streams.
    """
    value = F.coalesce(F.col(field).cast("string"), F.lit(None))
    grouped = events.groupBy(F.window(time, pane).alias("pane__"), *keys)
    return grouped.agg(F.count("*").alias("rows"), F.hll_sketch_agg(value, lg_k).alias("sketch")).select(
        F.col("pane__.start").alias("pane_start"), *keys, "rows", "sketch"
    )


def distinct_over(panes: DataFrame, window: WindowSpec, keys: list[str], pane: str, measure: str = "unique_count") -> DataFrame:
    """Distinct values per window and group: the sketches of its panes, merged."""
    merged = panes.groupBy(_over(window, pane), *keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(measure))
    return merged


def quantile_panes(events: DataFrame, value: str, pane: str, keys: list[str], time: str, k: int = QUANTILE_K) -> DataFrame:
    """``pane_start``, the keys, ``rows`` and a sketch of the values' ranks; nulls are left out."""
    known = events.filter(F.col(value).isNotNull())
    grouped = known.groupBy(F.window(time, pane).alias("pane__"), *keys)
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k))
    return grouped.agg(F.count("*").alias("rows"), sketch.alias("sketch")).select(
        F.col("pane__.start").alias("pane_start"), *keys, "rows", "sketch"
    )


def quantiles_over(
    panes: DataFrame, quantiles: list[float], keys: list[str], window: WindowSpec | None = None, pane: str | None = None
) -> DataFrame:
    """``rows`` and ``quantiles`` (an array, in the order asked) per group, and per window if one is given."""
    by: list[Column | str] = [*keys] if window is None else [_over(window, pane), *keys]
    merged = panes.groupBy(*by).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("sketch"))
    found = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))) for q in quantiles])
    return merged.withColumn("quantiles", found).drop("sketch")


def _over(window: WindowSpec, pane: str) -> Column:
    """The windows of a pane; they must be made of whole panes."""
    lengths = [window.size] + ([window.slide] if window.kind == "sliding" else [])
    if any(duration_micros(length) % duration_micros(pane) for length in lengths):
        raise SpecError(f"{lengths} are not made of panes of {pane}")
    return window_column(window, "pane_start")
