"""Windowed aggregation of events: count, exact and approximate distinct, sum, average.

The same function serves stored tables and streams.  On a table, overlapping sliding
windows are computed from panes: rows are first reduced once per pane (the longest duration
dividing size and slide), and only those partial results are copied into every window that
covers them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tideline.functions.predicates import filter_column
from tideline.functions.times import common_pane, duration_micros, instant_to_wall
from tideline.operators.late import interval
from tideline.operators.ordered import join_null_safe
from tideline.plans.spec import AggregationSpec, SpecError, WindowSpec, resolve_path

# Copies per row from which panes, and for distinct values intervals, pay for their extra shuffle:
# at 5 copies of 3 million rows both ways take the same time, at 12 intervals take half.
PANE_RATIO = 3
PANE_RATIO_DISTINCT = 8
# Windows in one array or one chunk of a running total.
_CHUNK = 4096
_WHOLE = {"byte", "short", "integer", "long"}


def window_column(spec: WindowSpec, time: str) -> Column:
    if spec.kind == "tumbling":
        return F.window(time, spec.size)
    return F.window(time, spec.size, spec.slide)


def copies(spec: WindowSpec) -> int:
    """Into how many windows one event falls."""
    if spec.kind == "tumbling":
        return 1
    return -(-duration_micros(spec.size) // duration_micros(spec.slide))


def aggregate(
    df: DataFrame,
    spec: AggregationSpec,
    time: str = "event_time",
    entity_key: str | None = None,
    output_mode: str = "append",
    approximate: float | None = None,
    try_sum: bool = False,
    panes: bool | None = None,
) -> DataFrame:
    """Apply one spec.  Result: ``window``, group columns, and the spec's measure.

    ``output_mode`` only matters for exact distinct counts on a stream, ``approximate`` is
    the relative error of an approximate one, ``try_sum`` turns a sum of whole numbers that is
    out of their range into null instead of an error, and ``panes`` forces pane pre-aggregation on
    or off, which changes no result.
    """
    columns = df.columns

    def resolve(path: str) -> str:
        return resolve_path(path, entity_key, columns)

    if spec.where is not None:
        df = df.filter(filter_column(spec.where, resolve))
    keys = [resolve(path) for path in spec.group_by]
    if len(set(keys)) != len(keys):
        raise SpecError(f"{spec.name}: repeated group_by columns {keys}")
    field = resolve(spec.field) if spec.field else None

    # A sketch cannot be merged from panes with built-in counts, so it reads the rows directly.
    if panes is None:
        enough = PANE_RATIO_DISTINCT if spec.kind == "count_distinct" else PANE_RATIO
        panes = not df.isStreaming and copies(spec.window) >= enough
    if approximate is not None and spec.kind == "count_distinct":
        return df.groupBy(window_column(spec.window, time), *keys).agg(
            F.approx_count_distinct(field, approximate).alias(spec.measure)
        )
    if spec.kind == "count_distinct":
        return _distinct(df, spec, time, keys, field, output_mode, panes)

    whole = try_sum and spec.kind == "sum" and df.schema[field].dataType.typeName() in _WHOLE
    if whole:
        # Added up exactly, so that only a total out of range is null, in whatever order and
        # parts it is taken.
        df = df.withColumn("v__", F.col(field).cast("decimal(20,0)"))
        field = "v__"

    elif try_sum and spec.kind == "sum":
        panes = False  # an overflow is only seen where the rows themselves are added

    def total(column: str) -> Column:
        return F.try_sum(column) if try_sum and not whole else F.sum(column)

    def last(column: Column) -> Column:
        return column.try_cast("bigint") if whole else column

    if not panes or spec.window.kind == "tumbling":
        measure = {"count": lambda: F.count("*"), "sum": lambda: last(total(field)), "avg": lambda: F.avg(field)}
        return df.groupBy(window_column(spec.window, time), *keys).agg(measure[spec.kind]().alias(spec.measure))

    partial = {
        "count": lambda: [F.count("*").alias("n__")],
        "sum": lambda: [total(field).alias("s__")],
        # As avg() itself does, so that panes cannot overflow where plain rows do not.
        "avg": lambda: [F.sum(_as_average_sum(df, field)).alias("s__"), F.count(field).alias("n__")],
    }[spec.kind]()
    final = {
        "count": lambda: F.sum("n__"),
        "sum": lambda: last(total("s__")),
        "avg": lambda: F.try_divide(F.sum("s__"), F.sum("n__")),
    }[spec.kind]()
    pane = F.window(time, common_pane(spec.window.size, spec.window.slide)).alias("pane__")
    paned = df.groupBy(pane, *keys).agg(*partial).withColumn("pane_start__", F.col("pane__.start")).drop("pane__")
    return paned.groupBy(window_column(spec.window, "pane_start__"), *keys).agg(final.alias(spec.measure))


def _as_average_sum(df: DataFrame, field: str) -> Column:
    """What an average adds up: decimals as they are, all other numbers as doubles."""
    kind = df.select(field).schema[0].dataType.typeName()
    return F.col(field) if kind.startswith("decimal") else F.col(field).cast("double")


def _distinct(
    df: DataFrame, spec: AggregationSpec, time: str, keys: list[str], field: str, output_mode: str, panes: bool
) -> DataFrame:
    if not df.isStreaming and panes and spec.window.kind == "sliding":
        return _distinct_by_intervals(df, spec, time, keys, field)
    window = window_column(spec.window, time)
    if not df.isStreaming:
        return df.groupBy(window, *keys).agg(F.count_distinct(field).alias(spec.measure))

    # Streams reject DISTINCT aggregates.  Both forms keep one small state row per (window,
    # group, value), spread by all three, and never a whole set of values in one row.
    values = df.select(window.alias("window"), *[F.col(k) for k in keys], F.col(field).alias("v__"))
    if output_mode == "append":
        values = values.groupBy("window", *keys, "v__").agg(F.lit(1).alias("one__"))
    else:
        values = values.dropDuplicates()
    return values.groupBy("window", *keys).agg(F.count("v__").alias(spec.measure))


def _distinct_by_intervals(df: DataFrame, spec: AggregationSpec, time: str, keys: list[str], field: str) -> DataFrame:
    """Distinct values of sliding windows, from when each value is in the window at all.

    An event is in an unbroken row of windows, and those of one value's events in time order join
    up wherever they touch.  Each such interval of window starts adds one where it begins and
    takes it away after its end, so a value sends two rows for each interval and not one for
    each window; the changes of a group, added up in order of time, are the counts.
    """
    size, slide = interval(spec.window.size), interval(spec.window.slide)
    start = F.window(time, spec.window.slide).start
    first = F.window(F.col(time) - size, spec.window.slide).start + slide
    names = [f"g{i}__" for i in range(len(keys))]
    groups = [F.col(k).alias(n) for k, n in zip(keys, names)]
    spans = df.filter(F.col(time).isNotNull()).select(*groups, F.col(field).alias("v__"), first.alias("a__"), start.alias("b__")).distinct()
    of_value = W.partitionBy(*names, "v__").orderBy("a__", "b__")
    begins = F.coalesce(F.col("a__") > F.lag("b__").over(of_value) + slide, F.lit(True))
    ends = F.coalesce(F.lead("a__").over(of_value) > F.col("b__") + slide, F.lit(True))
    marked = spans.withColumns({"begins__": begins, "ends__": ends})
    steps = F.array(
        F.when(F.col("begins__"), F.struct(F.col("a__").alias("at"), F.lit(1).alias("d"))),
        F.when(F.col("ends__"), F.struct((F.col("b__") + slide).alias("at"), F.lit(-1).alias("d"))),
    )
    # A null is no value, but its windows are there.
    counted = F.when(F.col("v__").isNotNull(), F.col("s__.d")).otherwise(0)
    changes = (
        marked.select(*names, "v__", F.explode(steps).alias("s__"))
        .filter("s__ IS NOT NULL")
        .groupBy(*names, F.col("s__.at").alias("at__"))
        .agg(F.sum(F.col("s__.d")).alias("here__"), F.sum(counted).alias("values__"))
    )
    totals = _running(changes, names, "at__", ["here__", "values__"], f"{duration_micros(spec.window.slide) * _CHUNK} microseconds")
    present = totals.filter("here__ > 0")
    # In two steps, so that no array holds more than a chunk of windows.
    wide = interval(f"{duration_micros(spec.window.slide) * _CHUNK} microseconds")
    last = F.col("next__") - slide
    blocks = present.select("*", F.explode(F.sequence("at__", last, wide)).alias("from__"))
    upto = F.least(last, F.col("from__") + wide - slide)
    windows = blocks.select(*names, "values__", F.explode(F.sequence("from__", upto, slide)).alias("start__"))
    window = F.struct(F.col("start__").alias("start"), (F.col("start__") + size).alias("end")).alias("window")
    return windows.select(window, *[F.col(n).alias(k) for n, k in zip(names, keys)], F.col("values__").alias(spec.measure))


def _running(rows: DataFrame, keys: list[str], time: str, values: list[str], chunk: str) -> DataFrame:
    """Running totals of ``values`` per key in order of time, and the time ``next__`` of the next row.

    Rows are unique per (keys, time).  Only one row per chunk of time is ordered over all of it.
    """
    chunked = rows.withColumn("c__", F.window(time, chunk).start)
    inside = W.partitionBy(*keys, "c__").orderBy(time)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = {f"{v}s": F.sum(v).alias(f"{v}s") for v in values}
    whole = chunked.groupBy(*keys, "c__").agg(*sums.values(), F.min(time).alias("first__"))
    across = W.partitionBy(*(keys or [F.lit(0)])).orderBy("c__")
    earlier = across.rowsBetween(W.unboundedPreceding, -1)
    whole = whole.select(
        *keys, "c__", F.lead("first__").over(across).alias("later__"), *[F.sum(s).over(earlier).alias(s) for s in sums]
    )
    scanned = chunked.withColumns({v: F.sum(v).over(upto) for v in values} | {"next__": F.lead(time).over(inside)})
    joined = join_null_safe(scanned, whole, [*keys, "c__"])
    totals = [(F.col(v) + F.coalesce(f"{v}s", F.lit(0))).alias(v) for v in values]
    return joined.select(*keys, time, *totals, F.coalesce("next__", "later__").alias("next__"))


def flatten_window(df: DataFrame, wall_clock: bool = True) -> DataFrame:
    """``window`` struct to ``window_start`` / ``window_end``, by default as zoneless UTC."""
    rest = [c for c in df.columns if c != "window"]
    flat = df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )
    if wall_clock and dict(df.select("window.start").dtypes)["start"] == "timestamp":
        flat = flat.withColumns(
            {"window_start": instant_to_wall("window_start"), "window_end": instant_to_wall("window_end")}
        )
    return flat
