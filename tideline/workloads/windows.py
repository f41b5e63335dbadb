"""Windowed aggregates, filters, ranking and window-to-window questions over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tideline.functions.scalars import to_cents
from tideline.operators.aggregate import aggregate, flatten_window
from tideline.operators.alerts import change_since_previous, fill_absent_windows, metric_alerts
from tideline.operators.metrics import (
    BATCH_ROWS,
    bucket_rows,
    count_by_label,
    delivery_stats,
    histogram,
    histogram_quantile,
    rate,
)
from tideline.operators.ranking import deduplicate, latest, top_per_window
from tideline.operators.sketches import distinct_error, distinct_over, distinct_panes, quantile_panes, quantiles_over, rank_error
from tideline.plans.spec import AggregationSpec, AlertSpec, Condition, WindowSpec
from tideline.session import scratch_path, stored
from tideline.sinks.writers import UpsertTable, archive_columns, batch_sink, file_writer, write_batch
from tideline.sources.decode import decode_json, union_types
from tideline.sources.messages import first_messages, subscribe
from tideline.sources.tables import ordered, read_back
from tideline.workloads.inputs import CLICKSTREAM, event_messages, events
from tideline.workloads.registry import query
from tideline.workloads.sqltext import sliding, tumbling

MINUTE = WindowSpec("tumbling", "1 minute")
HOUR = WindowSpec("tumbling", "1 hour")
FIVE_BY_ONE = WindowSpec("sliding", "5 minutes", "1 minute")
EV = "(SELECT *, epoch_us(ts) AS us, CAST(round(value * 100) AS BIGINT) AS cents FROM events)"


def tumbling_sql(size: str, measures: str, keys: str = "", where: str = "") -> str:
    start, end = tumbling("us", size)
    return (
        f"SELECT {start} AS window_start, {end} AS window_end, {keys}{measures} "
        f"FROM {EV} {where} GROUP BY {keys}window_start, window_end"
    )


def sliding_sql(size: str, slide: str, measures: str, keys: str = "") -> str:
    start, end, series = sliding("us", size, slide)
    return (
        f"SELECT {start} AS window_start, {end} AS window_end, {keys}{measures} "
        f"FROM {EV}, {series} GROUP BY {keys}window_start, window_end"
    )


def _windowed(df: DataFrame, kind: str, window: WindowSpec, **spec) -> DataFrame:
    return flatten_window(aggregate(df, AggregationSpec("q", kind, window, **spec), time="ts"))


def _with_cents(df: DataFrame) -> DataFrame:
    return df.withColumn("cents", to_cents("value"))


# ------------------------------------------------------------------ aggregates


@query("tumbling_count", tumbling_sql("1 hour", "count(*) AS count"))
def tumbling_count(spark, folder):
    return _windowed(events(spark, folder), "count", HOUR)


@query("tumbling_count_grouped", tumbling_sql("1 minute", "count(*) AS count", "event_type, "))
def tumbling_count_grouped(spark, folder):
    return _windowed(events(spark, folder), "count", MINUTE, group_by=("event_type",))


@query("sliding_count", sliding_sql("5 minutes", "1 minute", "count(*) AS count", "event_type, "))
def sliding_count(spark, folder):
    return _windowed(events(spark, folder), "count", FIVE_BY_ONE, group_by=("event_type",))


@query("sliding_sum_cents", sliding_sql("1 day", "1 hour", "CAST(sum(cents) AS BIGINT) AS total", "event_type, "))
def sliding_sum_cents(spark, folder):
    window = WindowSpec("sliding", "1 day", "1 hour")
    return _windowed(_with_cents(events(spark, folder)), "sum", window, field="cents", group_by=("event_type",))


_HUGE = "CASE WHEN event_id % 97 = 0 THEN 9223372036854775807 WHEN event_id % 89 = 0 THEN -9223372036854775807 ELSE cents END"


@query(
    "sliding_try_sum",
    f"""SELECT window_start, window_end, event_type, CASE WHEN s BETWEEN -9223372036854775808 AND 9223372036854775807
               THEN CAST(s AS VARCHAR) END AS total, n AS events
        FROM ({sliding_sql("1 day", "1 hour", f"sum(CAST({_HUGE} AS HUGEINT)) AS s, count(*) AS n", "event_type, ")})""",
)
def sliding_try_sum(spark, folder):
    """Sums of which some are out of range, in a pane or in all panes of a window: null, in whatever way they are added."""
    window = WindowSpec("sliding", "1 day", "1 hour")
    df = _with_cents(events(spark, folder)).withColumn("amount", F.expr(_HUGE.replace("9223372036854775807", "9223372036854775807L")))
    spec = AggregationSpec("q", "sum", window, field="amount", group_by=("event_type",))
    totals = flatten_window(aggregate(df, spec, time="ts", try_sum=True)).withColumn("total", F.col("total").cast("string"))
    counts = _windowed(df, "count", window, group_by=("event_type",)).withColumnRenamed("count", "events")
    return totals.join(counts, ["window_start", "window_end", "event_type"])


@query(
    "sliding_avg",
    sliding_sql("1 hour", "15 minutes", "round(avg(cents), 6) AS average", "user_id, "),
)
def sliding_avg(spark, folder):
    window = WindowSpec("sliding", "1 hour", "15 minutes")
    out = _windowed(_with_cents(events(spark, folder)), "avg", window, field="cents", group_by=("user_id",))
    return out.withColumn("average", F.round("average", 6))


@query(
    "tumbling_sum_cents",
    tumbling_sql("1 hour", "CAST(sum(cents) AS BIGINT) AS total", "", "WHERE event_type = 'purchase'"),
)
def tumbling_sum_cents(spark, folder):
    df = _with_cents(events(spark, folder))
    return _windowed(df, "sum", HOUR, field="cents", where="event_type = 'purchase'")


@query("tumbling_avg", tumbling_sql("1 hour", "round(avg(value), 4) AS average"))
def tumbling_avg(spark, folder):
    out = _windowed(events(spark, folder), "avg", HOUR, field="value")
    return out.withColumn("average", F.round("average", 4))


@query(
    "sliding_count_distinct",
    sliding_sql("5 minutes", "1 minute", "count(DISTINCT user_id) AS unique_count", "event_type, "),
)
def sliding_count_distinct(spark, folder):
    return _windowed(events(spark, folder), "count_distinct", FIVE_BY_ONE, field="user_id", group_by=("event_type",))


@query(
    "sliding_count_distinct_hour",
    sliding_sql("1 hour", "5 minutes", "count(DISTINCT user_id) AS unique_count", "event_type, "),
)
def sliding_count_distinct_hour(spark, folder):
    """Twelve windows to an event, counted from the intervals in which each user is in them."""
    window = WindowSpec("sliding", "1 hour", "5 minutes")
    return _windowed(events(spark, folder), "count_distinct", window, field="user_id", group_by=("event_type",))


@query(
    "tumbling_count_distinct_grouped",
    tumbling_sql("1 hour", "count(DISTINCT user_id) AS unique_count", "event_type, "),
)
def tumbling_count_distinct_grouped(spark, folder):
    return _windowed(events(spark, folder), "count_distinct", HOUR, field="user_id", group_by=("event_type",))


@query(
    "tumbling_count_distinct_approx",
    tumbling_sql("1 hour", "count(DISTINCT user_id) AS exact, true AS within_error", "event_type, "),
)
def tumbling_count_distinct_approx(spark, folder):
    """The estimate beside the exact number: within four times the relative error asked for, or one."""
    spec = AggregationSpec("q", "count_distinct", HOUR, field="user_id", group_by=("event_type",))
    df = events(spark, folder)
    estimate = flatten_window(aggregate(df, spec, time="ts", approximate=0.05)).withColumnRenamed("unique_count", "estimate")
    exact = flatten_window(aggregate(df, spec, time="ts")).withColumnRenamed("unique_count", "exact")
    error = F.abs(F.col("estimate") - F.col("exact"))
    return exact.join(estimate, ["window_start", "window_end", "event_type"]).select(
        "window_start",
        "window_end",
        "event_type",
        "exact",
        (error <= F.greatest(F.lit(1.0), F.lit(4 * 0.05) * F.col("exact"))).alias("within_error"),
    )


# --------------------------------------------------------------------- filters


@query("filter_sql_string", tumbling_sql("1 hour", "count(*) AS count", "user_id, ", "WHERE event_type = 'purchase' AND value > 50"))
def filter_sql_string(spark, folder):
    where = "event_type = 'purchase' AND metrics.value > 50"
    return _windowed(events(spark, folder), "count", HOUR, where=where, group_by=("user_id",))


@query("filter_structured", tumbling_sql("1 hour", "count(*) AS count", "event_type, ", "WHERE value < 20"))
def filter_structured(spark, folder):
    return _windowed(
        events(spark, folder), "count", HOUR, where=Condition("lt", 20, "metrics.value"), group_by=("event_type",)
    )


@query(
    "decode_json_events",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, (epoch_us(ts) // 1000) AS timestamp, CAST(user_id AS VARCHAR) AS user_id,
              props, value, event_type FROM events WHERE event_type = 'purchase'""",
)
def decode_json_events(spark, folder):
    purchase = CLICKSTREAM.event_type("purchase")
    return decode_json(event_messages(events(spark, folder)), purchase, CLICKSTREAM.entity_key).drop("event_time")


@query(
    "union_event_types",
    """SELECT event_type, count(*) AS count, CAST(sum(round(value * 100)) AS BIGINT) AS cents
       FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY event_type""",
)
def union_event_types(spark, folder):
    messages = subscribe(event_messages(events(spark, folder)), ["events.purchase", "events.signup"])
    tables = {
        name: decode_json(messages, CLICKSTREAM.event_type(name), CLICKSTREAM.entity_key)
        for name in ("purchase", "signup")
    }
    return union_types(tables).groupBy("event_type").agg(
        F.count("*").alias("count"), F.sum(to_cents("value")).alias("cents")
    )


@query(
    "dedup_event_id",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events",
)
def dedup_event_id(spark, folder):
    df = events(spark, folder)
    return deduplicate(df.unionByName(df), ["event_id"])


@query(
    "bounded_read",
    """SELECT "offset", topic FROM (SELECT event_id AS "offset", 'events.' || event_type AS topic, ts,
              event_id % 8 AS part FROM events) ORDER BY ts, topic, part, "offset" LIMIT 100""",
)
def bounded_read(spark, folder):
    """The feature is the bound: stop after 100 messages."""
    return first_messages(event_messages(events(spark, folder)), 100).select("offset", "topic")


# ------------------------------------------------------------ between windows


@query(
    "topk_per_window",
    f"""SELECT window_start, k, count, rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY count DESC, k) AS INTEGER) AS rank FROM (
            SELECT {tumbling('us', '1 day')[0]} AS window_start, CAST(props->>'$.k' AS BIGINT) AS k, count(*) AS count
            FROM {EV} GROUP BY ALL)) WHERE rank <= 3""",
)
def topk_per_window(spark, folder):
    df = events(spark, folder).withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    counted = _windowed(df, "count", WindowSpec("tumbling", "1 day"), group_by=("k",))
    return top_per_window(counted, "count", 3, ["k"]).drop("window_end")


@query(
    "window_delta",
    f"""SELECT *, coalesce(lag(total) OVER w, -1) AS previous, coalesce(total - lag(total) OVER w, 0) AS delta FROM (
          {tumbling_sql("1 hour", "CAST(sum(cents) AS BIGINT) AS total", "event_type, ")})
        WINDOW w AS (PARTITION BY event_type ORDER BY window_start)""",
)
def window_delta(spark, folder):
    df = _with_cents(events(spark, folder))
    totals = _windowed(df, "sum", HOUR, field="cents", group_by=("event_type",))
    changes = change_since_previous(totals, ["event_type"], "total")
    return changes.withColumns(
        {"previous": F.coalesce("previous", F.lit(-1)), "delta": F.coalesce("delta", F.lit(0))}
    )


@query(
    "absent_window_fill",
    f"""WITH a AS ({tumbling_sql("1 minute", "count(*) AS count", "event_type, ")}),
             s AS (SELECT event_type, unnest(generate_series(min(window_start), max(window_start), INTERVAL 1 MINUTE)) AS window_start
                   FROM a GROUP BY event_type)
        SELECT s.event_type, s.window_start, s.window_start + INTERVAL 1 MINUTE AS window_end, coalesce(a.count, 0) AS count
        FROM s LEFT JOIN a ON a.event_type = s.event_type AND a.window_start = s.window_start""",
)
def absent_window_fill(spark, folder):
    counted = _windowed(events(spark, folder), "count", MINUTE, group_by=("event_type",))
    return fill_absent_windows(counted, ["event_type"], "count", "1 minute")


# Every group's windows go on to the newest event of all; errors are taken to fall silent half-way.
_SILENT = f"(SELECT * FROM {EV} WHERE event_type <> 'error' OR ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events))"


@query(
    "absent_window_alerts",
    f"""WITH e AS {_SILENT},
             a AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS count FROM e GROUP BY ALL),
             s AS (SELECT event_type, unnest(generate_series(min(window_start), (SELECT max(window_start) FROM a), INTERVAL 1 HOUR)) AS window_start
                   FROM a GROUP BY event_type)
        SELECT s.event_type, 'silence' AS alert, count(*) AS windows, min(s.window_start) AS first_at, max(s.window_start) AS last_at
        FROM s LEFT JOIN a ON a.event_type = s.event_type AND a.window_start = s.window_start
        WHERE coalesce(a.count, 0) < 1 GROUP BY s.event_type""",
)
def absent_window_alerts(spark, folder):
    """Alerts over the filled table, with a group that has no events in the second half."""
    df = events(spark, folder)
    middle = df.agg((F.min("ts") + (F.max("ts") - F.min("ts")) / 2).alias("middle")).first()["middle"]
    heard = df.filter((F.col("event_type") != "error") | (F.col("ts") < F.lit(middle)))
    counted = _windowed(heard, "count", HOUR, group_by=("event_type",))
    newest = counted.agg(F.max("window_start").alias("newest")).first()["newest"]
    filled = fill_absent_windows(counted, ["event_type"], "count", "1 hour", until=F.lit(newest))
    alert = AlertSpec("silence", Condition("less_than", 1), "critical", metric="q")
    spec = AggregationSpec("q", "count", HOUR, group_by=("event_type",))
    hits = metric_alerts(filled, alert, spec)
    return hits.groupBy("event_type", "alert").agg(
        F.count("*").alias("windows"), F.min("window_start").alias("first_at"), F.max("window_start").alias("last_at")
    )


@query("upsert_latest_window", tumbling_sql("1 hour", "count(*) AS count", "event_type, "))
def upsert_latest_window(spark, folder):
    """Update-mode output of four micro-batches in an upsert table, one batch replayed, half folded."""
    arrived = events(spark, folder).withColumn("batch_id", F.col("event_id") % 4)
    keys = ["window_start", "window_end", "event_type"]
    store = UpsertTable(scratch_path(spark, "upsert"), keys)
    for batch_id in range(4):
        # What update mode emits: the windows that this batch touched, with all counted so far.
        touched = _windowed(arrived.filter(F.col("batch_id") == batch_id), "count", HOUR, group_by=("event_type",))
        so_far = _windowed(arrived.filter(F.col("batch_id") <= batch_id), "count", HOUR, group_by=("event_type",))
        emitted = so_far.join(touched.select(*keys), keys, "left_semi")
        store(emitted, batch_id)
        if batch_id == 2:
            store(emitted, batch_id)
            store.fold(spark)
    return store.read(spark)


@query(
    "mapped_sink_counts",
    """SELECT writer, count(*) AS returned, count(*) AS stored FROM
         (SELECT date_trunc('hour', ts) AS h, event_type FROM events GROUP BY ALL), (VALUES ('plain'), ('peeking')) v(writer) GROUP BY writer""",
)
def mapped_sink_counts(spark, folder):
    """The count a mapped sink returns is what it stored, also if its writer looks at the rows first."""
    root = scratch_path(spark, "sinks")
    plain = file_writer(root)

    def peeking(df, table):
        if not df.isEmpty():
            plain(df, table)

    spec = AggregationSpec("q", "count", HOUR, group_by=("event_type",))
    counted = aggregate(events(spark, folder), spec, time="ts")
    mapping = {"window.start": "window_start", "event_type": "event_type", "count": "count"}
    rows = None
    for name, writer in (("plain", plain), ("peeking", peeking)):
        returned = batch_sink(writer, name, mapping)(counted, 0)
        row = spark.read.parquet(f"{root}/{name}").agg(F.count("*").alias("stored"))
        row = row.select(F.lit(name).alias("writer"), F.lit(returned).cast("long").alias("returned"), "stored")
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query(
    "read_back_ordered",
    f"SELECT * FROM ({tumbling_sql('1 hour', 'count(*) AS count', 'event_type, ')}) ORDER BY window_start, event_type LIMIT 10",
)
def read_back_ordered(spark, folder):
    """Write with nested column mapping, then query the sink table with ORDER BY ... LIMIT."""
    root = scratch_path(spark, "read_back")
    spec = AggregationSpec("q", "count", HOUR, group_by=("event_type",))
    mapping = {"window.start": "window_start", "window.end": "window_end", "event_type": "event_type", "count": "count"}
    write_batch(aggregate(events(spark, folder), spec, time="ts"), "hourly", mapping, file_writer(root))
    table = read_back(spark, f"{root}/hourly", "SELECT * FROM {sink} WHERE count >= :least", {"least": 1})
    return ordered(table, "window_start", "event_type", limit=10)


@query(
    "archive_partitioned",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS count, CAST(sum(event_id) AS BIGINT) AS ids
       FROM events WHERE event_type = 'purchase' GROUP BY day""",
)
def archive_partitioned(spark, folder):
    """Raw events kept by date and type; reading one type back touches only its folders."""
    root = scratch_path(spark, "archive")
    # Rebalancing gathers a folder's rows into files of the advisory size and splits big folders.
    kept = archive_columns(events(spark, folder), "ts").hint("rebalance", "event_date", "event_type")
    file_writer(root, partition_by=["event_date", "event_type"])(kept, "raw")
    purchases = spark.read.parquet(f"{root}/raw").filter("event_type = 'purchase'")
    return purchases.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("count"), F.sum("event_id").alias("ids")
    )


# --------------------------------------------------------------------- metrics

_BOUNDS = tuple(float(b) for b in BATCH_ROWS)
_LE = ", ".join(f"({b})" for b in _BOUNDS)


@query(
    "histogram_buckets",
    f"""SELECT event_type, le, count(*) FILTER (WHERE le IS NULL OR value <= le) AS cumulative_count
        FROM events, (SELECT CAST(col0 AS DOUBLE) AS le FROM (VALUES {_LE}, (NULL)) v) GROUP BY event_type, le""",
)
def histogram_buckets(spark, folder):
    hist = histogram(events(spark, folder), "value", _BOUNDS, ["event_type"])
    return bucket_rows(hist, _BOUNDS, ["event_type"])


@query(
    "histogram_p95",
    f"""WITH h AS (SELECT event_type, le, count(*) FILTER (WHERE value <= le) AS n
                   FROM events, (SELECT CAST(col0 AS DOUBLE) AS le FROM (VALUES {_LE}) v) GROUP BY event_type, le),
             c AS (SELECT event_type, count(*) * 0.95::DOUBLE AS r FROM events GROUP BY event_type),
             w AS (SELECT event_type, le, n, lag(le, 1, 0.0) OVER o AS lo, lag(n, 1, 0) OVER o AS below FROM h
                   WINDOW o AS (PARTITION BY event_type ORDER BY le)),
             p AS (SELECT event_type, min(le) AS le FROM h JOIN c USING (event_type) WHERE n >= r GROUP BY event_type)
        SELECT c.event_type, round(CASE WHEN p.le IS NULL THEN {_BOUNDS[-1]}
                 ELSE w.lo + (w.le - w.lo) * (c.r - w.below) / (w.n - w.below) END, 6) AS p95
        FROM c LEFT JOIN p USING (event_type) LEFT JOIN w ON w.event_type = c.event_type AND w.le = p.le""",
)
def histogram_p95(spark, folder):
    hist = histogram(events(spark, folder), "value", _BOUNDS, ["event_type"])
    return hist.select("event_type", F.round(histogram_quantile(0.95, _BOUNDS), 6).alias("p95"))


@query(
    "approx_p95",
    """SELECT event_type, count(*) AS rows, true AS within_error FROM events WHERE value IS NOT NULL GROUP BY event_type""",
)
def approx_p95(spark, folder):
    """The estimate's rank is within the stated error (1/1000 of the rows) of the 95th percentile's."""
    df = events(spark, folder).filter("value IS NOT NULL")
    estimate = df.groupBy("event_type").agg(F.approx_percentile("value", 0.95, 1000).alias("p95"))
    ranks = df.join(estimate, "event_type").groupBy("event_type").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("value") < F.col("p95")).alias("below"),
        F.count_if(F.col("value") <= F.col("p95")).alias("upto"),
    )
    slack = F.col("rows") / 1000 + 1
    fits = (F.col("below") <= F.col("rows") * 0.95 + slack) & (F.col("upto") >= F.col("rows") * 0.95 - slack)
    return ranks.select("event_type", "rows", fits.alias("within_error"))


@query("event_rate", tumbling_sql("1 minute", "count(*) AS count, count(*) / 60.0::DOUBLE AS per_second", "event_type, "))
def event_rate(spark, folder):
    return flatten_window(rate(events(spark, folder), "ts", "1 minute", ["event_type"]))


@query(
    "counter_by_label",
    """SELECT event_type, status, count(*) AS count, CAST(sum(cents) AS BIGINT) AS total FROM (
         SELECT event_type, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
                CAST(round(value * 100) AS BIGINT) AS cents FROM events) GROUP BY event_type, status""",
)
def counter_by_label(spark, folder):
    return count_by_label(_with_status(_with_cents(events(spark, folder))), ["event_type", "status"], "cents")


@query(
    "delivery_stats",
    """SELECT count(*) FILTER (WHERE event_type <> 'error') AS sent, count(*) FILTER (WHERE event_type = 'error') AS errors,
              count(*) FILTER (WHERE event_id % 5 > 0) AS retried FROM events""",
)
def delivery_stats_query(spark, folder):
    df = _with_status(events(spark, folder)).withColumn("retries", F.col("event_id") % 5)
    return delivery_stats(df, "status", "retries")


def _with_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.when(F.col("event_type") == "error", "error").otherwise("success"))


# ------------------------------------------------------------------ sketches

SKETCH_WINDOWS = ("5 minutes", "1 hour", "1 day")


def sketch_sql(where: str = "") -> str:
    """Exact distinct users of every window of the three sizes, and that the estimate is near them."""
    parts = [
        f"SELECT '{size}' AS size, * FROM ({tumbling_sql(size, 'count(DISTINCT user_id) AS exact, true AS within_error', 'event_type, ')}) {where}"
        for size in SKETCH_WINDOWS
    ]
    return " UNION ALL ".join(parts)


def beside_exact(df: DataFrame, panes: DataFrame, pane: str) -> DataFrame:
    """Estimates from the panes beside the exact numbers, for windows of three sizes."""
    found = None
    for size in SKETCH_WINDOWS:
        window = WindowSpec("tumbling", size)
        estimate = flatten_window(distinct_over(panes, window, ["event_type"], pane, "estimate"), wall_clock=True)
        exact = _windowed(df, "count_distinct", window, field="user_id", group_by=("event_type",))
        joined = exact.withColumnRenamed("unique_count", "exact").join(estimate, ["window_start", "window_end", "event_type"])
        # Four standard deviations, or one.
        near = F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), 4 * distinct_error() * F.col("exact"))
        own = joined.select(F.lit(size).alias("size"), "window_start", "window_end", "event_type", "exact", near.alias("within_error"))
        found = own if found is None else found.unionByName(own)
    return found


@query("sketch_distinct_windows", sketch_sql())
def sketch_distinct_windows(spark, folder):
    """One stored table of 5-minute sketches answers windows of 5 minutes, an hour and a day."""
    df = events(spark, folder)
    panes = stored(distinct_panes(df, "user_id", "5 minutes", ["event_type"], "ts"), "distinct-panes")
    return beside_exact(df, panes, "5 minutes")


@query(
    "sketch_quantiles",
    """SELECT event_type, date_trunc('day', ts) AS day, q, count(*) AS rows, true AS within_error
       FROM events, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) v(q) WHERE value IS NOT NULL GROUP BY ALL""",
)
def sketch_quantiles(spark, folder):
    """Quantiles per type and day from sketches per minute, against the exact ranks of the answers."""
    wanted = [0.5, 0.95, 0.99]
    df = events(spark, folder).filter("value IS NOT NULL")
    panes = stored(quantile_panes(df, "value", "1 minute", ["event_type"], "ts"), "quantile-panes")
    days = flatten_window(quantiles_over(panes, wanted, ["event_type"], WindowSpec("tumbling", "1 day"), "1 minute"))
    asked = F.arrays_zip(F.array(*[F.lit(q) for q in wanted]).alias("q"), F.col("quantiles").alias("x"))
    answers = days.select("event_type", F.col("window_start").alias("day"), F.explode(asked).alias("a"))
    answers = answers.select("event_type", "day", F.col("a.q").alias("q"), F.col("a.x").alias("x"))
    ranks = df.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz")).join(answers, ["event_type", "day"])
    ranks = ranks.groupBy("event_type", "day", "q").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("value") < F.col("x")).alias("below"),
        F.count_if(F.col("value") <= F.col("x")).alias("upto"),
    )
    slack = F.col("rows") * (3 * rank_error()) + 1
    near = (F.col("below") <= F.col("rows") * F.col("q") + slack) & (F.col("upto") >= F.col("rows") * F.col("q") - slack)
    return ranks.select("event_type", "day", "q", "rows", near.alias("within_error"))
