"""Streaming twins: the same transforms over a file stream, run until the input is used up.

Inputs are stored as ``BATCHES`` folders in order of event time, of equally many files each, and
read one folder per micro-batch, so state, upserts and watermarks carry over from batch to batch.
Rows without a time are in the first.  Results go to tables under the shared folder and are read
back.  Append-mode twins hold only
what the final watermark (greatest event time minus the delay) has closed, and their SQL
says so; update-mode twins are reduced to the newest row per window and hold everything.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import to_cents
from tideline.functions.times import instant_to_wall
from tideline.operators import cdc, dlq
from tideline.operators.aggregate import aggregate, flatten_window
from tideline.operators.alerts import event_alerts, metric_alerts
from tideline.operators.joins import enrich, without_follow_up_stream
from tideline.operators.ranking import deduplicate, latest, top_per_window
from tideline.operators.sessions import sessionize_stream
from tideline.operators.sketches import distinct_panes
from tideline.plans.domains import ECOMMERCE
from tideline.plans.jobs import AggregationJob
from tideline.plans.spec import AggregationSpec, AlertSpec, Condition, WindowSpec
from tideline.session import scratch_path
from tideline.sinks.writers import UpsertTable, archive_columns, batch_folder, fan_out
from tideline.sources.tables import table, table_stream
from tideline.streaming.absent import AbsentWindows
from tideline.streaming.progress import ProgressLog, observe_quality
from tideline.streaming.queries import StreamRunner
from tideline.streaming.routing import ChangeTable, CooldownSink, DeadLetterSplit, LateRouter
from tideline.workloads.behaviour import ALERT_COOLDOWN_SQL
from tideline.workloads.changes import ERROR_SQL, ORDER_ROW, ORDER_STATE_SQL, TOPIC_SQL
from tideline.workloads.inputs import CLICKSTREAM, change_log, domain_messages, flawed_messages
from tideline.workloads.registry import query
from tideline.workloads.domains import spec_sql
from tideline.workloads.windows import FIVE_BY_ONE, HOUR, beside_exact, sketch_sql, sliding_sql, tumbling_sql

DELAY = "10 minutes"
_CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


def _run(spark: SparkSession, name: str, start: Callable[[StreamRunner, str], None]) -> str:
    """Run one stream over all available input; returns the output path."""
    base = scratch_path(spark, name)
    runner = StreamRunner(spark, f"{base}/checkpoint", trigger=None)
    start(runner, f"{base}/out")
    runner.await_all()
    return f"{base}/out"


BATCHES = 5
#: Rows of one stored file, about.
FILE_ROWS = 500_000
_stored: dict[tuple, tuple[str, int]] = {}


def _version(rows: DataFrame) -> int | None:
    """One number for the files of a stored table: other files, sizes or times give another."""
    files = rows.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return files.agg(F.bit_xor(F.xxhash64(*files.columns))).first()[0]


def _in_batches(spark: SparkSession, name: str, given: DataFrame, rows: DataFrame, batch: Column, count: int = BATCHES) -> DataFrame:
    """A stream over rows made from the stored table ``given``, one batch per micro-batch in order.

    A null batch is the first, one out of range the nearest.  A micro-batch takes a number of
    files, so every batch has equally many; missing ones are empty.  Rows are stored once per
    session as long as the files of ``given`` stay as they are.
    """
    key = (spark.sparkContext.applicationId, name, count, _version(given))
    if key not in _stored:
        path = scratch_path(spark, f"batches-{name}")
        number = F.greatest(F.lit(0), F.least(F.lit(count - 1), F.coalesce(batch, F.lit(0))))
        numbered = rows.withColumn("batch__", number)
        most = numbered.groupBy("batch__").count().agg(F.max("count")).first()[0] or 0
        files = max(1, -(-most // FILE_ROWS))
        for own in range(count):
            target = f"{path}/{name}-{own}.parquet"
            part = numbered.filter(F.col("batch__") == own).drop("batch__")
            part.repartition(files).write.parquet(target)
            for _ in range(files - len(spark.read.schema(part.schema).parquet(target).inputFiles())):
                part.limit(0).coalesce(1).write.mode("append").parquet(target)
        _stored[key] = path, files
    path, files = _stored[key]
    return table_stream(spark, path, name, max_files=files)


def _time_batch(df: DataFrame, time: str) -> Column:
    """Equal stretches of event time, 0 to ``BATCHES - 1``; null without a time."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    low, high = df.agg(F.min(micros), F.max(micros)).first()
    if low is None:
        return F.lit(0)
    return F.floor((micros - F.lit(low)) * BATCHES / F.lit(high - low + 1)).cast("int")


def _raw_events(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "events")
    return _in_batches(spark, "events", df, df, _time_batch(df, "ts"))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return _raw_events(spark, folder).withWatermark("ts", DELAY)


def _spec(kind: str, window, **fields) -> AggregationSpec:
    return AggregationSpec("q", kind, window, **fields)


def _append(spark: SparkSession, name: str, result: DataFrame) -> DataFrame:
    schema = result.schema
    out = _run(spark, name, lambda runner, path: runner.files(result, path, name))
    return spark.read.schema(schema).parquet(out)


def _upsert(spark: SparkSession, name: str, result: DataFrame, keys: list[str]) -> DataFrame:
    def start(runner: StreamRunner, path: str) -> None:
        runner.foreach_batch(result, UpsertTable(path, keys), name, "update")

    return UpsertTable(_run(spark, name, start), keys).read(spark)


@query(
    "stream_tumbling_count",
    f"SELECT * FROM ({tumbling_sql('1 hour', 'count(*) AS count', 'event_type, ')}) WHERE window_end <= {_CLOSED}",
)
def stream_tumbling_count(spark, folder):
    spec = _spec("count", HOUR, group_by=("event_type",))
    return _append(spark, "tumbling_count", flatten_window(aggregate(_events(spark, folder), spec, time="ts")))


@query("stream_sliding_count", sliding_sql("5 minutes", "1 minute", "count(*) AS count", "event_type, "))
def stream_sliding_count(spark, folder):
    spec = _spec("count", FIVE_BY_ONE, group_by=("event_type",))
    result = flatten_window(aggregate(_events(spark, folder), spec, time="ts", output_mode="update"))
    return _upsert(spark, "sliding_count", result, ["window_start", "window_end", "event_type"])


_DISTINCT = sliding_sql("5 minutes", "1 minute", "count(DISTINCT user_id) AS unique_count", "event_type, ")


@query("stream_distinct_append", f"SELECT * FROM ({_DISTINCT}) WHERE window_end <= {_CLOSED}")
def stream_distinct_append(spark, folder):
    spec = _spec("count_distinct", FIVE_BY_ONE, field="user_id", group_by=("event_type",))
    result = flatten_window(aggregate(_events(spark, folder), spec, time="ts", output_mode="append"))
    return _append(spark, "distinct_append", result)


@query("stream_distinct_update", _DISTINCT)
def stream_distinct_update(spark, folder):
    spec = _spec("count_distinct", FIVE_BY_ONE, field="user_id", group_by=("event_type",))
    result = flatten_window(aggregate(_events(spark, folder), spec, time="ts", output_mode="update"))
    return _upsert(spark, "distinct_update", result, ["window_start", "window_end", "event_type"])


@query(
    "stream_sessions",
    f"""SELECT * FROM (
         SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events FROM (
           SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (
             SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
                            THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s)
       WHERE session_end <= date_trunc('millisecond', {_CLOSED})""",
)
def stream_sessions(spark, folder):
    result = sessionize_stream(_events(spark, folder), ["user_id"], "ts", "30 minutes")
    walls = {name: instant_to_wall(name) for name in ("session_start", "session_end")}
    return _append(spark, "sessions", result.withColumns(walls))


@query("stream_dedup", "SELECT event_id, user_id, event_type, value FROM events")
def stream_dedup(spark, folder):
    twice = _raw_events(spark, folder).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    result = deduplicate(twice.withWatermark("ts", DELAY), ["event_id"])
    return _append(spark, "dedup", result.select("event_id", "user_id", "event_type", "value"))


@query(
    "stream_abandoned_carts",
    """SELECT event_id, user_id, ts FROM events v
       WHERE event_type = 'view' AND ts < (
           SELECT least(max(ts) FILTER (WHERE event_type = 'view'), max(ts) FILTER (WHERE event_type = 'purchase')) FROM events
         ) - INTERVAL 10 MINUTE - INTERVAL 12 HOUR AND NOT EXISTS (
         SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = v.user_id
           AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 12 HOUR)""",
)
def stream_abandoned_carts(spark, folder):
    """What the final watermark, the older of both sides', has decided: rows 12 hours before it."""
    df = _raw_events(spark, folder).select("event_id", "user_id", "ts", "event_type")
    views = df.filter("event_type = 'view'").drop("event_type")
    purchases = df.filter("event_type = 'purchase'")
    result = without_follow_up_stream(views, purchases, "user_id", "ts", "12 hours", DELAY)
    return _append(spark, "abandoned", result.withColumn("ts", instant_to_wall("ts")))


@query("stream_alert_cooldown", f"SELECT alert, alert_time FROM ({ALERT_COOLDOWN_SQL})")
def stream_alert_cooldown(spark, folder):
    df = _raw_events(spark, folder)
    hits = [event_alerts(df, CLICKSTREAM.alert(name), "user_id", time="ts") for name in ("large_purchase", "error_seen")]
    rows = hits[0].unionByName(hits[1]).select("alert", instant_to_wall("alert_time").alias("alert_time"), "event_id")

    def start(runner: StreamRunner, path: str) -> None:
        runner.foreach_batch(rows, CooldownSink(path, "6 hours", ["event_id"]), "cooldown", "append")

    fired = CooldownSink(_run(spark, "cooldown", start), "6 hours", ["event_id"]).read(spark)
    return fired.select("alert", "alert_time")


@query("stream_cdc_state", ORDER_STATE_SQL)
def stream_cdc_state(spark, folder):
    """The state table takes the changes of every batch into the buckets of their keys."""

    def start(runner: StreamRunner, path: str) -> None:
        router = cdc.ChangeRouter().add_handler("orders", ChangeTable(path, ORDER_ROW, ["id"]))
        runner.foreach_batch(changes, router, "cdc_state", "append")

    # A batch per kind of change: inserts, updates, deletes, tombstones.
    orders = table(spark, folder, "orders")
    kind = (F.col("offset") % 10 - 1).cast("int")
    changes = _in_batches(spark, "order-changes", orders, change_log(orders), kind, 4)
    return ChangeTable(_run(spark, "cdc_state", start), ORDER_ROW, ["id"]).read(spark)


@query(
    "stream_dlq_split",
    f"""SELECT {TOPIC_SQL} AS original_topic, {ERROR_SQL} AS error_type, count(*) AS failures, 0 AS max_retry_count
        FROM events WHERE ({ERROR_SQL}) IS NOT NULL GROUP BY ALL""",
)
def stream_dlq_split(spark, folder):
    def start(runner: StreamRunner, path: str) -> None:
        split = DeadLetterSplit(CLICKSTREAM, batch_folder(f"{path}/good"), batch_folder(f"{path}/bad"))
        runner.foreach_batch(flawed_messages(_raw_events(spark, folder)), split, "dlq_split", "append")

    return dlq.report(spark.read.parquet(_run(spark, "dlq_split", start) + "/bad"))


@query(
    "stream_enrich",
    """SELECT n_name, count(*) AS orders, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS cents
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def stream_enrich(spark, folder):
    orders = table_stream(spark, folder, "orders").select("o_custkey", to_cents("o_totalprice").alias("cents"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    named = enrich(customer, nation, customer.c_nationkey == nation.n_nationkey)
    joined = enrich(orders, named, orders.o_custkey == named.c_custkey).select("n_name", "cents")
    rows = _append(spark, "enrich", joined)
    return rows.groupBy("n_name").agg(F.count("*").alias("orders"), F.sum("cents").alias("cents"))


@query(
    "stream_archive",
    "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS count FROM events GROUP BY day, event_type",
)
def stream_archive(spark, folder):
    """Raw events by date and type, written by the file sink."""
    kept = archive_columns(_raw_events(spark, folder).withColumn("at", instant_to_wall("ts")), "at").drop("at")

    def start(runner: StreamRunner, path: str) -> None:
        runner.files(kept, path, "archive", ["event_date", "event_type"])

    stored = spark.read.parquet(_run(spark, "archive", start))
    return stored.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count("*").alias("count")
    )


@query("stream_progress", "SELECT 'progress' AS query, count(*) AS rows FROM events")
def stream_progress(spark, folder):
    """Rows per query as the progress table has them."""
    log = ProgressLog(spark, scratch_path(spark, "progress_log"))
    spark.streams.addListener(log)
    try:
        out = _events(spark, folder).select("event_id")
        _run(spark, "progress", lambda runner, path: runner.files(out, path, "progress"))
        log.await_end("progress")
    finally:
        spark.streams.removeListener(log)
    mine = log.table().filter("query = 'progress' AND rows IS NOT NULL")
    return mine.groupBy("query").agg(F.sum("rows").alias("rows"))


@query(
    "stream_topk",
    f"""SELECT window_start, user_id, count, rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY count DESC, user_id) AS INTEGER) AS rank FROM (
            {tumbling_sql('1 day', 'count(*) AS count', 'user_id, ')})) WHERE rank <= 3""",
)
def stream_topk(spark, folder):
    """Top users per day over update-mode counts, ranked when the table is read."""
    spec = _spec("count", WindowSpec("tumbling", "1 day"), group_by=("user_id",))
    counts = flatten_window(aggregate(_events(spark, folder), spec, time="ts", output_mode="update"))
    stored = _upsert(spark, "topk", counts, ["window_start", "window_end", "user_id"])
    return top_per_window(stored, "count", 3, ["user_id"]).drop("window_end")


@query("stream_spec_events_per_minute", spec_sql("events_per_minute"))
def stream_spec_events_per_minute(spark, folder):
    """A declared aggregation by name, end to end, fanned out to two tables."""
    job = AggregationJob(ECOMMERCE, watermark=DELAY, output_mode="update")
    result = flatten_window(job.result(domain_messages(_raw_events(spark, folder), ECOMMERCE), "events_per_minute"))
    keys = ["window_start", "window_end", "device_type"]

    def start(runner: StreamRunner, path: str) -> None:
        both = fan_out(UpsertTable(f"{path}/windows", keys), batch_folder(f"{path}/log"))
        runner.foreach_batch(result, both, "events_per_minute", "update")

    return UpsertTable(_run(spark, "events_per_minute", start) + "/windows", keys).read(spark)


_ARRIVED = f"(event_id + event_id * 7919 % 97) * {BATCHES} // ((SELECT max(event_id) FROM events) + 97)"


@query(
    "stream_late_split",
    f"""WITH a AS (SELECT event_id, ts, {_ARRIVED} AS batch FROM events),
             m AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                          - INTERVAL 10 MINUTE AS watermark FROM a GROUP BY batch)
        SELECT CASE WHEN coalesce(ts < watermark, false) THEN 'late' ELSE 'on time' END AS went, count(*) AS events,
               CAST(sum(event_id) AS BIGINT) AS ids FROM a JOIN m USING (batch) GROUP BY went""",
)
def stream_late_split(spark, folder):
    """Late rows of every batch to a table of their own; arrival is event order with jitter."""
    df = table(spark, folder, "events")
    last = df.agg(F.coalesce(F.max("event_id"), F.lit(0))).first()[0] + 97
    arrived = F.expr(f"CAST((event_id + event_id * 7919 % 97) * {BATCHES} div {last} AS INT)")
    # As in the SQL, an event without a number arrives in no batch.
    stream = _in_batches(spark, "arrivals", df, df.filter("event_id IS NOT NULL"), arrived)

    def start(runner: StreamRunner, path: str) -> None:
        router = LateRouter(f"{path}/state", "ts", DELAY, batch_folder(f"{path}/on_time"), batch_folder(f"{path}/late"))
        runner.foreach_batch(stream, router, "late_split", "append")

    path = _run(spark, "late_split", start)
    rows = None
    for went, part in (("on time", "on_time"), ("late", "late")):
        own = spark.read.schema("event_id long").parquet(f"{path}/{part}").select(F.lit(went).alias("went"), "event_id")
        rows = own if rows is None else rows.unionByName(own)
    return rows.groupBy("went").agg(F.count("*").alias("events"), F.sum("event_id").alias("ids"))


@query("stream_sketch_distinct", sketch_sql())
def stream_sketch_distinct(spark, folder):
    """Sketches that every micro-batch adds for itself, merged when read: a stream without state."""
    stream = _raw_events(spark, folder)

    def start(runner: StreamRunner, path: str) -> None:
        add = batch_folder(path)

        def handle(batch: DataFrame, batch_id: int) -> None:
            add(distinct_panes(batch, "user_id", "5 minutes", ["event_type"], "ts"), batch_id)

        runner.foreach_batch(stream, handle, "sketches", "append")

    panes = spark.read.parquet(_run(spark, "sketches", start)).drop("batch_id")
    return beside_exact(table(spark, folder, "events"), panes, "5 minutes")


# Hours of the events that the final watermark has closed, and the newest of them.
_SILENT_HOURS = f"""
    h AS (SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS count FROM events
          WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_CLOSED} GROUP BY ALL),
    g AS (SELECT event_type, unnest(generate_series(min(window_start), (SELECT max(window_start) FROM h), INTERVAL 1 HOUR)) AS window_start
          FROM h GROUP BY event_type)"""


@query(
    "stream_absent_alerts",
    f"""WITH {_SILENT_HOURS} SELECT 'quiet' AS alert, g.event_type, g.window_start, coalesce(h.count, 0) AS count
        FROM g LEFT JOIN h ON h.event_type = g.event_type AND h.window_start = g.window_start WHERE coalesce(h.count, 0) < 2""",
)
def stream_absent_alerts(spark, folder):
    """Alerts on hours with fewer than two events of a type, none included; the third of five batches is empty."""
    df = table(spark, folder, "events")
    of_four = F.floor(_time_batch(df, "ts") * 4 / F.lit(BATCHES)).cast("int")
    stream = _in_batches(spark, "gaps", df, df, F.when(of_four >= 2, of_four + 1).otherwise(of_four))
    spec = _spec("count", HOUR, group_by=("event_type",))
    hours = flatten_window(aggregate(stream.withWatermark("ts", DELAY), spec, time="ts"))
    sink = None

    def start(runner: StreamRunner, path: str) -> None:
        nonlocal sink
        sink = AbsentWindows(path, ["event_type"], "count", "1 hour", silent_for="1000 days")
        runner.foreach_batch(hours, sink, "absent", "append")

    _run(spark, "absent", start)
    alert = AlertSpec("quiet", Condition("less_than", 2), "warning", metric="hourly")
    found = metric_alerts(sink.read(spark), alert, _spec("count", HOUR))
    return found.select("alert", "event_type", "window_start", "count")


@query(
    "stream_quality",
    """SELECT count(*) AS rows_in, count(*) FILTER (WHERE event_type = 'error') AS rows_bad,
              date_trunc('second', max(ts)) AS max_event_time FROM events""",
)
def stream_quality(spark, folder):
    """Rows in, bad rows and newest event time (in seconds), as the progress of every micro-batch has them."""
    query = None

    def start(runner: StreamRunner, path: str) -> None:
        nonlocal query
        watched = observe_quality(_raw_events(spark, folder), "ts", F.col("event_type") == "error")
        query = runner.files(watched.select("event_id"), path, "quality")

    _run(spark, "quality", start)
    # One row per micro-batch.
    seen = [p.observedMetrics["quality"] for p in query.recentProgress if p.numInputRows]
    rows = spark.createDataFrame([(r.rows_in, r.rows_bad, str(r.max_event_time)) for r in seen], "rows_in long, rows_bad long, newest string")
    newest = F.max(F.col("newest").cast("timestamp")).alias("newest")
    whole = rows.agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_bad").alias("rows_bad"), newest)
    return whole.select("rows_in", "rows_bad", instant_to_wall("newest").alias("max_event_time"))
