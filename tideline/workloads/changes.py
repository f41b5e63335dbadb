"""Change-data and dead-letter queries."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import to_cents
from tideline.functions.times import wall_millis
from tideline.operators import cdc, dlq
from tideline.operators.aggregate import flatten_window
from tideline.plans.jobs import AggregationJob
from tideline.plans.spec import AggregationSpec, WindowSpec
from tideline.session import scratch_path
from tideline.sinks.writers import batch_folder, dead_letter_writer, file_writer, publish
from tideline.sources.decode import checked, decode_json, decode_types
from tideline.sources.messages import dead_letter_files, subscribe
from tideline.sources.tables import table
from tideline.workloads.inputs import CLICKSTREAM, change_log, customer_log, event_messages, events, flawed_messages
from tideline.workloads.registry import query

ORDER_ROW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("amount_cents", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)
CUSTOMER_ROW = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("email", T.StringType())]
)

_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
# One row per change message of the order log.
_LOG = f"""(
    SELECT o_orderkey AS id, o_custkey AS customer_id, {_CENTS} AS cents, (epoch_us(o_orderdate) // 1000) AS at_ms, seq, op, op_name,
           o_orderkey * 10 + seq AS lsn
    FROM orders, (VALUES (1, 'c', 'INSERT'), (2, 'u', 'UPDATE'), (3, 'd', 'DELETE'), (4, 'd', 'TOMBSTONE')) v(seq, op, op_name)
    WHERE seq = 1 OR (seq = 2 AND o_orderkey % 3 = 0) OR (seq >= 3 AND o_orderkey % 7 = 0))"""


@query(
    "cdc_parse",
    f"""SELECT op, op_name, 'public' AS "schema", 'orders' AS "table",
               CASE WHEN seq = 4 THEN -1 ELSE id END AS id,
               CASE WHEN seq = 4 THEN NULL WHEN seq = 2 OR (seq = 3 AND id % 3 = 0) THEN 'completed' ELSE 'pending' END AS status,
               seq IN (2, 3) AS has_before, seq IN (1, 2) AS has_after,
               CASE WHEN seq < 4 THEN at_ms ELSE -1 END AS ts_ms, CASE WHEN seq < 4 THEN lsn ELSE -1 END AS lsn,
               CASE WHEN seq < 4 THEN 'shop' END AS db, lsn AS "offset" FROM {_LOG}""",
)
def cdc_parse(spark, folder):
    changes = cdc.parse_changes(change_log(table(spark, folder, "orders")), ORDER_ROW)
    return changes.select(
        "op",
        "op_name",
        "schema",
        "table",
        F.coalesce("data.id", F.lit(-1)).alias("id"),
        "data.status",
        F.col("before").isNotNull().alias("has_before"),
        F.col("after").isNotNull().alias("has_after"),
        F.coalesce("ts_ms", F.lit(-1)).alias("ts_ms"),
        F.coalesce("source.lsn", F.lit(-1)).alias("lsn"),
        "source.db",
        "offset",
    )


ORDER_STATE_SQL = f"""SELECT o_orderkey AS id, o_custkey AS customer_id, {_CENTS} AS amount_cents,
               CASE WHEN o_orderkey % 3 = 0 THEN 'completed' ELSE 'pending' END AS status,
               o_orderkey * 10 + CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS lsn
        FROM orders WHERE o_orderkey % 7 <> 0"""


@query("cdc_current_state", ORDER_STATE_SQL)
def cdc_current_state(spark, folder):
    changes = cdc.parse_changes(change_log(table(spark, folder, "orders")), ORDER_ROW)
    return cdc.current_state(changes, ORDER_ROW, ["id"])


@query("cdc_op_stats", f"""SELECT 'orders' AS "table", op_name, count(*) AS count FROM {_LOG} GROUP BY op_name""")
def cdc_op_stats(spark, folder):
    return cdc.operation_counts(cdc.parse_changes(change_log(table(spark, folder, "orders"))))


@query("cdc_changed_columns", f"SELECT id, 'status' AS changed FROM {_LOG} WHERE op = 'u'")
def cdc_changed_columns(spark, folder):
    changed = cdc.changed_columns(cdc.parse_changes(change_log(table(spark, folder, "orders"))))
    return changed.select(
        F.get_json_object("after", "$.id").cast("bigint").alias("id"), F.array_join("changed_columns", ",").alias("changed")
    )


@query(
    "cdc_audit",
    f"""SELECT CASE WHEN seq < 4 THEN at_ms ELSE -1 END AS changed_ms, op, op_name,
               CASE WHEN seq < 4 THEN lsn ELSE -1 END AS lsn, CASE WHEN seq < 4 THEN id ELSE -1 END AS tx_id, 'cdc.public.orders' AS topic, lsn AS "offset" FROM {_LOG}""",
)
def cdc_audit(spark, folder):
    rows = cdc.audit_rows(cdc.parse_changes(change_log(table(spark, folder, "orders"))))
    known = {"changed_ms": F.unix_millis("changed_at"), "lsn": F.col("lsn"), "tx_id": F.col("tx_id")}
    filled = [F.coalesce(column, F.lit(-1)).alias(name) for name, column in known.items()]
    return rows.select(*filled, "op", "op_name", "topic", "offset")


@query(
    "cdc_customer_orders",
    f"""SELECT c_custkey AS customer_id, c_name || CASE WHEN c_custkey % 5 = 0 THEN ' (new)' ELSE '' END AS name,
               count(*) AS orders, CAST(sum({_CENTS}) AS BIGINT) AS amount_cents
        FROM customer JOIN orders ON o_custkey = c_custkey AND o_orderkey % 7 <> 0 GROUP BY ALL""",
)
def cdc_customer_orders(spark, folder):
    log = change_log(table(spark, folder, "orders")).unionByName(customer_log(table(spark, folder, "customer")))

    def state(topic: str, row: T.StructType) -> DataFrame:
        return cdc.current_state(cdc.parse_changes(subscribe(log, [topic]), row), row, ["id"])

    orders, customers = state("cdc.public.orders", ORDER_ROW), state("cdc.public.customers", CUSTOMER_ROW)
    # One row per customer before the join, so a busy customer does not skew it.
    per_customer = orders.groupBy("customer_id").agg(
        F.count("*").alias("orders"), F.sum("amount_cents").alias("amount_cents")
    )
    return per_customer.join(customers, per_customer.customer_id == customers.id).select(
        "customer_id", "name", "orders", "amount_cents"
    )


# ---------------------------------------------------------------- dead letters

ERROR_SQL = """CASE WHEN event_id % 89 = 0 THEN 'UnknownEventType' WHEN event_id % 97 = 0 THEN 'CorruptRecord'
                 WHEN event_id % 83 = 0 THEN 'MissingField' END"""
TOPIC_SQL = "CASE WHEN event_id % 89 = 0 THEN 'events.mystery' ELSE 'events.' || event_type END"

# A letter without an id of its own is named after its message: topic, partition, offset.
LETTER_ID_SQL = f"'dlq-' || ({TOPIC_SQL}) || '-' || event_id % 8 || '-' || event_id"


def _letters(spark, folder):
    """Dead letters of the flawed messages; failed at the message time, retried event id mod 5 times."""
    _, bad = dlq.split(checked(flawed_messages(events(spark, folder)), CLICKSTREAM))
    return dlq.dead_letters(
        bad, failed_at=F.unix_millis("timestamp"), retry_count=(F.col("offset") % 5).cast("int")
    )


@query(
    "dlq_split",
    f"""SELECT original_topic, error_type, CASE error_type WHEN 'UnknownEventType' THEN 'Unknown event type: mystery'
               WHEN 'CorruptRecord' THEN 'Payload is not a JSON object' ELSE 'Missing required fields: user_id' END AS error_message,
               ms AS timestamp, retries AS retry_count, 3 AS max_retries,
               CASE WHEN event_id % 97 = 0 THEN ({LETTER_ID_SQL}) ELSE CAST(event_id AS VARCHAR) END AS event_id
        FROM (SELECT event_id, event_type, {TOPIC_SQL} AS original_topic, {ERROR_SQL} AS error_type, (epoch_us(ts) // 1000) AS ms,
                     CAST(event_id % 5 AS INTEGER) AS retries FROM events) WHERE error_type IS NOT NULL""",
)
def dlq_split(spark, folder):
    return _letters(spark, folder).drop("original_event")


@query(
    "dlq_good_rows",
    f"SELECT event_type, count(*) AS count FROM events WHERE ({ERROR_SQL}) IS NULL GROUP BY event_type",
)
def dlq_good_rows(spark, folder):
    good, _ = dlq.split(checked(flawed_messages(events(spark, folder)), CLICKSTREAM))
    return good.groupBy("event_type").agg(F.count("*").alias("count"))


@query(
    "dlq_retry_split",
    f"""SELECT original_topic, can_retry, count(*) AS letters, CAST(sum(next_retry) AS BIGINT) AS next_retries FROM (
          SELECT {TOPIC_SQL} AS original_topic, event_id % 5 < 3 AS can_retry,
                 CASE WHEN event_id % 5 < 3 THEN event_id % 5 + 1 ELSE event_id % 5 END AS next_retry
          FROM events WHERE ({ERROR_SQL}) IS NOT NULL) GROUP BY original_topic, can_retry""",
)
def dlq_retry_split(spark, folder):
    again, archive = dlq.replay(_letters(spark, folder))
    both = again.select(F.col("topic").alias("original_topic"), F.lit(True).alias("can_retry"), "retry_count").unionByName(
        archive.select("original_topic", F.lit(False).alias("can_retry"), "retry_count")
    )
    return both.groupBy("original_topic", "can_retry").agg(
        F.count("*").alias("letters"), F.sum("retry_count").alias("next_retries")
    )


@query(
    "dlq_report",
    f"""SELECT {TOPIC_SQL} AS original_topic, {ERROR_SQL} AS error_type, count(*) AS failures,
               CAST(max(event_id % 5) AS INTEGER) AS max_retry_count
        FROM events WHERE ({ERROR_SQL}) IS NOT NULL GROUP BY ALL""",
)
def dlq_report(spark, folder):
    return dlq.report(_letters(spark, folder))


@query(
    "dlq_round_trip",
    f"""SELECT CASE WHEN event_id % 97 = 0 THEN ({LETTER_ID_SQL}) ELSE CAST(event_id AS VARCHAR) END AS event_id,
               {TOPIC_SQL} AS original_topic, {ERROR_SQL} AS error_type, (epoch_us(ts) // 1000) AS timestamp,
               CAST(event_id % 5 AS INTEGER) AS retry_count, 3 AS max_retries, event_id % 97 <> 0 AS event_is_json
        FROM events WHERE ({ERROR_SQL}) IS NOT NULL""",
)
def dlq_round_trip(spark, folder):
    letters = dlq.from_messages(dlq.to_messages(_letters(spark, folder)))
    return letters.select(
        "event_id",
        "original_topic",
        "error_type",
        "timestamp",
        "retry_count",
        "max_retries",
        F.try_parse_json("original_event").isNotNull().alias("event_is_json"),
    )


@query(
    "dlq_replay_until_exhausted",
    f"""SELECT {TOPIC_SQL} AS original_topic, {ERROR_SQL} AS error_type, 3 AS retry_count, count(*) AS archived
        FROM events WHERE ({ERROR_SQL}) IS NOT NULL GROUP BY ALL""",
)
def dlq_replay_until_exhausted(spark, folder):
    """Flawed messages sent back until their retries are used up: all are archived after the third."""
    waiting, archived = flawed_messages(events(spark, folder)).filter(F.col("offset") >= 0), None
    for _ in range(dlq.MAX_RETRIES + 1):
        _, bad = dlq.split(checked(waiting, CLICKSTREAM))
        letters = dlq.dead_letters(bad, failed_at=F.lit(0), retry_count=dlq.retries_so_far(bad))
        waiting, given_up = dlq.replay(letters)
        # What a topic keeps of a message: key, value, topic and headers.
        waiting = waiting.select("key", "value", "topic", "headers")
        archived = given_up if archived is None else archived.unionByName(given_up)
    return archived.groupBy("original_topic", "error_type", "retry_count").agg(F.count("*").alias("archived"))


def _mistyped_log(spark, folder):
    """The change log of orders where every tenth insert has a text for its amount."""
    log = change_log(table(spark, folder, "orders"))
    text = F.col("value").cast("string")
    spoiled = F.regexp_replace(text, r'"amount_cents":(\d+)', '"amount_cents":"$1.5"')
    tenth = (F.col("offset") % 100 == 1) & (F.get_json_object(text, "$.op") == "c")
    return log.withColumn("value", F.when(tenth, spoiled.cast("binary")).otherwise(F.col("value")))


@query(
    "cdc_state_mistyped",
    """WITH s AS (SELECT o_orderkey AS id, o_orderkey % 10 = 0 AND o_orderkey % 3 <> 0 AS spoiled FROM orders WHERE o_orderkey % 7 <> 0)
       SELECT way, count(*) AS rows, count(*) FILTER (WHERE spoiled) AS null_amounts, CAST(sum(id) AS BIGINT) AS ids
       FROM s, (VALUES ('typed'), ('untyped')) v(way) GROUP BY way""",
)
def cdc_state_mistyped(spark, folder):
    """Images typed in the parse or later give the same rows; a bad amount is null, not a lost change."""
    log = _mistyped_log(spark, folder)
    ways = {"typed": cdc.parse_changes(log, ORDER_ROW), "untyped": cdc.parse_changes(log)}
    states = [
        cdc.current_state(changes, ORDER_ROW, ["id"]).select(F.lit(way).alias("way"), "id", "amount_cents")
        for way, changes in ways.items()
    ]
    return states[0].unionByName(states[1]).groupBy("way").agg(
        F.count("*").alias("rows"), F.count_if(F.col("amount_cents").isNull()).alias("null_amounts"), F.sum("id").alias("ids")
    )


def _all_flaws(spark, folder):
    """Flawed messages with two flaws more: a text for ``value`` (79) and no timestamp (73)."""
    flawed = flawed_messages(events(spark, folder))
    text = F.col("value").cast("string")
    at = F.col("offset")
    text = F.when(at % 79 == 0, F.regexp_replace(text, r'"value":[^,}]+', '"value":"much"')).otherwise(text)
    text = F.when(at % 73 == 0, F.regexp_replace(text, r'"timestamp":\d+,', "")).otherwise(text)
    return flawed.withColumn("value", text.cast("binary"))


_FLAW_SQL = """CASE WHEN event_id % 89 = 0 THEN 'UnknownEventType' WHEN event_id % 97 = 0 THEN 'CorruptRecord'
                 WHEN event_id % 79 = 0 THEN 'MistypedField'
                 WHEN event_id % 83 = 0 OR event_id % 73 = 0 THEN 'MissingField' END"""
COUNTED = replace(
    CLICKSTREAM,
    aggregations=(
        AggregationSpec("per_day", "count", WindowSpec("tumbling", "1 day"), group_by=("event_type",)),
        AggregationSpec(
            "big_purchases", "count", WindowSpec("tumbling", "1 day"), where="event_type = 'purchase' AND metrics.value > 50"
        ),
    ),
)


@query(
    "job_with_bad_rows",
    f"""SELECT coalesce({_FLAW_SQL}, 'counted as ' || event_type) AS went, count(*) AS messages FROM events GROUP BY ALL""",
)
def job_with_bad_rows(spark, folder):
    """Every message is either counted by the declared aggregation or a dead letter."""
    good, bad = dlq.split(checked(_all_flaws(spark, folder), COUNTED))
    types = [t.name for t in COUNTED.event_types]
    counts = AggregationJob(COUNTED).result(good, "per_day", types)
    counted = counts.select(F.concat(F.lit("counted as "), "event_type").alias("went"), F.col("count").alias("messages"))
    letters = dlq.dead_letters(bad, failed_at=F.lit(0)).select(F.col("error_type").alias("went"), F.lit(1).alias("messages"))
    return counted.unionByName(letters).groupBy("went").agg(F.sum("messages").alias("messages"))


@query(
    "job_compound_filter",
    """SELECT date_trunc('day', ts) AS window_start, count(*) AS count FROM events
       WHERE event_type = 'purchase' AND value > 50 GROUP BY ALL""",
)
def job_compound_filter(spark, folder):
    """A filter on the event type and on a metric, by the name of its aggregation."""
    messages = event_messages(events(spark, folder))
    result = flatten_window(AggregationJob(COUNTED).result(messages, "big_purchases", ["purchase"]))
    return result.select("window_start", "count")


# ``value`` is a number to all types but clicks, to which it is a text.
CONFLICTING = replace(
    COUNTED,
    event_types=tuple(
        replace(t, attributes=("value",), metrics=()) if t.name == "click" else t for t in CLICKSTREAM.event_types
    ),
)
_CONFLICT_SQL = """CASE WHEN event_id % 79 = 0 AND event_type <> 'click' THEN 'MistypedField' END"""


@query(
    "job_conflicting_fields",
    f"""SELECT coalesce({_CONFLICT_SQL}, 'counted as ' || event_type) AS went, count(*) AS messages,
               CAST(sum(CASE WHEN {_CONFLICT_SQL} IS NULL AND event_type <> 'click' THEN round(value * 100) ELSE 0 END) AS BIGINT) AS cents
        FROM events GROUP BY ALL""",
)
def job_conflicting_fields(spark, folder):
    """A field that two types declare differently is judged and decoded by each message's own type."""
    sent = event_messages(events(spark, folder))
    text = F.col("value").cast("string")
    text = F.when(F.col("offset") % 79 == 0, F.regexp_replace(text, r'"value":[^,}]+', '"value":"much"')).otherwise(text)
    good, bad = dlq.split(checked(sent.withColumn("value", text.cast("binary")), CONFLICTING))
    clicks = decode_types(good, CONFLICTING, ["click"]).select("event_type", F.lit(0).cast("long").alias("cents"))
    others = [t.name for t in CONFLICTING.event_types if t.name != "click"]
    rows = clicks.unionByName(decode_types(good, CONFLICTING, others).select("event_type", to_cents("value").alias("cents")))
    counted = rows.select(F.concat(F.lit("counted as "), "event_type").alias("went"), "cents")
    letters = dlq.dead_letters(bad, failed_at=F.lit(0)).select(F.col("error_type").alias("went"), F.lit(0).cast("long").alias("cents"))
    return counted.unionByName(letters).groupBy("went").agg(F.count("*").alias("messages"), F.sum("cents").alias("cents"))


LIMIT_CENTS = 20_000_000


def _call(change: dict) -> None:
    """A user's callback: no order may be dearer than the limit; a tombstone has no amount."""
    order = json.loads(change["data"])
    if order["amount_cents"] > LIMIT_CENTS:
        raise ValueError(f"{order['id']} is too dear")


@query(
    "cdc_callback_errors",
    f"""SELECT CASE WHEN op_name = 'TOMBSTONE' THEN 'KeyError' WHEN cents > {LIMIT_CENTS} THEN 'ValueError' ELSE 'called' END AS went,
               count(*) AS changes, CAST(sum(lsn) AS BIGINT) AS offsets FROM {_LOG} GROUP BY 1""",
)
def cdc_callback_errors(spark, folder):
    """A callback for every change of a table; those it raises for are dead letters, the rest go on."""
    path = scratch_path(spark, "callbacks")
    handler = cdc.EventHandler(_call, ["data", "offset"], batch_folder(f"{path}/bad"), batch_folder(f"{path}/good"))
    cdc.ChangeRouter(batch_folder(f"{path}/corrupt")).add_handler("orders", handler).run(change_log(table(spark, folder, "orders")))
    letters = spark.read.parquet(f"{path}/bad").select(F.col("error_type").alias("went"), F.regexp_extract("event_id", r"(\d+)$", 1).cast("long").alias("offset"))
    good = spark.read.parquet(f"{path}/good").select(F.lit("called").alias("went"), F.col("offset").cast("long").alias("offset"))
    return letters.unionByName(good).groupBy("went").agg(F.count("*").alias("changes"), F.sum("offset").alias("offsets"))


@query(
    "publish_round_trip",
    """SELECT event_type, count(*) AS published, count(*) AS read_back, CAST(sum(round(value * 100)) AS BIGINT) AS cents,
              count(DISTINCT user_id) AS keys FROM events GROUP BY event_type""",
)
def publish_round_trip(spark, folder):
    """Flat events of each declared type sent as keyed messages to a file topic, and read and decoded again."""
    root = scratch_path(spark, "published")
    flat = events(spark, folder).select(
        F.col("event_id").cast("string").alias("event_id"),
        wall_millis("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        "props",
        "value",
        "event_type",
    )
    found = None
    for kind in CLICKSTREAM.event_types:
        sent = publish(flat.filter(F.col("event_type") == kind.name).drop("event_type"), CLICKSTREAM, kind.name, file_writer(root))
        back = spark.read.parquet(f"{root}/events.{kind.name}")
        decoded = decode_json(back, kind, "user_id").select(to_cents("value").alias("cents"), F.lit(1).alias("read"), F.lit(None).cast("string").alias("key"))
        both = decoded.unionByName(back.select(F.col("key").cast("string").alias("key")), allowMissingColumns=True)
        own = both.agg(F.count("read").alias("read_back"), F.sum("cents").alias("cents"), F.count_distinct("key").alias("keys"))
        own = own.select(F.lit(kind.name).alias("event_type"), F.lit(sent).cast("long").alias("published"), "read_back", "cents", "keys")
        found = own if found is None else found.unionByName(own)
    return found.filter("published > 0")


@query(
    "dlq_file_scan",
    f"""SELECT {TOPIC_SQL} AS original_topic, {ERROR_SQL} AS error_type, count(*) AS letters, CAST(sum(event_id % 5) AS BIGINT) AS retries,
               CAST(min(epoch_us(ts) // 1000) AS BIGINT) AS first_failed,
               count(DISTINCT CASE WHEN event_id % 97 = 0 THEN ({LETTER_ID_SQL}) ELSE CAST(event_id AS VARCHAR) END) AS ids
        FROM events WHERE ({ERROR_SQL}) IS NOT NULL GROUP BY ALL""",
)
def dlq_file_scan(spark, folder):
    """Dead letters written to files as JSON lines, scanned and restored."""
    path = scratch_path(spark, "letters")
    dead_letter_writer("file", path)(_letters(spark, folder))
    return dead_letter_files(spark, path).groupBy("original_topic", "error_type").agg(
        F.count("*").alias("letters"),
        F.sum("retry_count").alias("retries"),
        F.min("timestamp").alias("first_failed"),
        F.count_distinct("event_id").alias("ids"),
    )
