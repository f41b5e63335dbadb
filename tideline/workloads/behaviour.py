"""Sessions, funnels, follow-ups, enrichment, late rows and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.scalars import to_cents
from tideline.operators.aggregate import aggregate, flatten_window
from tideline.operators.alerts import cooldown, event_alerts, metric_alerts
from tideline.operators.joins import enrich, first_follow_up, without_follow_up
from tideline.operators.late import flag_late
from tideline.operators.sessions import funnel, sessionize
from tideline.plans.domains import ECOMMERCE
from tideline.plans.jobs import AggregationJob
from tideline.sources.tables import table
from tideline.workloads.domains import spec_sql
from tideline.workloads.inputs import CLICKSTREAM, domain_messages, events
from tideline.workloads.registry import query


@query(
    "sessionize",
    """SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events FROM (
         SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (
           SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
                          THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s""",
)
def sessions(spark, folder):
    return sessionize(events(spark, folder), ["user_id"], "ts", "30 minutes")


@query(
    "funnel_by_user",
    """WITH v AS (SELECT user_id, min(ts) AS view_at FROM events WHERE event_type = 'view' GROUP BY user_id),
            c AS (SELECT e.user_id, min(ts) AS click_at FROM events e JOIN v ON v.user_id = e.user_id AND ts >= view_at
                  WHERE event_type = 'click' GROUP BY e.user_id),
            p AS (SELECT e.user_id, min(ts) AS purchase_at FROM events e JOIN c ON c.user_id = e.user_id AND ts >= click_at
                  WHERE event_type = 'purchase' GROUP BY e.user_id)
       SELECT user_id, view_at, click_at, purchase_at,
              1 + CAST(click_at IS NOT NULL AS INTEGER) + CAST(purchase_at IS NOT NULL AS INTEGER) AS stage
       FROM v LEFT JOIN c USING (user_id) LEFT JOIN p USING (user_id)""",
)
def funnel_by_user(spark, folder):
    return funnel(events(spark, folder), "user_id", "ts", "event_type", ["view", "click", "purchase"])


FIVE_STEPS = ["signup", "view", "click", "error", "purchase"]


def _funnel_sql(steps: list[str]) -> str:
    """One table per step: the first time of the step at or after the previous one's."""
    parts = [f"s0 AS (SELECT user_id, min(ts) AS at FROM events WHERE event_type = '{steps[0]}' GROUP BY user_id)"]
    for n, step in enumerate(steps[1:], 1):
        parts.append(
            f"s{n} AS (SELECT e.user_id, min(ts) AS at FROM events e JOIN s{n - 1} p ON p.user_id = e.user_id AND ts >= p.at "
            f"WHERE event_type = '{step}' GROUP BY e.user_id)"
        )
    columns = ", ".join(f"s{n}.at AS {step}_at" for n, step in enumerate(steps))
    stage = " + ".join(f"CAST(s{n}.at IS NOT NULL AS INTEGER)" for n in range(len(steps)))
    joins = " ".join(f"LEFT JOIN s{n} ON s{n}.user_id = s0.user_id" for n in range(1, len(steps)))
    return f"WITH {', '.join(parts)} SELECT s0.user_id, {columns}, {stage} AS stage FROM s0 {joins}"


@query("funnel_five_steps", _funnel_sql(FIVE_STEPS))
def funnel_five_steps(spark, folder):
    return funnel(events(spark, folder), "user_id", "ts", "event_type", FIVE_STEPS)


@query(
    "abandoned_carts",
    """SELECT event_id, user_id, ts FROM events v WHERE event_type = 'view' AND NOT EXISTS (
         SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = v.user_id
           AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 12 HOUR)""",
)
def abandoned_carts(spark, folder):
    df = events(spark, folder).select("event_id", "user_id", "ts", "event_type")
    views = df.filter("event_type = 'view'").drop("event_type")
    return without_follow_up(views, df.filter("event_type = 'purchase'"), "user_id", "ts", "12 hours")


@query(
    "interval_join_view_purchase",
    """SELECT v.event_id, v.user_id, v.ts, coalesce(p.event_id, -1) AS purchase_id, p.ts AS purchase_at
       FROM (SELECT * FROM events WHERE event_type = 'view') v
       LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
         ON p.user_id = v.user_id AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 12 HOUR
       QUALIFY row_number() OVER (PARTITION BY v.event_id ORDER BY p.ts, p.event_id) = 1""",
)
def interval_join_view_purchase(spark, folder):
    df = events(spark, folder).select("event_id", "user_id", "ts", "event_type")
    views = df.filter("event_type = 'view'").drop("event_type")
    matched = first_follow_up(
        views, df.filter("event_type = 'purchase'"), "user_id", "ts", "12 hours", ["event_id"]
    )
    return matched.select(
        "event_id", "user_id", "ts", F.coalesce("match.event_id", F.lit(-1)).alias("purchase_id"), F.col("match.time").alias("purchase_at")
    )


@query(
    "enrich_orders_dim",
    """SELECT n_name, o_orderpriority, count(*) AS orders, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS cents
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
       GROUP BY n_name, o_orderpriority""",
)
def enrich_orders_dim(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderpriority", to_cents("o_totalprice").alias("cents"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    # The many-rows join runs on rows already reduced to one per customer and priority.
    per_customer = orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.count("*").alias("orders"), F.sum("cents").alias("cents")
    )
    named = enrich(customer, nation, customer.c_nationkey == nation.n_nationkey)
    joined = enrich(per_customer, named, per_customer.o_custkey == named.c_custkey)
    return joined.groupBy("n_name", "o_orderpriority").agg(F.sum("orders").alias("orders"), F.sum("cents").alias("cents"))


# Arrival order: event order with local jitter; 500 arrivals make a batch.
_ARRIVAL = "(event_id + event_id * 7919 % 97) // 500"


@query(
    "late_split",
    f"""WITH a AS (SELECT event_id, ts, {_ARRIVAL} AS batch FROM events),
             m AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                          - INTERVAL 10 MINUTE AS watermark FROM a GROUP BY batch)
        SELECT a.event_id, a.batch, m.watermark, coalesce(a.ts < m.watermark, false) AS is_late FROM a JOIN m USING (batch)""",
)
def late_split(spark, folder):
    arrived = events(spark, folder).select(
        "event_id", "ts", F.expr("(event_id + event_id * 7919 % 97) div 500").alias("batch")
    )
    return flag_late(arrived, "batch", "ts", "10 minutes").drop("ts")


# ---------------------------------------------------------------------- alerts


@query(
    "metric_alerts",
    f"""SELECT 'revenue_drop' AS alert, 'critical' AS severity, window_start, window_end, currency, total
        FROM ({spec_sql('revenue_per_hour')}) WHERE total < 1000""",
)
def metric_alerts_query(spark, folder):
    alert = ECOMMERCE.alert("revenue_drop")
    spec = ECOMMERCE.aggregation(alert.metric)
    messages = domain_messages(events(spark, folder), ECOMMERCE, ECOMMERCE.source_types(spec))
    totals = flatten_window(AggregationJob(ECOMMERCE).result(messages, spec.name))
    return metric_alerts(totals, alert, spec).drop("alert_time")


_LARGE = "event_type = 'purchase' AND value > 100"


@query(
    "event_alerts",
    f"""SELECT 'large_purchase' AS alert, 'info' AS severity, event_id, user_id, ts AS alert_time, value
        FROM events WHERE {_LARGE}""",
)
def event_alerts_query(spark, folder):
    hits = event_alerts(events(spark, folder), CLICKSTREAM.alert("large_purchase"), "user_id", time="ts")
    return hits.select("alert", "severity", "event_id", "user_id", "alert_time", "value")


def _all_alerts(spark, folder):
    df = events(spark, folder)
    large = event_alerts(df, CLICKSTREAM.alert("large_purchase"), "user_id", time="ts")
    seen = event_alerts(df, CLICKSTREAM.alert("error_seen"), "user_id", time="ts")
    return large.unionByName(seen).select("alert", "alert_time", "event_id")


_ALERTS_SQL = f"""SELECT 'large_purchase' AS alert, ts AS t, min(event_id) AS event_id FROM events WHERE {_LARGE} GROUP BY ts
    UNION ALL SELECT 'error_seen', ts, min(event_id) FROM events WHERE event_type = 'error' AND value > 0 GROUP BY ts"""


ALERT_COOLDOWN_SQL = f"""WITH RECURSIVE a AS ({_ALERTS_SQL}),
             n AS (SELECT alert, t, min(t) OVER (PARTITION BY alert ORDER BY t
                     RANGE BETWEEN INTERVAL 6 HOUR FOLLOWING AND UNBOUNDED FOLLOWING) AS next_t FROM a),
             f AS (SELECT alert, min(t) AS t FROM a GROUP BY alert
                   UNION ALL SELECT n.alert, n.next_t FROM f JOIN n ON n.alert = f.alert AND n.t = f.t WHERE n.next_t IS NOT NULL)
        SELECT a.alert, a.t AS alert_time, a.event_id FROM f JOIN a ON a.alert = f.alert AND a.t = f.t"""


@query("alert_cooldown", ALERT_COOLDOWN_SQL)
def alert_cooldown(spark, folder):
    return cooldown(_all_alerts(spark, folder), "6 hours", ["event_id"])


@query("alert_cooldown_doubling", ALERT_COOLDOWN_SQL)
def alert_cooldown_doubling(spark, folder):
    """The same by pointer doubling, the way of alerts with more times than one task follows."""
    return cooldown(_all_alerts(spark, folder), "6 hours", ["event_id"], small=0)


@query(
    "metric_alert_cooldown",
    f"""WITH RECURSIVE w AS (SELECT make_timestamp((epoch_us(ts) // 60000000) * 60000000 + 60000000) AS t, event_type, count(*) AS count
                             FROM events GROUP BY ALL),
             a AS (SELECT t, min(event_type) AS event_type FROM w WHERE count < 10 GROUP BY t),
             n AS (SELECT t, min(t) OVER (ORDER BY t RANGE BETWEEN INTERVAL 10 MINUTE FOLLOWING AND UNBOUNDED FOLLOWING)
                     AS next_t FROM a),
             f AS (SELECT min(t) AS t FROM a UNION ALL SELECT n.next_t FROM f JOIN n ON n.t = f.t WHERE n.next_t IS NOT NULL)
        SELECT 'low_traffic' AS alert, 'warning' AS severity, a.t AS alert_time, a.event_type FROM f JOIN a ON a.t = f.t""",
)
def metric_alert_cooldown(spark, folder):
    alert = ECOMMERCE.alert("low_traffic")
    spec = ECOMMERCE.aggregation(alert.metric)
    per_type = spec.__class__(spec.name, spec.kind, spec.window, group_by=("event_type",))
    counted = flatten_window(aggregate(events(spark, folder), per_type, time="ts"))
    hits = metric_alerts(counted, alert, per_type).select("alert", "severity", "alert_time", "event_type")
    return cooldown(hits, alert.cooldown, ["event_type"])
