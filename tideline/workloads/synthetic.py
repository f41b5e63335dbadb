"""Generated data, one row per row of a given table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.times import wall_millis
from tideline.operators.generate import generate_events, generate_sessions, shape_traffic
from tideline.plans.domains import ECOMMERCE, FINTECH
from tideline.sources.tables import table
from tideline.workloads import sqltext
from tideline.workloads.inputs import events, spine
from tideline.workloads.registry import query
from tideline.workloads.sqltext import draw, draw_between, nullable, pick


def _uuid(purpose: str) -> str:
    digest = f"md5('{sqltext.SEED}:{purpose}:' || event_id)"
    return (
        f"regexp_replace({digest}, '^(.{{8}})(.{{4}}).(.{{3}}).(.{{3}})(.{{12}})$', "
        r"'\1-\2-4\3-a\4-\5')"
    )


def _tag(name: str) -> str:
    return f"'{name}_' || printf('%08x', {draw('event_id', name)})"


_TRANSACTION = {
    "event_id": _uuid("event_id"),
    "timestamp": "epoch_us(ts) // 1000",
    "account_id": f"printf('user_%06d', {draw_between('event_id', 'account_id', 1, 10000)})",
    "transaction_id": nullable("event_id", "transaction_id", _tag("transaction_id")),
    "merchant_name": nullable("event_id", "merchant_name", "'sample_merchant_name'"),
    "merchant_category": nullable(
        "event_id", "merchant_category", pick("event_id", "merchant_category", FINTECH.samples["merchant_category"])
    ),
    "description": nullable("event_id", "description", "'sample_description'"),
    "amount": f"coalesce({nullable('event_id', 'amount', draw_between('event_id', 'amount', 100, 100000))}, -1)",
    "fee": f"coalesce({nullable('event_id', 'fee', draw_between('event_id', 'fee', 100, 100000))}, -1)",
    "transaction_type": pick("event_id", "transaction_type", FINTECH.samples["transaction_type"]),
    "currency": pick("event_id", "currency", FINTECH.samples["currency"]),
    "country": pick("event_id", "country", FINTECH.samples["country"]),
    "channel": pick("event_id", "channel", FINTECH.samples["channel"]),
}


@query("generate_events", "SELECT " + ", ".join(f'{v} AS "{k}"' for k, v in _TRANSACTION.items()) + " FROM events")
def generate_events_query(spark, folder):
    made = generate_events(spine(events(spark, folder)), FINTECH, "transaction")
    return made.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("amount", "fee")})


def _chance(name: str, probability: float) -> str:
    return f"({draw('id', 'session:' + name)} % 10000 < {round(probability * 10000)})"


def _gap(name: str, low: int, high: int) -> str:
    return draw_between("id", "gap:" + name, low, high)


@query(
    "generate_sessions",
    f"""WITH s AS (SELECT o_orderkey AS id, epoch_us(o_orderdate) // 1000 AS t0 FROM orders),
             d AS (SELECT *, printf('user_%06d', {draw_between('id', 'user_id', 1, 10000)}) AS user_id,
                          {_chance('product_view', 0.6)} AS v, {_chance('add_to_cart', 0.4)} AS c0,
                          {_chance('purchase', 0.03)} AS p0, {_chance('search', 0.2)} AS q FROM s),
             e AS (SELECT *, v AND c0 AS c, v AND c0 AND p0 AS p FROM d),
             t AS (SELECT *, t0 + CASE WHEN v THEN {_gap('product_view', 5000, 30000)} ELSE 0 END AS t1 FROM e),
             u AS (SELECT *, t1 + CASE WHEN c THEN {_gap('add_to_cart', 10000, 60000)} ELSE 0 END AS t2 FROM t),
             w AS (SELECT *, t2 + CASE WHEN p THEN {_gap('purchase', 30000, 120000)} ELSE 0 END AS t3 FROM u),
             x AS (SELECT *, t3 + CASE WHEN q THEN {_gap('search', 1000, 10000)} ELSE 0 END AS t4 FROM w),
             y AS (SELECT id, user_id, 1 AS o, 'page_view' AS event_type, t0 AS timestamp FROM x
                   UNION ALL SELECT id, user_id, 2, 'product_view', t1 FROM x WHERE v
                   UNION ALL SELECT id, user_id, 3, 'add_to_cart', t2 FROM x WHERE c
                   UNION ALL SELECT id, user_id, 4, 'purchase', t3 FROM x WHERE p
                   UNION ALL SELECT id, user_id, 5, 'search', t4 FROM x WHERE q)
        SELECT id AS session_id, CAST(row_number() OVER (PARTITION BY id ORDER BY o) AS INTEGER) AS step,
               user_id, event_type, timestamp FROM y""",
)
def generate_sessions_query(spark, folder):
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), wall_millis("o_orderdate").alias("at_millis"))
    return generate_sessions(rows, ECOMMERCE)


@query(
    "traffic_shape",
    f"""SELECT hour(ts) AS hour_of_day, isodow(ts) >= 6 AS weekend, count(*) AS events FROM events
        WHERE {draw('event_id', 'traffic')} % 1000 < floor(
            (CASE WHEN hour(ts) IN (10, 11, 12, 19, 20, 21) THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END)
            * (CASE WHEN isodow(ts) >= 6 THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END) * 1000 / 1.3::DOUBLE)
        GROUP BY ALL""",
)
def traffic_shape(spark, folder):
    kept = shape_traffic(spine(events(spark, folder)), ECOMMERCE)
    hour = F.floor(F.col("at_millis") / 3_600_000) % 24
    weekend = (F.floor(F.col("at_millis") / 86_400_000) % 7).isin(2, 3)
    return kept.groupBy(hour.alias("hour_of_day"), weekend.alias("weekend")).agg(F.count("*").alias("events"))
