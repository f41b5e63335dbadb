"""The declared aggregations of the three domains, end to end over JSON messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators.aggregate import flatten_window
from tideline.plans.domains import DOMAINS
from tideline.plans.jobs import AggregationJob
from tideline.plans.spec import AggregationSpec, Domain
from tideline.workloads import sqltext
from tideline.workloads.inputs import domain_messages, events
from tideline.workloads.registry import query

# What the specs mean, stated apart from the engine that is checked: source types, window and slide
# in microseconds, group columns, measure, condition.  "?" marks a field that a tenth of its events
# lack.  Fixed values.
_MINUTE = 60_000_000
_HOUR = 60 * _MINUTE
KINDS = {
    "ecommerce": ("page_view", "product_view", "add_to_cart", "remove_from_cart", "purchase", "search"),
    "iot": ("sensor_reading", "device_status", "alert", "command"),
    "fintech": ("transaction", "login", "fraud_alert", "account_update", "payment"),
}
MEANING: dict[str, tuple] = {
    "events_per_minute": ("ecommerce", KINDS["ecommerce"], _MINUTE, None, ("device_type",), "count", None, None),
    "active_users": ("ecommerce", KINDS["ecommerce"], 5 * _MINUTE, _MINUTE, (), "unique_count", "user_id", None),
    "revenue_per_hour": ("ecommerce", ("purchase",), _HOUR, None, ("currency",), "total", "total_amount", None),
    "top_products_viewed": ("ecommerce", ("product_view",), _HOUR, None, ("product_id?", "product_name?"), "count", None, None),
    "cart_abandonment": ("ecommerce", ("add_to_cart",), _HOUR, None, ("user_id",), "count", None, None),
    "avg_order_value": ("ecommerce", ("purchase",), _HOUR, None, (), "average", "total_amount", None),
    "avg_temperature": ("iot", ("sensor_reading",), 5 * _MINUTE, None, ("location",), "average", "temperature?", None),
    "readings_per_minute": ("iot", ("sensor_reading",), _MINUTE, None, ("facility",), "count", None, None),
    "alerts_by_severity": ("iot", ("alert",), 15 * _MINUTE, 5 * _MINUTE, ("severity?", "alert_category"), "count", None, None),
    "active_devices": ("iot", KINDS["iot"], 10 * _MINUTE, _MINUTE, ("facility",), "unique_count", "device_id", None),
    "low_battery_devices": ("iot", ("device_status",), _HOUR, None, ("facility",), "count", None, ("battery_level?", "< 20")),
    "transaction_volume": ("fintech", ("transaction",), _MINUTE, None, ("transaction_type", "currency"), "total", "amount", None),
    "transactions_per_minute": ("fintech", ("transaction",), _MINUTE, None, ("transaction_type", "country"), "count", None, None),
    "unique_active_accounts": (
        "fintech", ("transaction", "login", "fraud_alert", "payment"), 5 * _MINUTE, _MINUTE, ("country",), "unique_count", "account_id", None,
    ),
    "failed_logins": ("fintech", ("login",), 5 * _MINUTE, None, ("country", "auth_method"), "count", None, ("login_status", "= 'failed'")),
    "fraud_alerts_by_severity": (
        "fintech", ("fraud_alert",), 15 * _MINUTE, 5 * _MINUTE, ("severity", "alert_type"), "count", None, None,
    ),
    "avg_transaction_value": ("fintech", ("transaction",), 10 * _MINUTE, None, ("transaction_type", "currency"), "average", "amount", None),
    "high_value_transactions": ("fintech", ("transaction",), _HOUR, None, ("country", "channel"), "count", None, ("amount", "> 100000")),
}
_MEASURES = {
    "count": "count(*)",
    "unique_count": "count(DISTINCT measured)",
    "total": "CAST(sum(measured) AS BIGINT)",
    "average": "round(avg(measured), 6)",
}


def _field_sql(domain: str, field: str) -> str:
    """One generated field as SQL over ``events`` (only the fields the specs use)."""
    name = field.removesuffix("?")
    if name in ("user_id", "device_id", "account_id"):
        value = "printf('user_%06d', user_id)"
    elif name == "total_amount":
        value = "CAST(round(value * 100) AS BIGINT)"
    elif name == "amount":
        value = "CAST(round(value * 100) AS BIGINT) * 10"
    elif name in DOMAINS[domain].samples:
        value = sqltext.pick("event_id", name, DOMAINS[domain].samples[name])
    else:
        value = f"{sqltext.draw_between('event_id', name, 0, 10000)} / 100"
    return sqltext.nullable("event_id", name, value) if field.endswith("?") else value


def spec_sql(name: str) -> str:
    domain, types, size, slide, groups, measure, measured, condition = MEANING[name]
    keys = [g.removesuffix("?") for g in groups]
    selected = [f"{_field_sql(domain, g)} AS {k}" for g, k in zip(groups, keys)]
    if measured:
        selected.append(f"{_field_sql(domain, measured)} AS measured")
    where = "kind IN (" + ", ".join(f"'{t}'" for t in types) + ")"
    if condition:
        where += f" AND {_field_sql(domain, condition[0])} {condition[1]}"
    kinds = ", ".join(f"'{k}'" for k in KINDS[domain])
    kind = f"list_value({kinds})[{sqltext.draw('event_id', 'event_type')} % {len(KINDS[domain])} + 1]"
    step = slide or size
    start = f"((us // {step}) - i) * {step}"
    group = ", ".join([*keys, "window_start", "window_end"])
    return f"""
        WITH typed AS (
            SELECT *, (epoch_us(ts) // 1000) * 1000 AS us, {kind} AS kind FROM events
        ), rows_ AS (
            SELECT us{''.join(', ' + s for s in selected)} FROM typed WHERE {where}
        )
        SELECT make_timestamp({start}) AS window_start, make_timestamp({start} + {size}) AS window_end,
               {''.join(k + ', ' for k in keys)}{_MEASURES[measure]} AS "{measure}"
        FROM rows_, generate_series(0, {size // step - 1}) g(i) GROUP BY {group}
    """


def _register(domain: Domain, spec: AggregationSpec) -> None:
    @query(f"spec_{spec.name}", spec_sql(spec.name))
    def run(spark, folder):
        messages = domain_messages(events(spark, folder), domain, domain.source_types(spec))
        result = flatten_window(AggregationJob(domain).result(messages, spec.name))
        if spec.kind == "avg":
            result = result.withColumn(spec.measure, F.round(spec.measure, 6))
        return result


for _domain in DOMAINS.values():
    for _spec in _domain.aggregations:
        _register(_domain, _spec)
