"""Inputs the queries share, all derived from the given tables inside Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import to_cents
from tideline.functions.times import wall_millis, wall_to_instant
from tideline.operators.generate import generate_messages, user_name
from tideline.plans.spec import AlertSpec, Condition, Domain, EventType
from tideline.sources.tables import table

# The event types of the ``events`` table, as a domain of their own.
CLICKSTREAM = Domain(
    name="clickstream",
    entity_key="user_id",
    event_types=tuple(
        EventType(name, attributes=("props",), metrics=("value",))
        for name in ("click", "error", "purchase", "signup", "view")
    ),
    alerts=(
        AlertSpec("large_purchase", Condition("greater_than", 100, "value"), "info", event_type="purchase", cooldown="6 hours"),
        AlertSpec("error_seen", Condition("greater_than", 0, "value"), "warning", event_type="error", cooldown="6 hours"),
    ),
)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def spine(df: DataFrame) -> DataFrame:
    """The events table as generator input: id, event time, user and value of every event."""
    return df.select("event_id", "ts", "user_id", "value").select(
        F.col("event_id").alias("id"),
        wall_millis("ts").alias("at_millis"),
        "user_id",
        "value",
    )


def domain_messages(df: DataFrame, domain: Domain, event_types: list[str] | None = None) -> DataFrame:
    """Every event as a message of a drawn type of ``domain``, with its real user and amount."""
    given = {
        domain.entity_key: user_name("user_id"),
        "total_amount": "floor(value * 100 + 0.5D)",
        "amount": "floor(value * 100 + 0.5D) * 10",
    }
    return generate_messages(spine(df), domain, event_types, given=given)


def event_messages(df: DataFrame) -> DataFrame:
    """The events table as JSON messages; offset = event id."""
    return df.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("event_id"),
                wall_millis("ts").alias("timestamp"),
                F.col("user_id").cast("string").alias("user_id"),
                "props",
                "value",
            )
        )
        .cast("binary")
        .alias("value"),
        F.concat(F.lit("events."), F.col("event_type")).alias("topic"),
        (F.col("event_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        wall_to_instant("ts").alias("timestamp"),
    )


def flawed_messages(df: DataFrame) -> DataFrame:
    """The same with three kinds of flaws, keyed by event id: unparsable payload (97), a type
    nobody declared (89), no user (83)."""
    broken = F.col("offset") % 97 == 0
    unknown = F.col("offset") % 89 == 0
    no_user = F.col("offset") % 83 == 0
    text = F.col("value").cast("string")
    damaged = (
        F.when(broken, F.concat(F.lit("{bad "), F.col("offset").cast("string")))
        .when(no_user, F.regexp_replace(text, r'"user_id":"\d+",', ""))
        .otherwise(text)
    )
    return event_messages(df).withColumns(
        {
            "value": damaged.cast("binary"),
            "topic": F.when(unknown, F.lit("events.mystery")).otherwise(F.col("topic")),
        }
    )


def change_log(orders: DataFrame) -> DataFrame:
    """Change messages from the orders table: an insert per order, an update if the key divides by 3,
    a delete and its tombstone if it divides by 7.  One scan."""
    key = F.col("o_orderkey")
    cents = to_cents("o_totalprice")
    inserted = _order_image("pending", cents)
    updated = _order_image("completed", cents)
    none = F.lit(None).cast(_ORDER)
    last = F.when(key % 3 == 0, updated).otherwise(inserted)
    steps = F.array(
        F.struct(F.lit("c").alias("op"), none.alias("before"), inserted.alias("after"), F.lit(1).alias("seq")),
        F.when(
            key % 3 == 0,
            F.struct(F.lit("u").alias("op"), inserted.alias("before"), updated.alias("after"), F.lit(2).alias("seq")),
        ),
        F.when(
            key % 7 == 0,
            F.struct(F.lit("d").alias("op"), last.alias("before"), none.alias("after"), F.lit(3).alias("seq")),
        ),
        F.when(
            key % 7 == 0,
            F.struct(F.lit(None).cast("string").alias("op"), none.alias("before"), none.alias("after"), F.lit(4).alias("seq")),
        ),
    )
    rows = orders.select(
        key.alias("id"),
        wall_millis("o_orderdate").alias("at"),
        F.explode(steps).alias("s"),
    ).filter("s IS NOT NULL")
    lsn = F.col("id") * 10 + F.col("s.seq")
    return _as_change_messages(rows, "orders", lsn)


def customer_log(customers: DataFrame) -> DataFrame:
    """Change messages from the customer table: a snapshot row each, an update if the key divides by 5."""
    key = F.col("c_custkey")

    def image(name):
        return F.struct(
            key.alias("id"), name.alias("name"), F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email")
        )

    renamed = F.concat(F.col("c_name"), F.lit(" (new)"))
    none = F.lit(None).cast("struct<id:bigint,name:string,email:string>")
    steps = F.array(
        F.struct(F.lit("r").alias("op"), none.alias("before"), image(F.col("c_name")).alias("after"), F.lit(1).alias("seq")),
        F.when(
            key % 5 == 0,
            F.struct(
                F.lit("u").alias("op"), image(F.col("c_name")).alias("before"), image(renamed).alias("after"), F.lit(2).alias("seq")
            ),
        ),
    )
    rows = customers.select(
        key.alias("id"),
        (F.lit(1_700_000_000_000) + key).alias("at"),
        F.explode(steps).alias("s"),
    ).filter("s IS NOT NULL")
    return _as_change_messages(rows, "customers", F.col("id") * 10 + F.col("s.seq"))


_ORDER = "struct<id:bigint,customer_id:bigint,amount_cents:bigint,status:string>"


def _order_image(status: str, cents):
    return F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        cents.alias("amount_cents"),
        F.lit(status).alias("status"),
    )


def _as_change_messages(rows: DataFrame, name: str, lsn) -> DataFrame:
    source = F.struct(
        F.lit("shop").alias("db"), F.lit(name).alias("table"), F.col("id").alias("txId"), lsn.alias("lsn")
    )
    envelope = F.struct(
        F.col("s.op").alias("op"),
        F.col("s.before").alias("before"),
        F.col("s.after").alias("after"),
        source.alias("source"),
        F.col("at").alias("ts_ms"),
    )
    value = F.to_json(envelope, {"ignoreNullFields": "false"}).cast("binary")
    return rows.select(
        F.to_json(F.struct("id")).cast("binary").alias("key"),
        F.when(F.col("s.op").isNotNull(), value).alias("value"),
        F.lit(f"cdc.public.{name}").alias("topic"),
        F.lit(0).alias("partition"),
        lsn.alias("offset"),
        F.timestamp_millis("at").alias("timestamp"),
    )
