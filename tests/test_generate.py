import re

from pyspark.sql import functions as F

from tideline.operators.generate import generate_events, generate_messages, generate_sessions, shape_traffic, spine
from tideline.plans.domains import DOMAINS, ECOMMERCE, FINTECH
from tideline.plans.schema import struct_type

START = 1_704_067_200_000  # a Monday, midnight


def test_every_type_of_every_domain(spark):
    rows = spine(spark, 200, START)
    for domain in DOMAINS.values():
        for event_type in domain.event_types:
            made = generate_events(rows, domain, event_type.name)
            schema = struct_type(event_type, domain.entity_key)
            assert made.columns == schema.names
            assert [f.dataType for f in made.schema.fields] == [f.dataType for f in schema.fields]
            required = [f.name for f in schema.fields if not f.nullable]
            assert made.filter(" OR ".join(f"`{n}` IS NULL" for n in required)).isEmpty()


def test_values(spark):
    made = generate_events(spine(spark, 5000, START), FINTECH, "transaction").collect()
    assert len({r.event_id for r in made}) == 5000
    uuid = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-a[0-9a-f]{3}-[0-9a-f]{12}")
    assert all(uuid.fullmatch(r.event_id) for r in made)
    assert all(re.fullmatch(r"user_\d{6}", r.account_id) and 1 <= int(r.account_id[5:]) <= 10000 for r in made)
    amounts = [r.amount for r in made if r.amount is not None]
    assert 100 <= min(amounts) and max(amounts) <= 100_000
    assert 0.07 < 1 - len(amounts) / len(made) < 0.13
    assert {r.currency for r in made} == set(FINTECH.samples["currency"])
    assert all(r.transaction_id is None or re.fullmatch(r"transaction_id_[0-9a-f]{8}", r.transaction_id) for r in made)


def test_doubles_have_two_digits(spark):
    made = generate_events(spine(spark, 1000, START), DOMAINS["iot"], "sensor_reading")
    row = made.agg(
        F.min("temperature").alias("lo"),
        F.max("temperature").alias("hi"),
        F.count_if(F.abs(F.col("temperature") * 100 - F.round(F.col("temperature") * 100)) > 1e-6).alias("odd"),
    ).first()
    assert 0 <= row.lo and row.hi <= 100 and row.odd == 0


def test_same_rows_whatever_the_partitioning(spark):
    rows = spine(spark, 500, START)
    one = generate_events(rows.repartition(1), ECOMMERCE, "purchase")
    many = generate_events(rows.repartition(7), ECOMMERCE, "purchase")
    assert one.exceptAll(many).isEmpty()
    other = generate_events(rows, ECOMMERCE, "purchase", seed=7)
    assert not one.exceptAll(other).isEmpty()


def test_given_fields(spark):
    given = {"user_id": "'me'", "total_amount": "id * 2"}
    made = generate_events(spine(spark, 10, START), ECOMMERCE, "purchase", given=given).collect()
    assert {r.user_id for r in made} == {"me"}
    assert [r.total_amount for r in made] == [i * 2 for i in range(10)]
    assert [r.timestamp for r in made] == [START + i for i in range(10)]


def test_mixed_messages_and_subscription(spark):
    rows = spine(spark, 3000, START)
    mixed = generate_messages(rows, ECOMMERCE)
    counts = {r.topic: r["count"] for r in mixed.groupBy("topic").count().collect()}
    assert set(counts) == {f"events.{t.name}" for t in ECOMMERCE.event_types}
    assert sum(counts.values()) == 3000
    some = generate_messages(rows, ECOMMERCE, ["purchase"])
    assert some.exceptAll(mixed.filter("topic = 'events.purchase'")).isEmpty()
    assert some.count() == counts["events.purchase"]


def test_sessions(spark):
    made = generate_sessions(spine(spark, 20_000, START, 1000), ECOMMERCE)
    rows = made.groupBy("session_id").agg(
        F.sort_array(F.collect_list(F.struct("step", "event_type", "timestamp"))).alias("steps"),
        F.count_distinct("user_id").alias("users"),
    )
    order = ["page_view", "product_view", "add_to_cart", "purchase", "search"]
    kinds = {name: 0 for name in order}
    for row in rows.toLocalIterator():
        assert row.users == 1
        names = [s.event_type for s in row.steps]
        assert names[0] == "page_view" and names == sorted(names, key=order.index)
        assert ("add_to_cart" not in names) or "product_view" in names
        assert ("purchase" not in names) or "add_to_cart" in names
        times = [s.timestamp for s in row.steps]
        assert times == sorted(times)
        for name in names:
            kinds[name] += 1
    assert abs(kinds["product_view"] / 20_000 - 0.6) < 0.03
    assert abs(kinds["add_to_cart"] / kinds["product_view"] - 0.4) < 0.05
    assert abs(kinds["purchase"] / kinds["add_to_cart"] - 0.03) < 0.03
    assert abs(kinds["search"] / 20_000 - 0.2) < 0.03


def test_traffic_shape(spark):
    week = spine(spark, 7 * 24 * 60, START, 60_000)
    kept = shape_traffic(week, ECOMMERCE).select(
        (F.floor(F.col("at_millis") / 3_600_000) % 24).alias("h"), (F.floor((F.col("at_millis") - START) / 86_400_000)).alias("d")
    )
    by = {(r.h in (10, 11, 12, 19, 20, 21), r.d >= 5): r.n for r in kept.groupBy("h", "d").agg(F.count("*").alias("n")).collect()}
    saturday_peak = kept.filter("h = 10 AND d = 5").count()
    monday_night = kept.filter("h = 3 AND d = 0").count()
    assert saturday_peak == 60
    assert 12 < monday_night < 35
    assert len(by) == 4
