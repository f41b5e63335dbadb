import json

import pytest
from pyspark.sql import functions as F

from tideline.operators import cdc
from tideline.sources.messages import MESSAGE_SCHEMA
from tideline.workloads.changes import CUSTOMER_ROW

TOPIC = "cdc.public.customers"
JOHN = {"id": 1, "name": "John", "email": "john@example.com"}
JANE = {"id": 1, "name": "Jane", "email": "jane@example.com"}


def envelope(op, before, after, lsn, **extra):
    source = {"db": "streaming", "table": "customers", "txId": 7, "lsn": lsn}
    return {"op": op, "before": before, "after": after, "source": source, "ts_ms": 1700000000000 + lsn, **extra}


def messages(spark, *values, topic=TOPIC):
    rows = []
    for offset, value in enumerate(values):
        if isinstance(value, dict):
            value = json.dumps(value)
        rows.append((None, value.encode() if value is not None else None, topic, 0, offset, None))
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def parse(spark, *values, topic=TOPIC):
    return cdc.parse_changes(messages(spark, *values, topic=topic)).orderBy("offset").collect()


def test_insert(spark):
    [row] = parse(spark, envelope("c", None, JOHN, 456))
    assert (row.op, row.op_name, row.schema, row.table) == ("c", "INSERT", "public", "customers")
    assert json.loads(row.data) == JOHN and row.before is None and json.loads(row.after) == JOHN
    assert row.source.asDict() == {"db": "streaming", "table": "customers", "txId": 7, "lsn": 456}
    assert row.ts_ms == 1700000000456
    assert json.loads(row.raw)["op"] == "c"


def test_update_keeps_both_images(spark):
    [row] = parse(spark, envelope("u", JOHN, JANE, 457))
    assert row.op_name == "UPDATE"
    assert json.loads(row.data) == JANE and json.loads(row.before) == JOHN


def test_delete_takes_the_before_image(spark):
    [row] = parse(spark, envelope("d", JOHN, None, 458))
    assert row.op_name == "DELETE" and json.loads(row.data) == JOHN and row.after is None


def test_tombstone(spark):
    [row] = parse(spark, None)
    assert (row.op, row.op_name, row.data, row.ts_ms) == ("d", "TOMBSTONE", "{}", None)
    assert row.before is None and row.after is None and row.raw is None


def test_snapshot_unknown_and_missing_op(spark):
    rows = parse(spark, envelope("r", None, JOHN, 1), envelope("t", None, JOHN, 2), {"after": JOHN})
    assert [(r.op, r.op_name) for r in rows] == [("r", "SNAPSHOT"), ("t", "UNKNOWN"), ("unknown", "UNKNOWN")]


def test_missing_image_differs_from_null_image(spark):
    rows = parse(spark, {"op": "c"}, {"op": "c", "after": None}, {"op": "d", "after": JOHN})
    assert [r.data for r in rows] == ["{}", None, "{}"]


@pytest.mark.parametrize(
    "topic,expected",
    [("a.b.c", ("b", "c")), ("a.b", ("b", "a.b")), ("single", ("public", "single")), ("a.b.c.d", ("b", "c"))],
)
def test_topic_split(spark, topic, expected):
    [row] = parse(spark, envelope("c", None, JOHN, 1), topic=topic)
    assert (row.schema, row.table) == expected


def test_unparsable_messages_are_skipped_or_flagged(spark):
    bad = ["{bad", "null", "[1]", "5", ""]
    assert len(parse(spark, *bad, envelope("c", None, JOHN, 1))) == 1
    kept = cdc.parse_changes(messages(spark, *bad, None), keep_corrupt=True).collect()
    assert [r.error_type for r in sorted(kept, key=lambda r: r.offset)] == ["CorruptRecord"] * 5 + [None]


def test_current_state_follows_the_log_not_arrival(spark):
    log = [
        envelope("u", JOHN, JANE, 20),
        envelope("c", None, JOHN, 10),
        envelope("c", None, {**JOHN, "id": 2}, 11),
        envelope("d", {**JOHN, "id": 2}, None, 30),
        None,
        envelope("c", None, {**JOHN, "id": 3}, 40),
        envelope("d", {**JOHN, "id": 3}, None, 41),
        envelope("c", None, {**JANE, "id": 3}, 42),
    ]
    state = cdc.current_state(cdc.parse_changes(messages(spark, *log)), CUSTOMER_ROW, ["id"])
    assert {(r.id, r.name, r.lsn) for r in state.collect()} == {(1, "Jane", 20), (3, "Jane", 42)}


def test_typed_parse_gives_the_same_state(spark):
    log = [envelope("c", None, JOHN, 1), envelope("u", JOHN, JANE, 2), envelope("d", JANE, None, 3), None]
    log += [envelope("r", None, {**JOHN, "id": 5}, 4), {"op": "c"}, "{bad"]
    typed = cdc.parse_changes(messages(spark, *log), CUSTOMER_ROW)
    text = cdc.parse_changes(messages(spark, *log))
    assert typed.count() == text.count() == 6
    assert sorted(r.op_name for r in typed.collect()) == sorted(r.op_name for r in text.collect())
    for changes in (typed, text):
        state = cdc.current_state(changes.filter("data IS NOT NULL AND source IS NOT NULL"), CUSTOMER_ROW, ["id"])
        assert [(r.id, r.name) for r in state.collect()] == [(5, "John")]


def test_merging_the_same_changes_twice_changes_nothing(spark):
    first = cdc.parse_changes(messages(spark, envelope("c", None, JOHN, 1)))
    second = cdc.parse_changes(messages(spark, envelope("u", JOHN, JANE, 2), envelope("c", None, {**JOHN, "id": 2}, 3)))
    state = cdc.last_changes(first, CUSTOMER_ROW, ["id"])
    once = cdc.merge_state(state, second, CUSTOMER_ROW, ["id"])
    twice = cdc.merge_state(once, second, CUSTOMER_ROW, ["id"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {(r.id, r.name) for r in cdc.live_rows(twice).collect()} == {(1, "Jane"), (2, "John")}


def test_changed_columns(spark):
    extra = {"id": 1, "name": "Jane", "phone": None}
    rows = cdc.changed_columns(
        cdc.parse_changes(messages(spark, envelope("u", JOHN, JANE, 1), envelope("u", JOHN, JOHN, 2), envelope("u", JOHN, extra, 3)))
    ).orderBy("offset")
    assert [r.changed_columns for r in rows.collect()] == [["email", "name"], [], ["email", "name"]]


def test_audit_and_counts(spark):
    changes = cdc.parse_changes(messages(spark, envelope("c", None, JOHN, 1), envelope("u", JOHN, JANE, 2), None))
    assert cdc.audit_rows(changes).count() == 3
    assert {(r.op_name, r["count"]) for r in cdc.operation_counts(changes).collect()} == {
        ("INSERT", 1),
        ("UPDATE", 1),
        ("TOMBSTONE", 1),
    }


def test_router_gives_each_table_its_changes(spark):
    order = {"id": 9, "customer_id": 1, "amount_cents": 5000, "status": "pending"}
    both = messages(spark, envelope("c", None, JOHN, 1)).unionByName(
        messages(spark, envelope("c", None, order, 2), topic="cdc.public.orders")
    ).unionByName(messages(spark, envelope("c", None, order, 3), topic="cdc.public.other"))
    seen = {}

    def keep(name):
        return lambda changes, batch_id: seen.setdefault(name, [r.data for r in changes.collect()])

    router = cdc.ChangeRouter().add_handler("customers", keep("customers")).add_handler("orders", keep("orders"))
    router.run(both)
    assert set(seen) == {"customers", "orders"}
    assert json.loads(seen["orders"][0])["customer_id"] == 1


def test_a_failing_handler_ends_the_batch(spark):
    def fail(changes, batch_id):
        raise RuntimeError("boom")

    with pytest.raises(RuntimeError):
        cdc.ChangeRouter().add_handler("customers", fail).run(messages(spark, envelope("c", None, JOHN, 1)))


def test_latest_row_is_reduced_before_the_shuffle(spark):
    state = cdc.current_state(cdc.parse_changes(messages(spark, envelope("c", None, JOHN, 1))), CUSTOMER_ROW, ["id"])
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert plan.count("Generate explode(array(from_json") == 2
