import json

import pytest
from pyspark.sql import functions as F

from tideline.operators import dlq
from tideline.sinks.writers import dead_letter_writer
from tideline.sources.decode import checked, decode_json, decode_types, encode_json
from tideline.sources.messages import MESSAGE_SCHEMA, dead_letter_files
from tideline.plans.domains import ECOMMERCE
from tideline.plans.spec import Domain, EventType

GOOD = {"event_id": "e1", "timestamp": 1700000000000, "user_id": "u1", "device_type": "mobile", "platform": "web", "search_query": "sale"}


def messages(spark, *pairs):
    rows = [
        (None, (json.dumps(v) if isinstance(v, dict) else v).encode() if v is not None else None, t, 0, i, None)
        for i, (t, v) in enumerate(pairs)
    ]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def failed(spark, *events):
    rows = [("events.search", json.dumps(e), "ValueError", "no good") for e in events]
    return spark.createDataFrame(rows, "topic string, value string, error_type string, error_message string")


def test_defaults_and_id(spark):
    rows = dlq.dead_letters(failed(spark, GOOD, {"x": 1}, {"event_id": None}), failed_at=F.lit(17)).collect()
    assert rows[0].asDict() == {
        "original_topic": "events.search",
        "original_event": json.dumps(GOOD),
        "error_message": "no good",
        "error_type": "ValueError",
        "timestamp": 17,
        "retry_count": 0,
        "max_retries": 3,
        "event_id": "e1",
    }
    assert [r.event_id for r in rows[1:]] == ["dlq-17", "dlq-17"]


def test_default_time_is_now_in_millis(spark):
    row = dlq.dead_letters(failed(spark, {"x": 1})).first()
    assert row.timestamp > 1_700_000_000_000
    assert row.event_id == f"dlq-{row.timestamp}"


def test_retry_boundary_and_increment(spark):
    for count, expected in [(2, True), (3, False)]:
        letters = dlq.dead_letters(failed(spark, GOOD), retry_count=count)
        assert letters.select(dlq.can_retry()).first()[0] is expected
    letters = dlq.dead_letters(failed(spark, GOOD), failed_at=F.lit(5), retry_count=1)
    before, after = letters.first().asDict(), dlq.increment_retry(letters).first().asDict()
    assert after.pop("retry_count") == 2 and before.pop("retry_count") == 1
    assert after == before


def test_round_trip(spark):
    letters = dlq.dead_letters(failed(spark, GOOD, {"n": [1, {"a": None}]}), failed_at=F.lit(5), retry_count=1)
    sent = dlq.to_messages(letters)
    bodies = [json.loads(bytes(r.value)) for r in sent.collect()]
    assert bodies[0]["original_event"] == GOOD
    assert {r.topic for r in sent.collect()} == {"events.dlq"}
    assert [bytes(r.key).decode() for r in sent.collect()] == ["e1", "dlq-5"]
    back = dlq.from_messages(sent)
    assert [json.loads(r.original_event) for r in back.collect()] == [GOOD, {"n": [1, {"a": None}]}]
    kept = [n for n in dlq.ENVELOPE.names if n != "original_event"]
    assert sorted(back.select(kept).collect()) == sorted(letters.select(kept).collect())


def test_text_that_is_no_json_survives_the_round_trip(spark):
    rows = spark.createDataFrame([("t", "{bad", "E", "m")], "topic string, value string, error_type string, error_message string")
    letters = dlq.dead_letters(rows, failed_at=F.lit(5))
    assert dlq.from_messages(dlq.to_messages(letters)).first().original_event == "{bad"


def test_restore_skips_foreign_messages_and_fills_defaults(spark):
    base = {"original_topic": "t", "original_event": {"event_id": "x"}, "error_message": "m", "error_type": "E"}
    got = dlq.from_messages(
        messages(
            spark,
            ("events.dlq", base),
            ("events.dlq", {**base, "surprise": 1}),
            ("events.dlq", "{bad"),
            ("events.dlq", {"original_topic": "t"}),
            ("events.dlq", None),
        )
    ).collect()
    assert [(r.event_id, r.retry_count, r.max_retries) for r in got] == [("x", 0, 3)]


def test_replay(spark):
    letters = dlq.dead_letters(failed(spark, GOOD, {"event_id": "old"}), failed_at=F.lit(5))
    letters = letters.withColumn("retry_count", F.when(F.col("event_id") == "old", 3).otherwise(0))
    again, archive = dlq.replay(letters)
    [row] = again.collect()
    assert json.loads(bytes(row.value)) == GOOD and row.topic == "events.search" and row.retry_count == 1
    assert [r.event_id for r in archive.collect()] == ["old"]


def test_checked_orders_errors(spark):
    lacking = {k: v for k, v in GOOD.items() if k not in ("user_id", "platform")}
    rows = checked(
        messages(
            spark,
            ("events.search", GOOD),
            ("events.mystery", GOOD),
            ("events.search", "{bad"),
            ("events.search", None),
            ("events.search", lacking),
            ("events.search", {**GOOD, "search_query": None}),
        ),
        ECOMMERCE,
    ).orderBy("offset")
    assert [r.error_type for r in rows.collect()] == [
        None,
        "UnknownEventType",
        "CorruptRecord",
        "CorruptRecord",
        "MissingField",
        None,
    ]
    assert rows.collect()[4].error_message == "Missing required fields: user_id, platform"
    good, bad = dlq.split(rows)
    assert (good.count(), bad.count()) == (2, 4)
    assert "error_type" not in good.columns


def test_payload_is_parsed_once(spark):
    good, _ = dlq.split(checked(messages(spark, ("events.search", GOOD)), ECOMMERCE))
    plan = good._jdf.queryExecution().executedPlan().toString()
    # A branch for each declared type, of which a message takes one.
    assert plan.count("from_json(") == len(ECOMMERCE.event_types)


def test_decode_encode_round_trip(spark):
    search = ECOMMERCE.event_type("search")
    decoded = decode_json(messages(spark, ("events.search", GOOD), ("events.search", "{bad"), ("events.purchase", GOOD)), search, "user_id")
    [row] = decoded.collect()
    assert row.event_type == "search" and row.search_query == "sale" and row.results_count is None
    assert row.event_time.timestamp() * 1000 == GOOD["timestamp"]
    [sent] = encode_json(decoded, search, "user_id").collect()
    assert bytes(sent.key) == b"u1" and sent.topic == "events.search"
    assert json.loads(bytes(sent.value)) == GOOD


def test_file_backend_keeps_every_letter(spark, folder):
    write = dead_letter_writer("file", folder)
    letters = dlq.dead_letters(failed(spark, GOOD, GOOD, GOOD), failed_at=F.lit(5))
    write(letters)
    write(letters)
    back = dlq.from_files(spark.read.schema(dlq.ENVELOPE).json(folder))
    assert back.count() == 6
    assert json.loads(back.first().original_event) == GOOD


def test_one_object_per_file(spark, tmp_path):
    letter = {"original_topic": "t", "original_event": GOOD, "error_message": "m", "error_type": "E", "timestamp": 5, "event_id": "e1"}
    for i in range(2):
        (tmp_path / f"e{i}.json").write_text(json.dumps(letter, indent=2))
    got = dead_letter_files(spark, str(tmp_path), one_per_file=True).collect()
    assert [(r.event_id, r.timestamp, r.max_retries) for r in got] == [("e1", 5, 3)] * 2
    assert json.loads(got[0].original_event) == GOOD


def test_unknown_backend():
    with pytest.raises(ValueError):
        dead_letter_writer("carrier pigeon", "x")


def test_report_and_callback(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "id long, kind long")

    def handle(row):
        if row["kind"] == 0:
            raise KeyError("zero")

    out = dlq.guarded(df, handle, ["id", "kind"])
    assert out.filter("error_type = 'KeyError'").count() == 3
    bad = out.filter("error_type is not null").select(
        F.lit("t").alias("topic"), F.lit("{}").alias("value"), "error_type", "error_message"
    )
    [row] = dlq.report(dlq.dead_letters(bad)).collect()
    assert (row.original_topic, row.error_type, row.failures, row.max_retry_count) == ("t", "KeyError", 3, 0)


def test_mistyped_values_and_missing_times_are_dead_letters(spark):
    flaws = [
        ({**GOOD, "results_count": "many"}, "MistypedField"),
        ({k: v for k, v in GOOD.items() if k != "timestamp"}, "MissingField"),
        ({**GOOD, "timestamp": "noon"}, "MistypedField"),
    ]
    rows = checked(messages(spark, *[("events.search", event) for event, _ in flaws], ("events.search", GOOD)), ECOMMERCE)
    good, bad = dlq.split(rows)
    assert [r.error_type for r in bad.orderBy("offset").collect()] == [kind for _, kind in flaws]
    # Whatever is good is decoded whole.
    assert decode_json(good, ECOMMERCE.event_type("search"), "user_id").count() == good.count() == 1


def test_replayed_messages_say_how_often(spark):
    sent = messages(spark, ("events.search", "{bad"))
    for expected in range(4):
        _, bad = dlq.split(checked(sent, ECOMMERCE))
        letters = dlq.dead_letters(bad, failed_at=F.lit(5), retry_count=dlq.retries_so_far(bad))
        row = letters.first()
        assert row.retry_count == expected
        again, archive = dlq.replay(letters)
        assert (again.count(), archive.count()) == ((1, 0) if expected < 3 else (0, 1))
        first = row.event_id if expected == 0 else first
        assert row.event_id == first and first.startswith("dlq-events.search-")
        sent = again.select("key", "value", "topic", "headers")


def test_a_field_counts_only_for_the_types_that_declare_it(spark):
    first = EventType("first", attributes=("x",))
    second = EventType("second", metrics=("x",))
    third = EventType("third")
    domain = Domain("d", "user_id", (first, second, third))
    own = '{"event_id": "1", "timestamp": 5, "user_id": "u", "x": %s}'
    sent = [("events.first", own % '"abc"'), ("events.second", own % '"abc"'), ("events.second", own % "1.5"), ("events.third", own % '"abc"')]
    rows = checked(messages(spark, *sent), domain)
    assert [r.error_type for r in rows.orderBy("offset").collect()] == [None, "MistypedField", None, None]
    good, _ = dlq.split(rows)
    decoded = {t.name: decode_json(good, t, "user_id").count() for t in (first, second, third)}
    assert decoded == {"first": 1, "second": 1, "third": 1}
    both = decode_types(good, domain, ["second", "third"]).orderBy("event_type").collect()
    assert [(r.event_type, r.x) for r in both] == [("second", 1.5), ("third", None)]
    assert decode_types(good, domain, ["first", "second", "third"], ["user_id"]).count() == 3
