from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.functions.predicates import filter_column
from tideline.functions.times import instant_to_wall, wall_micros, wall_to_instant
from tideline.operators.aggregate import aggregate, flatten_window
from tideline.plans.domains import ECOMMERCE
from tideline.plans.jobs import AggregationJob
from tideline.plans.spec import AggregationSpec, Condition, SpecError, WindowSpec
from tideline.sources.tables import table

T0 = datetime(2024, 3, 1, 10, 0)


def rows(spark):
    data = [
        (T0 + timedelta(seconds=s), user, device, amount)
        for s, user, device, amount in [
            (0, "a", "mobile", 100),
            (59, "b", "mobile", 250),
            (60, "a", "desktop", None),
            (125, None, "mobile", 50),
            (299, "a", None, 75),
        ]
    ]
    schema = "ts timestamp_ntz, user_id string, device_type string, total_amount long"
    return spark.createDataFrame(data, schema)


def run(df, kind, window, **spec):
    options = {k: spec.pop(k) for k in ("panes", "approximate", "try_sum") if k in spec}
    result = aggregate(df, AggregationSpec("q", kind, window, **spec), time="ts", entity_key="user_id", **options)
    return flatten_window(result)


def test_output_shape(spark):
    minute = WindowSpec("tumbling", "1 minute")
    result = aggregate(rows(spark), AggregationSpec("q", "count", minute, group_by=("dimensions.device_type",)), time="ts")
    assert result.columns == ["window", "device_type", "count"]
    flat = flatten_window(result).orderBy("window_start", "device_type").collect()
    assert [(r.window_start, r.device_type, r["count"]) for r in flat] == [
        (T0, "mobile", 2),
        (T0 + timedelta(minutes=1), "desktop", 1),
        (T0 + timedelta(minutes=2), "mobile", 1),
        (T0 + timedelta(minutes=4), None, 1),
    ]
    assert all(r.window_end - r.window_start == timedelta(minutes=1) for r in flat)


def test_nulls(spark):
    hour = WindowSpec("tumbling", "1 hour")
    assert run(rows(spark), "count_distinct", hour, field="entity_id").first()["unique_count"] == 2
    assert run(rows(spark), "sum", hour, field="metrics.total_amount").first()["total"] == 475
    assert run(rows(spark), "avg", hour, field="total_amount").first()["average"] == 118.75


@pytest.mark.parametrize("size,slide", [("5 minutes", "1 minute"), ("5 minutes", "2 minutes"), ("10 minutes", "3 minutes")])
@pytest.mark.parametrize("kind,field", [("count", None), ("sum", "cents"), ("avg", "cents"), ("count_distinct", "user_id")])
def test_panes_equal_direct(spark, small, size, slide, kind, field):
    df = table(spark, small, "events").withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    window = WindowSpec("sliding", size, slide)
    paned = run(df, kind, window, field=field, group_by=("event_type",), panes=True)
    direct = run(df, kind, window, field=field, group_by=("event_type",), panes=False)
    assert paned.count() == direct.count() > 0
    assert paned.exceptAll(direct).isEmpty()


def test_sliding_event_lands_in_every_covering_window(spark):
    one = rows(spark).limit(1)
    starts = [r.window_start for r in run(one, "count", WindowSpec("sliding", "5 minutes", "1 minute")).collect()]
    assert sorted(starts) == [T0 - timedelta(minutes=m) for m in (4, 3, 2, 1, 0)]


def test_filters(spark):
    df = rows(spark)
    hour = WindowSpec("tumbling", "1 hour")
    text = "dimensions.device_type = 'mobile' AND metrics.total_amount > 60"
    assert run(df, "count", hour, where=text).first()["count"] == 2
    assert run(df, "count", hour, where=Condition("lt", 100, "metrics.total_amount")).first()["count"] == 2
    assert run(df, "count", hour, where=Condition("eq", "desktop", "device_type")).first()["count"] == 1
    # Quoted text is not a path.
    assert df.filter(filter_column("device_type = 'metrics.x'", lambda p: p)).count() == 0


def test_unknown_field(spark):
    with pytest.raises(SpecError):
        run(rows(spark), "sum", WindowSpec("tumbling", "1 hour"), field="metrics.nothing")


def test_sum_overflow(spark):
    big = spark.createDataFrame([(T0, 2**62), (T0, 2**62)], "ts timestamp_ntz, amount long")
    hour = WindowSpec("tumbling", "1 hour")
    with pytest.raises(Exception, match="OVERFLOW"):
        run(big, "sum", hour, field="amount").collect()
    assert run(big, "sum", hour, field="amount", try_sum=True).first()["total"] is None


def test_approximate_distinct(spark, small):
    df = table(spark, small, "events")
    window = WindowSpec("tumbling", "30 days")
    exact = run(df, "count_distinct", window, field="event_id").first()["unique_count"]
    near = run(df, "count_distinct", window, field="event_id", approximate=0.02).first()["unique_count"]
    assert abs(near - exact) / exact < 0.1


def test_filter_and_columns_reach_the_scan(spark, small):
    spec = AggregationSpec("q", "count", WindowSpec("tumbling", "1 hour"), where="event_type = 'purchase'", group_by=("user_id",))
    plan = aggregate(table(spark, small, "events"), spec, time="ts")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_custom_step_between_decode_and_aggregate(spark, small):
    from tideline.workloads.inputs import domain_messages, events

    messages = domain_messages(events(spark, small), ECOMMERCE)
    plain = AggregationJob(ECOMMERCE).result(messages, "events_per_minute").agg(F.sum("count")).first()[0]
    mobile = AggregationJob(ECOMMERCE, step=lambda df: df.filter("device_type = 'mobile'"))
    only = mobile.result(messages, "events_per_minute")
    assert {r.device_type for r in only.select("device_type").distinct().collect()} == {"mobile"}
    assert 0 < only.agg(F.sum("count")).first()[0] < plain
    assert plain == events(spark, small).count()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_wall_time_does_not_depend_on_the_session_zone(spark, zone):
    walls = [datetime(2024, 1, 1, 0, 9, 58, 778549), datetime(2024, 3, 10, 2, 30), datetime(2024, 7, 1, 12, 0, 0, 1)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(w,) for w in walls], "ts timestamp_ntz")
        out = df.withColumn("us", wall_micros("ts")).withColumn("i", wall_to_instant("ts"))
        out = out.withColumn("back", instant_to_wall("i")).collect()
        for row, wall in zip(out, walls):
            assert row.us == (wall - datetime(1970, 1, 1)) // timedelta(microseconds=1)
            assert row.back == wall
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_average_of_large_numbers_is_the_same_with_panes(spark):
    rows = [(datetime(2024, 1, 1, 0, m), 2**63 - 1) for m in range(5)]
    df = spark.createDataFrame(rows, "at timestamp_ntz, x long")
    spec = AggregationSpec("q", "avg", WindowSpec("sliding", "5 minutes", "1 minute"), field="x")
    plain, paned = (
        sorted(map(str, flatten_window(aggregate(df, spec, time="at", panes=panes)).collect())) for panes in (False, True)
    )
    assert plain == paned and len(plain) == 9


@pytest.mark.parametrize("panes", [True, False])
@pytest.mark.parametrize("amounts, total", [((2**63 - 1, 1, 5), None), ((2**63 - 1, 1, -5), 2**63 - 5), ((-(2**63), None, 0), -(2**63)), ((None, None, None), None)])
def test_try_sum_is_null_only_for_totals_out_of_range(spark, panes, amounts, total):
    data = [(T0, amounts[0]), (T0 + timedelta(seconds=5), amounts[1]), (T0 + timedelta(minutes=1), amounts[2])]
    df = spark.createDataFrame(data, "ts timestamp_ntz, amount long")
    got = run(df, "sum", WindowSpec("sliding", "5 minutes", "1 minute"), field="amount", try_sum=True, panes=panes)
    both = got.filter(F.col("window_start") == T0).first()
    assert both["total"] == total and got.schema["total"].dataType.typeName() == "long"


def test_try_sum_of_decimals(spark):
    big = "9" * 38
    df = spark.createDataFrame([(T0, big), (T0, big), (T0 + timedelta(minutes=1), "5")], "ts timestamp_ntz, text string")
    df = df.withColumn("amount", F.col("text").cast("decimal(38,0)"))
    got = run(df, "sum", WindowSpec("sliding", "5 minutes", "1 minute"), field="amount", try_sum=True)
    assert got.filter(F.col("window_start") == T0).first()["total"] is None


@pytest.mark.parametrize("ntz", [True, False])
def test_distinct_intervals_with_nulls_gaps_and_small_chunks(spark, monkeypatch, ntz):
    from tideline.operators import aggregate as module

    monkeypatch.setattr(module, "_CHUNK", 3)
    data = []
    for i in range(400):
        seconds = (i * 7919) % 9000 if i % 3 else i  # dense at first, then sparse
        value = None if i % 11 == 0 else i % 4
        data.append((T0 + timedelta(seconds=seconds), value, "g" if i % 5 else None))
    data += [(T0 + timedelta(days=9), None, "h"), (T0 + timedelta(days=9, seconds=1), None, "h"), (None, 1, "h")]
    df = spark.createDataFrame(data, "ts timestamp_ntz, user_id int, device_type string")
    df = df if ntz else df.withColumn("ts", F.col("ts").cast("timestamp"))
    for size, slide in [("5 minutes", "1 minute"), ("10 minutes", "3 minutes"), ("2 minutes", "90 seconds")]:
        for group in ((), ("device_type",)):
            spec = {"field": "user_id", "group_by": group}
            window = WindowSpec("sliding", size, slide)
            plain, own = (run(df, "count_distinct", window, panes=p, **spec) for p in (False, True))
            assert own.schema.simpleString() == plain.schema.simpleString()
            assert sorted(map(str, own.collect())) == sorted(map(str, plain.collect()))


def test_a_value_sends_two_rows_for_each_interval(spark):
    """Four hours of one value every second, in windows of an hour by the minute."""
    df = spark.range(4 * 3600).select(F.expr("timestamp_seconds(id)").alias("ts"), F.lit(1).alias("user_id"))
    window = WindowSpec("sliding", "1 hour", "1 minute")
    spec = AggregationSpec("q", "count_distinct", window, field="user_id")
    rows = aggregate(df, spec, time="ts", panes=True)
    assert rows.count() == 4 * 60 + 59
    assert rows.agg(F.min("unique_count"), F.max("unique_count")).first() == (1, 1)
