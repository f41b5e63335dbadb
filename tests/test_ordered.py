from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.operators.alerts import change_since_previous, cooldown, fill_absent_windows
from tideline.operators.late import flag_late
from tideline.operators.ranking import deduplicate
from tideline.operators.joins import first_follow_up, without_follow_up
from tideline.operators.scan import carry_forward, in_runs
from tideline.operators.sessions import funnel, sessionize

T0 = datetime(2024, 3, 1)
RELAXED = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
MARKS = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 4000)), min_size=1, max_size=60)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def frame(spark, marks, schema="id long, user string, ts timestamp_ntz"):
    return spark.createDataFrame([(i, u, at(s)) for i, (u, s) in enumerate(marks)], schema)


@settings(RELAXED, max_examples=3)
@given(marks=MARKS)
def test_cooldown_is_greedy(spark, marks):
    marks = sorted(set(marks), key=lambda m: m[1])
    expected, last = set(), {}
    for user, s in marks:
        if user not in last or s - last[user] >= 100:
            expected.add((user, at(s)))
            last[user] = s
    df = frame(spark, marks).withColumnsRenamed({"user": "alert", "ts": "alert_time"})
    for small in (0, 1000):
        got = cooldown(df, "100 seconds", ["id"], small).collect()
        assert {(r.alert, r.alert_time) for r in got} == expected
        assert len(got) == len(expected)


def test_cooldown_ties_keep_the_first(spark):
    df = frame(spark, [("a", 5), ("a", 5), ("a", 6)]).withColumnsRenamed({"user": "alert", "ts": "alert_time"})
    nulls = spark.createDataFrame([(7, None, at(0)), (8, "a", None)], df.schema)
    for small in (0, 1000):
        assert [r.id for r in cooldown(df.union(nulls), "1 minute", ["id"], small).collect()] == [0]
        assert cooldown(df.limit(0), "1 minute", ["id"], small).count() == 0


def test_cooldown_in_few_dense_hours_has_no_large_task(spark):
    """Hits every millisecond of one alert, with gaps: against the chain followed one by one."""
    df = spark.range(40_000).select(F.col("id"), F.lit("a").alias("alert"), F.expr("timestamp_millis(id * 7 + (id div 9000) * 5000000)").alias("alert_time"))
    fired = cooldown(df, "1 second", ["id"], small=0)
    assert "Groups" not in fired._jdf.queryExecution().toString()
    expected, last = [], None
    for i in range(40_000):
        t = i * 7 + (i // 9000) * 5_000_000
        if last is None or t - last >= 1000:
            expected.append(i)
            last = t
    assert sorted(r.id for r in fired.collect()) == expected


def carried(rows, runs, spark):
    df = spark.createDataFrame(rows, "k string, t long, v long")
    got = carry_forward(df, ["k"], [F.asc("t"), F.asc("v")], "v", "last", runs).collect()
    return sorted((str(r.k), r.t, r.last) for r in got)


def test_values_carry_over_runs_and_null_keys(spark):
    rows = [(k, t, t if t % 50 == 3 else None) for k in ("a", "b", None) for t in range(300 if k == "a" else 7)]
    expected = []
    for k in ("a", "b", None):
        last = None
        for _, t, v in [r for r in rows if r[0] == k]:
            last = v if v is not None else last
            expected.append((str(k), t, last))
    for runs in (1, 4, 40, None):
        assert carried(rows, runs, spark) == sorted(expected)


def test_a_hot_key_fills_runs_of_equal_size(spark):
    rows = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"), F.col("id").alias("v"))
    sizes = [r["count"] for r in in_runs(rows, ["k"], [F.asc("t")], 12).groupBy("run__").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 3 * sorted(sizes)[6]


@RELAXED
@given(marks=MARKS)
def test_sessions_follow_the_native_definition(spark, marks):
    df = frame(spark, marks)
    native = df.groupBy("user", F.session_window("ts", "2 minutes").alias("s")).agg(F.count("*").alias("events"))
    native = native.select("user", "s.start", "s.end", "events")
    ours = sessionize(df, ["user"], "ts", "2 minutes")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, native.collect()))


def test_session_gap_boundary(spark):
    df = frame(spark, [("a", 0), ("a", 120), ("b", 0), ("b", 121)])
    native = df.groupBy("user", F.session_window("ts", "2 minutes")).count().groupBy("user").count()
    ours = sessionize(df, ["user"], "ts", "2 minutes").groupBy("user").count()
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, native.collect()))


@RELAXED
@given(first=MARKS, second=MARKS)
def test_follow_ups(spark, first, second):
    left, right = frame(spark, first), frame(spark, second)
    best = {}
    for i, (user, s) in enumerate(first):
        later = [(t, j) for j, (u, t) in enumerate(second) if u == user and s <= t <= s + 300]
        best[i] = min(later)[1] if later else None
    matched = first_follow_up(left, right, "user", "ts", "5 minutes", ["id"], runs=5).collect()
    assert {r.id: r.match.id if r.match else None for r in matched} == best
    assert len(matched) == len(first)
    alone = without_follow_up(left, right, "user", "ts", "5 minutes").collect()
    assert sorted(r.id for r in alone) == sorted(i for i, m in best.items() if m is None)


@RELAXED
@given(times=st.lists(st.tuples(st.integers(0, 9), st.integers(0, 3000)), min_size=1, max_size=60))
def test_late_rows(spark, times):
    rows = [(i, b, at(s)) for i, (b, s) in enumerate(times)]
    df = spark.createDataFrame(rows, "id long, batch long, ts timestamp_ntz")
    expected = set()
    for i, (batch, s) in enumerate(times):
        earlier = [t for b, t in times if b < batch]
        if earlier and s < max(earlier) - 600:
            expected.add(i)
    got = flag_late(df, "batch", "ts", "10 minutes").collect()
    assert {r.id for r in got if r.is_late} == expected
    assert len(got) == len(times)


def test_lag_across_chunks_and_null_keys(spark):
    rows = [(None, at(0), 1), (None, at(86400 * 30), 4), ("x", at(60), 7), ("x", at(120), 5), ("x", at(86400 * 9), 6)]
    df = spark.createDataFrame(rows, "k string, window_start timestamp_ntz, total long")
    got = {(r.k, r.total): (r.previous, r.delta) for r in change_since_previous(df, ["k"], "total").collect()}
    assert got == {
        (None, 1): (None, None),
        (None, 4): (1, 3),
        ("x", 7): (None, None),
        ("x", 5): (7, -2),
        ("x", 6): (5, 1),
    }


def test_absent_windows(spark):
    rows = [(None, at(0), at(60), 3), (None, at(180), at(240), 1), ("x", at(60), at(120), 2)]
    df = spark.createDataFrame(rows, "k string, window_start timestamp_ntz, window_end timestamp_ntz, count long")
    for chunk in (1, 2, 4096):
        got = fill_absent_windows(df, ["k"], "count", "1 minute", chunk=chunk).collect()
        assert sorted(((r.k or ""), r.window_start, r["count"]) for r in got) == [
            ("", at(0), 3),
            ("", at(60), 0),
            ("", at(120), 0),
            ("", at(180), 1),
            ("x", at(60), 2),
        ]
    silent = fill_absent_windows(df, ["k"], "count", "1 minute", until=F.lit(at(300)).cast("timestamp_ntz"))
    assert sorted(r["n"] for r in silent.groupBy("k").agg(F.count("*").alias("n")).collect()) == [5, 6]
    total = df.groupBy("window_start", "window_end").agg(F.sum("count").alias("count"))
    assert fill_absent_windows(total, [], "count", "1 minute").count() == 4


def test_funnel_reads_the_events_once_per_step(spark, folder):
    spark.createDataFrame([("a", "view", at(0))], "user string, kind string, ts timestamp_ntz").write.parquet(folder)
    events = spark.read.parquet(folder)
    for steps in (["view", "cart", "buy"], ["view", "cart", "pay", "buy", "rate"]):
        plan = funnel(events, "user", "ts", "kind", steps)._jdf.queryExecution().optimizedPlan().toString()
        # All earlier steps are in stored tables; the last one reads the events once and those twice.
        assert plan.count("Relation ") == 3


def test_funnel_needs_the_order(spark):
    marks = [("a", "view", 0), ("a", "cart", 10), ("a", "buy", 20), ("b", "cart", 0), ("b", "view", 5), ("c", "buy", 1)]
    df = spark.createDataFrame([(u, k, at(s)) for u, k, s in marks], "user string, kind string, ts timestamp_ntz")
    got = {r.user: r.stage for r in funnel(df, "user", "ts", "kind", ["view", "cart", "buy"]).collect()}
    assert got == {"a": 3, "b": 1}


def test_late_rows_read_the_events_twice(spark, folder):
    spark.createDataFrame([(1, 0, at(0)), (2, 1, at(60))], "id long, batch long, ts timestamp_ntz").write.parquet(folder)
    plan = flag_late(spark.read.parquet(folder), "batch", "ts", "10 seconds")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [id") == 1  # the other read is in the stored maxima


def test_duplicates_that_differ_leave_the_first(spark):
    rows = [(1, at(5), "b"), (1, at(5), "a"), (1, at(9), "0"), (2, at(1), None)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, v string").repartition(4)
    assert sorted((r.id, r.v) for r in deduplicate(df, ["id"]).collect()) == [(1, "a"), (2, None)]
    assert sorted((r.id, r.v) for r in deduplicate(df, ["id"], [F.desc("ts")]).collect()) == [(1, "0"), (2, None)]
