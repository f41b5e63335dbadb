import glob
import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.functions.times import instant_to_wall
from tideline.operators.aggregate import aggregate, flatten_window
from tideline.operators.joins import without_follow_up_stream
from tideline.operators.late import flag_late
from tideline.operators.ranking import deduplicate
from tideline.plans.domains import ECOMMERCE
from tideline.plans.jobs import AggregationJob
from tideline.plans.spec import AggregationSpec, WindowSpec
from tideline.session import shared_dir
from tideline.sinks.writers import UpsertTable, batch_folder, fan_out
from tideline.sources.messages import MESSAGE_SCHEMA, file_backfill, file_stream, topic_directories
from tideline.sources.tables import table
from tideline.streaming.progress import ProgressLog, observe_quality, progress_row
from tideline.streaming.queries import StreamRunner
from tideline.streaming.routing import CooldownSink, LateRouter
from tideline.workloads import QUERIES, streams
from tideline.workloads.inputs import domain_messages, events

T0 = datetime(2024, 3, 1)


def write_files(df, path, order, n=4):
    """``n`` files read one per micro-batch, oldest first."""
    for i in range(n):
        df.filter(F.pmod(order, F.lit(n)) == i).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)


def in_thirds(spark, small, folder):
    """The events table as three consecutive files, ts as an instant."""
    df = table(spark, small, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    size = df.count() // 3 + 1
    write_files(df, folder, F.expr(f"event_id div {size}"), 3)
    return df


HOURLY = AggregationSpec("q", "count", WindowSpec("tumbling", "1 hour"), group_by=("event_type",))
KEYS = ["window_start", "window_end", "event_type"]


def test_append_stream_equals_batch_up_to_the_watermark(spark, small, folder):
    df = in_thirds(spark, small, f"{folder}/in")
    stream = file_stream(spark, f"{folder}/in", df.schema, max_files=1).withWatermark("ts", "10 minutes")
    runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
    query = runner.files(flatten_window(aggregate(stream, HOURLY, time="ts")), f"{folder}/out", "q")
    runner.await_all()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    closed = df.agg(F.max("ts") - F.expr("interval 10 minutes")).first()[0]
    batch = flatten_window(aggregate(df, HOURLY, time="ts")).filter(F.col("window_end") <= F.lit(closed).cast("timestamp_ntz"))
    got = spark.read.parquet(f"{folder}/out")
    assert got.count() == batch.count() > 0
    assert batch.exceptAll(got.select(batch.columns)).isEmpty()


@pytest.mark.parametrize("kind,field", [("count", None), ("count_distinct", "user_id"), ("sum", "cents"), ("avg", "cents")])
def test_update_stream_with_upsert_equals_batch(spark, small, folder, kind, field):
    df = in_thirds(spark, small, f"{folder}/in").withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    spec = AggregationSpec("q", kind, WindowSpec("sliding", "2 hours", "1 hour"), field=field, group_by=("event_type",))
    stream = file_stream(spark, f"{folder}/in", df.drop("cents").schema, max_files=1)
    stream = stream.withColumn("cents", F.round(F.col("value") * 100).cast("bigint")).withWatermark("ts", "10 minutes")
    sink = UpsertTable(f"{folder}/out", KEYS)
    runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
    runner.foreach_batch(flatten_window(aggregate(stream, spec, time="ts", output_mode="update")), sink, "q")
    runner.await_all()
    batch = flatten_window(aggregate(df, spec, time="ts"))
    got = sink.read(spark).select(batch.columns)
    assert got.count() == batch.count() < sink.versions(spark).count() + 1
    assert batch.exceptAll(got).isEmpty()


def test_watermark_on_the_windowed_column_evicts_state(spark, small, folder):
    df = in_thirds(spark, small, f"{folder}/in")
    stream = file_stream(spark, f"{folder}/in", df.schema, max_files=1).withWatermark("ts", "10 minutes")
    runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
    result = aggregate(stream, HOURLY, time="ts", output_mode="update")
    query = runner.foreach_batch(flatten_window(result), batch_folder(f"{folder}/out"), "q")
    runner.await_all()
    left = [op.numRowsTotal for op in query.recentProgress[-1].stateOperators]
    assert sum(left) <= 5


def test_restart_continues_from_the_checkpoint(spark, small, folder):
    df = table(spark, small, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    half = df.count() // 2
    df.filter(f"event_id < {half}").coalesce(1).write.parquet(f"{folder}/in")
    sink = UpsertTable(f"{folder}/out", KEYS)

    def run():
        stream = file_stream(spark, f"{folder}/in", df.schema).withWatermark("ts", "10 minutes")
        runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
        runner.foreach_batch(flatten_window(aggregate(stream, HOURLY, time="ts", output_mode="update")), sink, "q")
        runner.await_all()

    run()
    df.filter(f"event_id >= {half}").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    run()
    run()
    batch = flatten_window(aggregate(df, HOURLY, time="ts"))
    assert sorted(sink.read(spark).select(batch.columns).collect()) == sorted(batch.collect())


def test_declared_aggregation_from_messages(spark, small, folder):
    messages = domain_messages(events(spark, small), ECOMMERCE)
    messages.select(*MESSAGE_SCHEMA.names).repartition(2).write.parquet(f"{folder}/in")
    sink = UpsertTable(f"{folder}/out", ["window_start", "window_end"])
    job = AggregationJob(ECOMMERCE)
    runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
    stream = file_stream(spark, f"{folder}/in", max_files=1)
    job.start(stream, "active_users", runner, lambda batch, i: sink(flatten_window(batch), i))
    runner.await_all()
    batch = flatten_window(job.result(file_backfill(spark, f"{folder}/in"), "active_users"))
    assert sorted(sink.read(spark).select(batch.columns).collect()) == sorted(batch.collect())


def test_console_memory_and_stop(spark, small, folder):
    df = in_thirds(spark, small, f"{folder}/in")
    stream = file_stream(spark, f"{folder}/in", df.schema)
    runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
    shown = runner.console(stream.groupBy("event_type").count(), "shown")
    runner.memory(stream.groupBy("event_type").count(), "kept")
    runner.await_all()
    progress = next(p for p in shown.recentProgress if p.numInputRows)
    assert progress.numInputRows == df.count() and "Console" in progress.sink.description
    assert spark.table("kept").agg(F.sum("count")).first()[0] == df.count()
    spark.streams.resetTerminated()
    live = StreamRunner(spark, f"{folder}/ck2", trigger="1 second")
    query = live.foreach_batch(stream, lambda batch, i: None, "live", "append")
    assert spark.streams.active and live.await_any(timeout=1) is False
    live.stop()
    assert not query.isActive
    with pytest.raises(ValueError):
        runner.console(stream, "x", "sometimes")


def test_topic_from_directory(spark, folder):
    for topic in ("events.search", "events.purchase"):
        spark.createDataFrame([(None, b"{}", None, 0, 1, None)], MESSAGE_SCHEMA).write.parquet(f"{folder}/{topic}")
    found = topic_directories(file_stream(spark, f"{folder}/*"))
    runner = StreamRunner(spark, f"{folder}-ck", trigger=None)
    runner.memory(found.groupBy("topic").count(), "topics")
    runner.await_all()
    assert {r.topic for r in spark.table("topics").collect()} == {"events.search", "events.purchase"}


def test_late_router_matches_batch_and_survives_replay(spark, folder):
    rows = [(i, T0 + timedelta(minutes=m)) for i, m in enumerate([0, 5, 60, 58, 30, 90, 49, 85, 70, 200, 20, 189])]
    df = spark.createDataFrame(rows, "id long, ts timestamp")
    write_files(df, f"{folder}/in", F.expr("id div 3"), 4)
    router = LateRouter(f"{folder}/state", "ts", "10 minutes", batch_folder(f"{folder}/ok"), batch_folder(f"{folder}/late"))
    kept = {}

    def twice(batch, batch_id):
        router(batch, batch_id)
        router(batch, batch_id)
        kept[batch_id] = True

    runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
    runner.foreach_batch(file_stream(spark, f"{folder}/in", df.schema, max_files=1), twice, "late", "append")
    runner.await_all()
    expected = flag_late(df.withColumn("batch", F.expr("id div 3")), "batch", "ts", "10 minutes").filter("is_late")
    late = spark.read.parquet(f"{folder}/late")
    assert sorted(r.id for r in late.collect()) == sorted(r.id for r in expected.collect()) != []
    assert late.count() + spark.read.parquet(f"{folder}/ok").count() == len(rows)


def test_native_late_drop_is_counted(spark, folder):
    """Rows behind the watermark disappear once a later batch runs, and the progress says how many."""
    batches = [[0, 5], [120], [121], [1, 2], [130]]
    for i, minutes in enumerate(batches):
        spark.createDataFrame([(T0 + timedelta(minutes=m),) for m in minutes], "ts timestamp").coalesce(1).write.mode(
            "append"
        ).parquet(f"{folder}/in")
        time.sleep(0.02)
    schema = spark.read.parquet(f"{folder}/in").schema
    stream = file_stream(spark, f"{folder}/in", schema, max_files=1).withWatermark("ts", "10 minutes")
    spec = AggregationSpec("q", "count", WindowSpec("tumbling", "10 minutes"))
    runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
    sink = UpsertTable(f"{folder}/out", ["window_start", "window_end"])
    query = runner.foreach_batch(flatten_window(aggregate(stream, spec, time="ts", output_mode="update")), sink, "q")
    runner.await_all()
    # Spark drops after the map-side count: two late rows of one window are one dropped row.
    assert sum(progress_row(p)[-1] for p in query.recentProgress) == 1
    assert sink.read(spark).agg(F.sum("count")).first()[0] == 5


def test_stream_dedup_and_follow_up(spark, folder):
    rows = [(1, "a", 0), (1, "a", 0), (2, "b", 10), (3, "c", 20), (9, "z", 5000)]
    df = spark.createDataFrame([(i, u, T0 + timedelta(minutes=m)) for i, u, m in rows], "event_id long, user string, ts timestamp")
    write_files(df, f"{folder}/adds", F.col("event_id"), 2)
    buys = [("a", 30), ("b", 200), ("z", 6000), ("q", 7000)]
    buys = spark.createDataFrame([(u, T0 + timedelta(minutes=m)) for u, m in buys], "user string, ts timestamp")
    buys.coalesce(1).write.parquet(f"{folder}/buys")
    adds = deduplicate(file_stream(spark, f"{folder}/adds", df.schema).withWatermark("ts", "1 minute"), ["event_id"])
    runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
    runner.files(adds, f"{folder}/unique", "dedup")
    left = file_stream(spark, f"{folder}/adds", df.schema)
    right = file_stream(spark, f"{folder}/buys", buys.schema)
    runner.files(without_follow_up_stream(left, right, "user", "ts", "1 hour", "1 minute"), f"{folder}/alone", "alone")
    runner.await_all()
    assert sorted(r.event_id for r in spark.read.parquet(f"{folder}/unique").collect()) == [1, 2, 3, 9]
    alone = {r.event_id for r in spark.read.schema(df.schema).parquet(f"{folder}/alone").collect()}
    assert alone == {2, 3}


def test_stream_cooldown_keeps_state_between_batches(spark, folder):
    minutes = [0, 3, 9, 10, 11, 25, 30, 36]
    df = spark.createDataFrame([(i, "x", T0 + timedelta(minutes=m)) for i, m in enumerate(minutes)], "id long, alert string, alert_time timestamp")
    write_files(df, f"{folder}/in", F.expr("id div 2"), 4)
    sink = CooldownSink(f"{folder}/out", "10 minutes", ["id"])

    def twice(batch, batch_id):
        sink(batch, batch_id)
        sink(batch, batch_id)

    runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
    runner.foreach_batch(file_stream(spark, f"{folder}/in", df.schema, max_files=1), twice, "cool", "append")
    runner.await_all()
    got = sink.read(spark).orderBy("alert_time").collect()
    assert [(r.alert_time - T0).seconds // 60 for r in got] == [0, 10, 25, 36]


def test_fan_out_writes_both(spark, folder):
    df = spark.range(10)
    fan_out(batch_folder(f"{folder}/a"), batch_folder(f"{folder}/b"))(df, 3)
    for name in "ab":
        assert spark.read.parquet(f"{folder}/{name}").filter("batch_id = 3").count() == 10


def test_progress_table_and_quality(spark, small, folder):
    df = in_thirds(spark, small, f"{folder}/in")
    log = ProgressLog(spark, f"{folder}/progress", buffer=2)
    spark.streams.addListener(log)
    try:
        stream = file_stream(spark, f"{folder}/in", df.schema, max_files=1)
        runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
        seen = observe_quality(stream, "ts", F.col("event_type") == "error")
        query = runner.foreach_batch(seen, batch_folder(f"{folder}/out"), "watched", "append")
        runner.await_all()
        assert log.await_end("watched")
    finally:
        spark.streams.removeListener(log)
    rows = log.table().filter("query = 'watched' AND rows IS NOT NULL")
    assert rows.agg(F.sum("rows")).first()[0] == df.count()
    assert rows.filter("duration_seconds > 0 AND processing_rate > 0").count() == 3
    assert {r.state for r in log.lifecycle().collect()} == {"started", "terminated"}
    quality = [p.observedMetrics["quality"] for p in query.recentProgress if p.numInputRows]
    assert sum(q.rows_in for q in quality) == df.count()
    assert sum(q.rows_bad for q in quality) == df.filter("event_type = 'error'").count()


def test_progress_row_leaves_out_zeroes():
    class Progress:
        name, id, batchId, timestamp = None, "0123456789abcdef", 4, "2024-01-01T00:00:00Z"
        batchDuration, numInputRows, inputRowsPerSecond, processedRowsPerSecond = 1500, 1000, 500.0, 450.0
        stateOperators = []

    assert progress_row(Progress()) == ("01234567", 4, "2024-01-01T00:00:00Z", 1.5, 1000, 500.0, 450.0, 0)
    Progress.numInputRows, Progress.inputRowsPerSecond, Progress.batchDuration = 0, None, 0
    assert progress_row(Progress())[3:6] == (None, None, None)


def test_failed_query_is_logged(spark, small, folder):
    df = in_thirds(spark, small, f"{folder}/in")
    log = ProgressLog(spark, f"{folder}/progress")
    spark.streams.addListener(log)

    def fail(batch, batch_id):
        raise RuntimeError("boom")

    try:
        runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
        query = runner.foreach_batch(file_stream(spark, f"{folder}/in", df.schema), fail, "broken", "append")
        with pytest.raises(Exception, match="boom"):
            query.awaitTermination()
        assert log.await_end("broken")
    finally:
        spark.streams.removeListener(log)
    assert [r.query for r in log.lifecycle().filter("state = 'failed'").collect()] == ["broken"]


def test_registered_streams_run_in_several_batches(spark, small):
    streams._stored.clear()
    root = shared_dir(spark)
    known = set(glob.glob(f"{root}/tideline/*/checkpoint/*/commits"))
    for name in ("stream_distinct_update", "stream_cdc_state", "stream_alert_cooldown"):
        QUERIES[name](spark, small).count()
    for commits in set(glob.glob(f"{root}/tideline/*/checkpoint/*/commits")) - known:
        assert len([f for f in os.listdir(commits) if f.isdigit()]) >= 4, commits


def seen(spark, stream, folder):
    """Batch number and event id of all a stream gives."""
    runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
    runner.foreach_batch(stream, lambda b, n: b.select(F.lit(n).alias("n"), "event_id", "ts").write.parquet(f"{folder}/out/{n}"), "seen", "append")
    runner.await_all()
    return spark.read.parquet(*sorted(glob.glob(f"{folder}/out/*"))).collect()


def test_staged_streams_give_every_row_of_the_table_as_it_is(spark, small, folder, monkeypatch):
    given = table(spark, small, "events").withColumn("ts", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
    for part, keep in (("a", F.lit(True)), ("b", F.col("event_id") % 2 == 0)):
        given.filter(keep).write.parquet(f"{folder}/{part}/same/events.parquet")
    every = {r["event_id"] for r in given.collect()}
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    rows = seen(spark, streams._raw_events(spark, f"{folder}/a/same"), f"{folder}/1")
    assert len(rows) == len(every) and {r["event_id"] for r in rows} == every
    # Rows without a time are in the first batch; the others in order of time, several files a batch.
    assert {r["n"] for r in rows if r["ts"] is None} == {0} and len({r["n"] for r in rows}) == streams.BATCHES
    last = [max(r["ts"] for r in rows if r["n"] == n and r["ts"]) for n in range(streams.BATCHES)]
    first = [min(r["ts"] for r in rows if r["n"] == n and r["ts"]) for n in range(streams.BATCHES)]
    assert all(a <= b for a, b in zip(last, first[1:]))
    # A folder of the same name, and a table written anew, are other tables.
    half = {k for k in every if k % 2 == 0}
    assert {r["event_id"] for r in seen(spark, streams._raw_events(spark, f"{folder}/b/same"), f"{folder}/2")} == half
    given.filter("event_id < 50").write.mode("overwrite").parquet(f"{folder}/b/same/events.parquet")
    assert {r["event_id"] for r in seen(spark, streams._raw_events(spark, f"{folder}/b/same"), f"{folder}/3")} == {k for k in every if k < 50}


def test_staged_streams_of_an_empty_table(spark, small, folder):
    table(spark, small, "events").limit(0).write.parquet(f"{folder}/none/events.parquet")
    for name in ("stream_dedup", "stream_dlq_split", "stream_late_split"):
        assert QUERIES[name](spark, f"{folder}/none").count() == 0
