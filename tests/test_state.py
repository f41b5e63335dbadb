import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators import cdc
from tideline.operators.aggregate import aggregate, flatten_window
from tideline.operators.joins import without_follow_up, without_follow_up_stream
from tideline.operators.sketches import distinct_over, distinct_panes, quantile_panes, quantiles_over
from tideline.plans.spec import AggregationSpec, SpecError, WindowSpec
from tideline.session import discard, scratch_path
from tideline.sinks import files
from tideline.sinks.keyed import KeyedTable
from tideline.sinks.writers import batch_folder
from tideline.sources.messages import MESSAGE_SCHEMA, file_stream
from tideline.streaming.absent import AbsentWindows
from tideline.streaming.queries import StreamRunner
from tideline.streaming.routing import ChangeTable

T0 = datetime(2024, 3, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def folders(spark, table):
    data = f"{table.path}/data"
    return [f"{c}/{b}" for c in files.names(spark, data) for b in files.names(spark, f"{data}/{c}") if b.startswith("bucket__")]


# ------------------------------------------------------------------ the keyed table


def test_many_batches_leave_few_folders(spark, folder):
    table = KeyedTable(folder, ["k"], buckets=2, fold_after=3, keep=1)
    expected, rng = {}, random.Random(1)
    for batch in range(16):
        rows = {rng.randint(0, 6): batch for _ in range(2)}
        expected |= rows
        table(spark.createDataFrame(list(rows.items()), "k long, v long").coalesce(1), batch)
        assert len(folders(spark, table)) <= 2 * (3 + 1) * 2
    assert dict(map(tuple, table.read(spark).collect())) == expected
    assert len(files.names(spark, f"{folder}/manifests")) <= 2
    assert table.fold(spark) == 15
    table(spark.createDataFrame([], "k long, v long"), 16)
    assert len(folders(spark, table)) <= 2 * 4
    assert dict(map(tuple, table.read(spark).collect())) == expected


def test_a_reader_sees_one_state_while_others_write(spark, folder):
    table = KeyedTable(folder, ["k"], buckets=2, fold_after=1, keep=2)
    table(spark.createDataFrame([(1, "a"), (2, "a")], "k long, v string"), 0)
    pinned = table.snapshot(spark)
    reader = table.read(spark, pinned)
    table(spark.createDataFrame([(1, "b")], "k long, v string"), 1)
    table.fold(spark)
    assert sorted(map(tuple, reader.collect())) == [(1, "a"), (2, "a")]
    assert sorted(map(tuple, table.read(spark).collect())) == [(1, "b"), (2, "a")]


def test_failed_commits_and_replays(spark, folder):
    table = KeyedTable(folder, ["k"], order=["at"], buckets=2)
    table(spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (None, 1, "n")], "k long, at long, v string"), 0)
    # A batch that wrote its rows but no manifest is overwritten.
    table._write(spark.createDataFrame([(1, 99, "x", 1)], "k long, at long, v string, commit__ long"), 2, "1")
    assert {r.v for r in table.read(spark).collect()} == {"b", "n"}
    table(spark.createDataFrame([(1, 7, "late"), (None, 2, "m")], "k long, at long, v string"), 1)
    table(spark.createDataFrame([(1, 100, "replayed")], "k long, at long, v string"), 1)
    assert sorted(map(tuple, table.read(spark).collect()), key=str) == [(1, 9, "b"), (None, 2, "m")]
    assert table.versions(spark).count() == 4
    with pytest.raises(FileNotFoundError):
        KeyedTable(f"{folder}/none", ["k"]).read(spark)
    # The table's own number of buckets holds.
    other = KeyedTable(folder, ["k"], order=["at"], buckets=7)
    other(spark.createDataFrame([(1, 10, "c")], "k long, at long, v string"), 2)
    assert other.lookup(spark, spark.createDataFrame([(1,), (5,)], "k long")).first().v == "c"


ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def change(op, key, name, lsn):
    image = {"id": key, "name": name}
    body = {"op": op, "before": image if op == "d" else None, "after": None if op == "d" else image, "ts_ms": lsn, "source": {"lsn": lsn}}
    return (b"k", json.dumps(body).encode(), "cdc.public.people", 0, lsn, None)


def test_a_batch_of_few_keys_touches_few_buckets(spark, folder):
    table = ChangeTable(folder, ROW, ["id"], buckets=16)
    router = cdc.ChangeRouter().add_handler("people", table)
    router(spark.createDataFrame([change("c", k, "a", k) for k in range(200)], MESSAGE_SCHEMA), 0)
    first = set(folders(spark, table.table))
    assert len(first) == 16
    few = [change("u", k, "b", 1000 + k) for k in range(3)] + [change("d", 3, "a", 1003), change("u", 5, "old", 1)]
    router(spark.createDataFrame(few, MESSAGE_SCHEMA), 1)
    assert 1 <= len(set(folders(spark, table.table)) - first) <= 5
    rows = {r.id: r.name for r in table.read(spark).collect()}
    assert len(rows) == 199 and 3 not in rows and [rows[k] for k in (0, 2, 4, 5)] == ["b", "b", "a", "a"]


def test_only_own_folders_are_discarded(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    discard(spark, path)
    assert not files.exists(spark, path)
    with pytest.raises(ValueError):
        discard(spark, "/tmp/elsewhere")


# ------------------------------------------------------------------ changes and callbacks


def test_corrupt_changes_and_failed_calls_are_dead_letters(spark, folder):
    def picky(record):
        if "b" in json.loads(record["data"])["name"]:
            raise ValueError("no b")

    sent = [change("c", 1, "a", 1), change("c", 2, "b", 2), (b"k", b"{broken", "cdc.public.people", 0, 3, None), (b"k", None, "cdc.public.people", 0, 4, None)]
    handler = cdc.EventHandler(picky, ["data", "op"], batch_folder(f"{folder}/bad"), batch_folder(f"{folder}/good"))
    cdc.ChangeRouter(batch_folder(f"{folder}/corrupt")).add_handler("people", handler).run(spark.createDataFrame(sent, MESSAGE_SCHEMA))
    bad = spark.read.parquet(f"{folder}/bad").collect()
    assert sorted((r.error_type, r.event_id) for r in bad) == [("KeyError", "dlq-cdc.public.people-0-4"), ("ValueError", "dlq-cdc.public.people-0-2")]
    corrupt = spark.read.parquet(f"{folder}/corrupt").collect()
    assert [(r.error_type, r.original_event) for r in corrupt] == [("CorruptRecord", "{broken")]
    assert [r.op for r in spark.read.parquet(f"{folder}/good").collect()] == ["c"]


# ------------------------------------------------------------------ follow-ups on a stream


def test_stream_follow_ups_of_a_hot_key_meet_no_pairs(spark, folder):
    rng = random.Random(3)
    adds = [(i, "hot" if i % 3 else rng.choice("abc"), at(rng.randint(0, 20_000))) for i in range(600)] + [(900, None, at(50)), (901, "a", None)]
    buys = [("hot" if i % 2 else rng.choice("abc"), at(rng.randint(0, 20_000))) for i in range(150)] + [(None, at(60))]
    for part in range(3):
        keep = lambda t, part=part: (t is None and part == 0) or (t is not None and part * 7000 <= (t - T0).seconds < part * 7000 + 7000)
        end = [(10_000 + part, "end", at(part * 7000 + 6999))]
        spark.createDataFrame([r for r in adds if keep(r[2])] + end, "id long, user string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/adds")
        spark.createDataFrame([r for r in buys if keep(r[1])] + [("end", at(part * 7000 + 6999))], "user string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/buys")
    left = spark.read.parquet(f"{folder}/adds")
    right = spark.read.parquet(f"{folder}/buys")
    streams = [file_stream(spark, f"{folder}/{n}", d.schema, max_files=1) for n, d in (("adds", left), ("buys", right))]
    runner = StreamRunner(spark, f"{folder}/ck", trigger=None)
    # Files may be read in any order, so nothing is late.
    runner.files(without_follow_up_stream(*streams, "user", "ts", "10 minutes", "1 day", shards=2), f"{folder}/alone", "alone")
    runner.await_all()
    early = spark.read.schema(left.schema).parquet(f"{folder}/alone")
    assert early.count() == 0
    late = [file_stream(spark, f"{folder}/{n}", d.schema) for n, d in (("adds", left), ("buys", right))]
    runner.files(without_follow_up_stream(*late, "user", "ts", "10 minutes", "1 second", shards=2), f"{folder}/all", "all")
    runner.await_all()
    limit = at(20_999 - 1 - 600)
    expected = {r.id for r in without_follow_up(left.filter("ts IS NOT NULL"), right, "user", "ts", "10 minutes").collect() if r.ts < limit}
    got = [r.id for r in spark.read.schema(left.schema).parquet(f"{folder}/all").collect()]
    assert sorted(got) == sorted(expected) and 900 in expected and len(expected) > 20


# ------------------------------------------------------------------ silence


def closed(spark, rows):
    return spark.createDataFrame(
        [(at(3600 * h), at(3600 * h + 3600), g, n, beat) for h, g, n, beat in rows],
        "window_start timestamp_ntz, window_end timestamp_ntz, g string, count long, beat boolean",
    )


def test_silent_groups_and_silent_input(spark, folder):
    sink = AbsentWindows(folder, ["g"], "count", "1 hour", silent_for="5 hours", heartbeat="beat")
    sink(closed(spark, []), 0)
    sink(closed(spark, [(0, "a", 3, False), (1, "b", 1, None), (1, None, 2, False)]), 1)
    sink(closed(spark, [(3, "a", 1, False)]), 2)
    sink(closed(spark, [(3, "a", 1, False)]), 2)
    sink(closed(spark, []), 3)
    sink(closed(spark, [(4, None, 9, True)]), 4)  # only a heartbeat
    sink(closed(spark, [(9, "a", 2, False), (20, "b", 1, False)]), 5)
    rows = sorted(((r.g or "", (r.window_start - T0).total_seconds() / 3600, r["count"]) for r in sink.read(spark).collect()))
    a = [("a", h, {0: 3, 3: 1, 9: 2}.get(h, 0)) for h in range(0, 15)]
    b = [("b", h, 1 if h == 1 else 0) for h in range(1, 7)]
    none = [("", h, 2 if h == 1 else 0) for h in range(1, 7)]
    got_b = [r for r in rows if r[0] == "b"]
    assert [r for r in rows if r[0] == "a"] == a
    assert [r for r in rows if r[0] == ""] == none
    assert [r for r in got_b if r[1] <= 6] == b and ("b", 20, 1) in got_b
    assert len(rows) == len(set(rows))


# ------------------------------------------------------------------ sketches


def test_one_table_of_panes_answers_many_windows(spark):
    rows = [(at(i * 7), (i * 37) % 500 if i % 9 else None, "x" if i % 2 else None) for i in range(5000)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, user_id int, g string")
    panes = distinct_panes(df, "user_id", "5 minutes", ["g"], "ts").union(distinct_panes(df, "user_id", "5 minutes", ["g"], "ts"))
    for window in (WindowSpec("tumbling", "1 hour"), WindowSpec("sliding", "30 minutes", "10 minutes")):
        spec = AggregationSpec("q", "count_distinct", window, field="user_id", group_by=("g",))
        exact = {(r.window_start, r.g): r.unique_count for r in flatten_window(aggregate(df, spec, time="ts")).collect()}
        got = {(r.window_start, r.g): r.unique_count for r in flatten_window(distinct_over(panes, window, ["g"], "5 minutes")).collect()}
        assert got.keys() == exact.keys()
        assert all(abs(got[k] - n) <= max(1, 0.07 * n) for k, n in exact.items())
    with pytest.raises(SpecError):
        distinct_over(panes, WindowSpec("tumbling", "7 minutes"), ["g"], "5 minutes")


def test_quantiles_merge(spark):
    values = list(range(20_000))
    random.Random(5).shuffle(values)
    df = spark.createDataFrame([(at(i), float(v), "x") for i, v in enumerate(values)] + [(at(5), None, "x"), (at(5), 7.0, None)], "ts timestamp_ntz, value double, g string")
    panes = quantile_panes(df, "value", "1 minute", ["g"], "ts")
    got = {r.g: (r.rows, r.quantiles) for r in quantiles_over(panes, [0.0, 0.5, 0.99], ["g"]).collect()}
    assert got[None] == (1, [7.0, 7.0, 7.0])
    rows, (low, middle, high) = got["x"]
    assert rows == 20_000 and low == 0 and abs(middle - 10_000) < 600 and abs(high - 19_800) < 600
