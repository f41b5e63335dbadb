from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tideline.operators.aggregate import aggregate
from tideline.operators.generate import generate_events, spine
from tideline.operators.joins import enrich
from tideline.operators.ranking import top_per_window
from tideline.plans.domains import FINTECH
from tideline.plans.spec import AggregationSpec, WindowSpec
from tideline.session import scratch_path, shared_dir
from tideline.sinks import writers
from tideline.sinks.writers import (
    UpsertTable,
    analytics_column,
    analytics_options,
    archive_columns,
    batch_sink,
    check_required,
    create_table,
    file_writer,
    mapped,
    merge_statement,
    publish,
    table_schema,
    table_writer,
    transactional_column_types,
    write_batch,
)
from tideline.sources.decode import decode_json
from tideline.sources.messages import event_topics, kafka_options
from tideline.sources.tables import ordered, read_back, table

MAPPING = {"window.start": "window_start", "window.end": "window_end", "event_type": "kind", "count": "count"}
COLUMNS = [{"name": "window_start", "type": "timestamp"}, {"name": "kind", "type": "string"}, {"name": "count", "type": "long"}]


def counts(spark, small):
    spec = AggregationSpec("q", "count", WindowSpec("tumbling", "1 day"), group_by=("event_type",))
    return aggregate(table(spark, small, "events"), spec, time="ts")


def test_mapped_write_returns_its_row_count(spark, small, folder):
    df = counts(spark, small)
    assert mapped(df, MAPPING).columns == ["window_start", "window_end", "kind", "count"]
    assert write_batch(df, "daily", MAPPING, file_writer(folder)) == df.count()
    assert write_batch(df.limit(0), "daily", MAPPING, file_writer(folder)) == 0
    assert spark.read.parquet(f"{folder}/daily").count() == df.count()


def test_read_back(spark, small, folder):
    write_batch(counts(spark, small), "daily", MAPPING, file_writer(folder))
    found = read_back(spark, f"{folder}/daily", "SELECT * FROM {sink} WHERE kind = :kind", {"kind": "purchase"})
    top = ordered(found, "window_start", "kind", limit=3).collect()
    assert [r.window_start.day for r in top] == [1, 2, 3]


def test_catalog_table(spark, small):
    order = create_table(spark, "daily_counts", {"columns": COLUMNS})
    assert order == ["window_start"]
    assert create_table(spark, "daily_counts", {"columns": COLUMNS, "order_by": ["kind"]}) == ["kind"]
    mapping = {"window.start": "window_start", "event_type": "kind", "count": "count"}
    df = counts(spark, small).withColumn("window", F.struct(F.col("window.start").cast("timestamp").alias("start")))
    n = write_batch(df, "daily_counts", mapping, table_writer(order))
    stored = spark.table("daily_counts")
    assert stored.count() == n > 0
    assert stored.filter("inserted_at IS NULL").isEmpty()
    spark.sql("DROP TABLE daily_counts")


def test_types_of_both_stores():
    assert [analytics_column(c) for c in COLUMNS] == ["window_start DateTime", "kind String", "count Int64"]
    assert analytics_column({"name": "x", "type": "double", "nullable": True}) == "x Nullable(Float64)"
    assert analytics_column({"name": "x", "type": "weird"}) == "x String"
    assert analytics_options({"columns": COLUMNS}) == {"createTableOptions": "ENGINE = MergeTree() ORDER BY (window_start)"}
    assert transactional_column_types({"columns": COLUMNS}) == "window_start TIMESTAMP, kind TEXT, count BIGINT"
    schema = table_schema(COLUMNS, nullable=False)
    assert schema.names == ["window_start", "kind", "count", "inserted_at"] and not schema["kind"].nullable


def test_required_columns(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id long, name string")
    schema = {"columns": [{"name": "id", "type": "long"}, {"name": "name", "type": "string", "nullable": False}], "primary_key": "id"}
    assert sorted((r.id or 0) for r in check_required(df, schema).collect()) == [0, 3]


def test_replayed_batch_changes_nothing(spark, folder):
    sink = UpsertTable(folder, ["w"])
    first = spark.createDataFrame([(1, 10), (2, 20)], "w int, n int")
    second = spark.createDataFrame([(2, 25), (3, 30)], "w int, n int")
    for batch, batch_id in [(first, 0), (first, 0), (second, 1), (first, 0), (second, 1)]:
        sink(batch, batch_id)
    assert sorted(map(tuple, sink.read(spark).collect())) == [(1, 10), (2, 25), (3, 30)]
    sink.compact(spark, folder + "-compact")
    assert spark.read.parquet(folder + "-compact").count() == 3


def test_archive_prunes_partitions(spark, small, folder):
    kept = archive_columns(table(spark, small, "events"), "ts")
    file_writer(folder, partition_by=["event_date", "event_type"])(kept, "raw")
    one = spark.read.parquet(f"{folder}/raw").filter("event_type = 'purchase' AND event_date = DATE'2024-01-05'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_type" in plan or "PartitionFilters: [isnotnull(event_date" in plan
    assert one.count() == table(spark, small, "events").filter("event_type = 'purchase' AND to_date(ts) = DATE'2024-01-05'").count()


def test_options():
    assert event_topics(["a", "b"], "x") == ["x.a", "x.b"]
    options = kafka_options("host:1", ["x.a", "x.b"], max_offsets_per_trigger=1000)
    assert options == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "x.a,x.b",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "includeHeaders": "true",
        "maxOffsetsPerTrigger": "1000",
    }
    assert kafka_options("h", ["cdc.public.orders"], "earliest")["startingOffsets"] == "earliest"


def test_producer_options():
    assert writers.kafka_options("h:1", {"linger.ms": "10"}) == {
        "kafka.bootstrap.servers": "h:1",
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.compression.type": "lz4",
        "kafka.linger.ms": "10",
        "kafka.batch.size": "16384",
    }


def test_publish(spark, folder):
    rows = generate_events(spine(spark, 25, 1_700_000_000_000), FINTECH, "login")
    assert publish(rows, FINTECH, "login", file_writer(folder)) == 25
    sent = spark.read.parquet(f"{folder}/events.login")
    assert {r.topic for r in sent.collect()} == {"events.login"}
    back = decode_json(sent, FINTECH.event_type("login"), "account_id")
    assert back.select(rows.columns).exceptAll(rows).isEmpty() and back.count() == 25
    assert sent.join(back, sent.key.cast("string") == back.account_id).count() >= 25
    with pytest.raises(ValueError):
        publish(rows, FINTECH, "nothing", file_writer(folder))


def test_top_k_is_cut_before_the_shuffle(spark):
    rows = [(datetime(2024, 1, d), f"p{i}", 10 - i // 2) for d in (1, 2) for i in range(6)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, product string, count int")
    top = top_per_window(df, "count", 3, ["product"])
    assert [(r.product, r.rank) for r in top.orderBy("window_start", "rank").collect()][:3] == [("p0", 1), ("p1", 2), ("p2", 3)]
    assert "row_number(), 3, Partial" in top._jdf.queryExecution().executedPlan().toString()


def test_enrichment_without_a_match_keeps_the_row(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    names = spark.createDataFrame([(1, "one")], "k int, name string")
    assert {(r.k, r.name) for r in enrich(facts, names, "k").collect()} == {(1, "one"), (2, None)}


def test_scratch_is_under_the_configured_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/tideline/x-")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_counts_are_right_whatever_the_writer_does(spark, folder):
    df = spark.range(1000).withColumnRenamed("id", "x")
    seen = []
    peek = lambda rows, table: (rows.isEmpty(), rows.take(2), seen.append(rows.count()))
    for writer in (file_writer(folder), peek, lambda rows, table: None):
        assert batch_sink(writer, "t", {"x": "y"})(df, 0) == 1000
        assert batch_sink(writer, "t", {"x": "y"})(df.limit(0), 1) == 0
    assert seen == [1000, 0]


def test_folded_upsert_reads_the_base_and_what_came_after(spark, folder):
    store = UpsertTable(folder, ["k"])
    for batch in range(4):
        store(spark.createDataFrame([(k, batch) for k in range(batch, 5)], "k long, v long"), batch)
    assert store.fold(spark) == 3
    before = sorted(map(tuple, store.read(spark).collect()))
    assert before == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 3)]
    store(spark.createDataFrame([(0, 9), (7, 9)], "k long, v long"), 4)
    store(spark.createDataFrame([(0, 9), (7, 9)], "k long, v long"), 4)
    assert sorted(map(tuple, store.read(spark).collect())) == [(0, 9), (1, 1), (2, 2), (3, 3), (4, 3), (7, 9)]
    assert store.fold(spark) == 4
    assert sorted(map(tuple, store.read(spark).collect())) == [(0, 9), (1, 1), (2, 2), (3, 3), (4, 3), (7, 9)]


def test_merge_statement():
    text = merge_statement("hourly", "hourly_stage", ["w", "g", "n"], ["w", "g"])
    assert text == (
        "INSERT INTO hourly (w, g, n) SELECT w, g, n FROM hourly_stage ON CONFLICT (w, g) DO UPDATE SET n = EXCLUDED.n"
    )
    assert merge_statement("t", "s", ["k"], ["k"]).endswith("ON CONFLICT (k) DO NOTHING")
