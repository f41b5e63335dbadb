"""Batch and micro-batch writers.  None of them brings rows to the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import topic_for
from tideline.plans.spec import Domain
from tideline.sinks.keyed import KeyedTable
from tideline.sources.decode import encode_json

# A pluggable sink: writes one DataFrame to one named table.
Writer = Callable[[DataFrame, str], None]

# Column types of the two database sinks.
ANALYTICS_TYPES = {
    "string": "String",
    "int": "Int64",
    "long": "Int64",
    "float": "Float64",
    "double": "Float64",
    "boolean": "UInt8",
    "timestamp": "DateTime",
    "datetime": "DateTime",
    "date": "Date",
}
TRANSACTIONAL_TYPES = {
    "string": "TEXT",
    "int": "INTEGER",
    "long": "BIGINT",
    "float": "REAL",
    "double": "DOUBLE PRECISION",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "datetime": "TIMESTAMP",
    "date": "DATE",
}
_SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "datetime": T.TimestampType(),
    "date": T.DateType(),
}


def mapped(df: DataFrame, column_mapping: dict[str, str]) -> DataFrame:
    """Project and rename; ``window.start`` reaches into a struct."""
    return df.select(*[F.col(source).alias(target) for source, target in column_mapping.items()])


def write_batch(df: DataFrame, table: str, column_mapping: dict[str, str], writer: Writer) -> int:
    """Write the mapped columns and return the row count.

    The writers of this module run one job, which counts as it writes.  Another writer may run
    several jobs or none, so for it the rows are kept and counted apart.
    """
    rows = mapped(df, column_mapping)
    if getattr(writer, "one_job", False):
        seen = Observation()
        writer(rows.observe(seen, F.count("*").alias("rows")), table)
        return seen.get["rows"]
    rows.persist()
    try:
        writer(rows, table)
        return rows.count()
    finally:
        rows.unpersist()


def _one_job(write: Writer) -> Writer:
    write.one_job = True
    return write


def batch_sink(writer: Writer, table: str, column_mapping: dict[str, str]) -> Callable[[DataFrame, int], int]:
    """A ``foreachBatch`` function over :func:`write_batch`; returns the rows of each batch.

    A replayed batch is written again, so use it where the table itself rejects or replaces rows
    (:func:`merge_statement`), or take :class:`UpsertTable` or :func:`batch_folder`.
    """
    return lambda batch, batch_id: write_batch(batch, table, column_mapping, writer)


def merge_statement(table: str, stage: str, columns: list[str], keys: list[str]) -> str:
    """SQL that moves a staged batch into a table with a primary key, replacing equal keys."""
    rest = [c for c in columns if c not in keys]
    action = "DO UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in rest) if rest else "DO NOTHING"
    names = ", ".join(columns)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage} ON CONFLICT ({', '.join(keys)}) {action}"


def publish(events: DataFrame, domain: Domain, event_type: str, writer: Writer, prefix: str = "events") -> int:
    """Send flat events of one declared type as keyed messages; returns how many.

    The key is the domain's entity; a type the domain does not declare is an error.
    """
    messages = encode_json(events, domain.event_type(event_type), domain.entity_key, prefix)
    columns = {name: name for name in messages.columns}
    return write_batch(messages, topic_for(event_type, prefix), columns, writer)


def jdbc_writer(url: str, batch_size: int = 10_000, column_types: str | None = None, **options: str) -> Writer:
    """Batched multi-row inserts from the executors; the driver jar must be on the classpath."""
    settings = {"url": url, "batchsize": str(batch_size), **options}
    if column_types:
        settings["createTableColumnTypes"] = column_types

    def write(df: DataFrame, table: str) -> None:
        df.write.format("jdbc").options(**settings, dbtable=table).mode("append").save()

    return _one_job(write)


# Producer settings.
PRODUCER = {
    "acks": "all",
    "retries": "3",
    "compression.type": "lz4",
    "linger.ms": "5",
    "batch.size": "16384",
}


def kafka_options(servers: str, producer: dict[str, str] | None = None) -> dict[str, str]:
    settings = {f"kafka.{k}": v for k, v in {**PRODUCER, **(producer or {})}.items()}
    return {"kafka.bootstrap.servers": servers, **settings}


def kafka_writer(servers: str, producer: dict[str, str] | None = None) -> Writer:
    """Rows with ``key, value`` (and optionally ``topic``, which then overrides ``table``)."""
    settings = kafka_options(servers, producer)

    def write(df: DataFrame, table: str) -> None:
        options = settings if "topic" in df.columns else {**settings, "topic": table}
        df.write.format("kafka").options(**options).save()

    return _one_job(write)


def file_writer(root: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> Writer:
    """Append files under ``root/table``; ``root`` may be any Hadoop-compatible URI."""

    def write(df: DataFrame, table: str) -> None:
        out = df.write.mode("append").format(fmt)
        if partition_by:
            out = out.partitionBy(*partition_by)
        out.save(f"{root}/{table}")

    return _one_job(write)


def table_writer(order_by: list[str] | None = None) -> Writer:
    """Append to a catalog table, stamping ``inserted_at`` and sorting inside files."""

    def write(df: DataFrame, table: str) -> None:
        stamped = df.withColumn("inserted_at", F.current_timestamp())
        if order_by:
            stamped = stamped.sortWithinPartitions(*order_by)
        stamped.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)

    return _one_job(write)


def table_schema(columns: list[dict], nullable: bool) -> T.StructType:
    """Column list ``{name, type[, nullable]}`` plus ``inserted_at``; unknown types are strings."""
    fields = [
        T.StructField(c["name"], _SPARK_TYPES.get(c["type"], T.StringType()), c.get("nullable", nullable))
        for c in columns
    ]
    return T.StructType([*fields, T.StructField("inserted_at", T.TimestampType())])


def create_table(spark: SparkSession, table: str, schema: dict, nullable: bool = False) -> list[str]:
    """Create an empty catalog table unless it exists; returns its sort columns.

    ``schema`` is ``{"columns": [...], "order_by": [...]}``; without ``order_by`` the first
    column sorts.
    """
    if not spark.catalog.tableExists(table):
        struct = table_schema(schema["columns"], nullable)
        spark.createDataFrame([], struct).write.format("parquet").saveAsTable(table)
    return list(schema.get("order_by") or [schema["columns"][0]["name"]])


def analytics_column(column: dict) -> str:
    """``name Type`` for the analytics store; columns are not nullable unless they say so."""
    kind = ANALYTICS_TYPES.get(column["type"], "String")
    return f"{column['name']} " + (f"Nullable({kind})" if column.get("nullable", False) else kind)


def analytics_options(schema: dict) -> dict[str, str]:
    """Writer options that create the analytics table with its engine and sort order."""
    order = schema.get("order_by") or [schema["columns"][0]["name"]]
    return {"createTableOptions": f"ENGINE = MergeTree() ORDER BY ({', '.join(order)})"}


def transactional_column_types(schema: dict) -> str:
    """``createTableColumnTypes`` for the transactional store."""
    return ", ".join(f"{c['name']} {TRANSACTIONAL_TYPES.get(c['type'], 'TEXT')}" for c in schema["columns"])


def check_required(df: DataFrame, schema: dict) -> DataFrame:
    """Rows that break a NOT NULL column or lack part of the primary key."""
    needed = [c["name"] for c in schema["columns"] if not c.get("nullable", True)]
    key = schema.get("primary_key")
    needed += [k.strip() for k in key.split(",") if k.strip() not in needed] if key else []
    broken = F.lit(False)
    for name in needed:
        broken = broken | F.col(name).isNull()
    return df.filter(broken)


class UpsertTable(KeyedTable):
    """Replay-safe store for update-mode aggregates: the last batch's row of each key stands."""

    def compact(self, spark: SparkSession, path: str) -> None:
        """Write the state somewhere else."""
        self.read(spark).write.mode("overwrite").parquet(path)


def fan_out(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Several sinks from one micro-batch, computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def archive_columns(events: DataFrame, time: str = "event_time") -> DataFrame:
    """Raw events with the ``event_date`` they are partitioned by (with ``event_type``)."""
    return events.withColumn("event_date", F.to_date(time))


def batch_folder(root: str) -> Callable[[DataFrame, int], None]:
    """Idempotent append of a micro-batch: its folder is named after the batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch_id={batch_id}")

    return write


def dead_letter_writer(backend: str, target: str, topic: str = "events.dlq") -> Callable[[DataFrame], None]:
    """``kafka`` publishes envelopes to a topic, ``file`` appends JSON lines under ``target``."""
    from tideline.operators.dlq import to_messages

    if backend == "kafka":
        publish = kafka_writer(target)
        return lambda letters: publish(to_messages(letters, topic), topic)
    if backend == "file":
        return lambda letters: letters.write.mode("append").json(target)
    raise ValueError(f"unknown dead-letter backend: {backend}")
