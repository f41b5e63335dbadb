"""Message sources: Kafka topics, or files holding the same envelope.

Every reader yields ``key, value, topic, partition, offset, timestamp`` so that decoding,
change-data and dead-letter transforms do not care where messages came from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import topic_for
from tideline.operators import dlq

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def event_topics(event_types: list[str], prefix: str = "events") -> list[str]:
    return [topic_for(name, prefix) for name in event_types]


def kafka_options(
    servers: str,
    topics: list[str],
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        # Replayed dead letters say in a header how often they came.
        "includeHeaders": "true",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def event_stream(
    spark: SparkSession,
    event_types: list[str],
    servers: str,
    prefix: str = "events",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """One stream over the topics of several event types, from the latest offsets."""
    options = kafka_options(
        servers, event_topics(event_types, prefix), "latest", max_offsets_per_trigger=max_offsets_per_trigger
    )
    return spark.readStream.format("kafka").options(**options).load()


def change_stream(spark: SparkSession, topics: list[str], servers: str) -> DataFrame:
    """Change topics from the earliest offset; the query checkpoint replaces auto-commit."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topics, "earliest")).load()


def dead_letter_stream(spark: SparkSession, servers: str, topic: str = "events.dlq") -> DataFrame:
    """Dead-letter messages from the earliest offset; decode with ``operators.dlq.from_messages``."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, [topic], "earliest")).load()


def dead_letter_files(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Dead letters stored as JSON lines, or as one (possibly indented) JSON object per file."""
    rows = spark.read.schema(dlq.ENVELOPE).option("multiLine", one_per_file).json(path)
    return dlq.from_files(rows)


def backfill(spark: SparkSession, topics: list[str], servers: str) -> DataFrame:
    """The whole retained history of some topics as a bounded table."""
    options = kafka_options(servers, topics, "earliest")
    return spark.read.format("kafka").options(**options, endingOffsets="latest").load()


def file_stream(spark: SparkSession, path: str, schema: T.StructType = MESSAGE_SCHEMA, max_files: int | None = None) -> DataFrame:
    """The file twin of a topic: every new Parquet file under ``path`` is more messages."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def file_backfill(spark: SparkSession, path: str, schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def topic_directories(df: DataFrame) -> DataFrame:
    """Set ``topic`` from the name of the directory each message file lies in."""
    return df.withColumn("topic", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


def subscribe(messages: DataFrame, topics: list[str]) -> DataFrame:
    """Keep some topics of a mixed table; the filter runs before any payload is parsed."""
    return messages.filter(F.col("topic").isin(topics))


def first_messages(messages: DataFrame, n: int) -> DataFrame:
    """The first ``n`` messages in (timestamp, topic, partition, offset) order."""
    return messages.orderBy("timestamp", "topic", "partition", "offset").limit(n)
