"""Dead letters: envelope, good/bad split, retry accounting, replay and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.session import ship
from tideline.sources.decode import CORRUPT, json_record, once

# Envelope fields and the default number of retries.
MAX_RETRIES = 3
ENVELOPE = T.StructType(
    [
        T.StructField("original_topic", T.StringType()),
        T.StructField("original_event", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("max_retries", T.IntegerType()),
        T.StructField("event_id", T.StringType()),
    ]
)
_NAMES = ENVELOPE.names


def dead_letters(
    failed: DataFrame,
    topic: str = "topic",
    event: str = "value",
    failed_at: Column | None = None,
    retry_count: Column | int = 0,
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """Envelope for rows that carry ``error_type`` and ``error_message``.

    The id is the event's own ``event_id`` or the one a replayed message carries; else it names
    the message by topic, partition and offset where those columns are there, and by the
    envelope's time (``dlq-<timestamp>``) where they are not.
    """
    at = failed_at if failed_at is not None else F.unix_millis(F.current_timestamp())
    count = retry_count if isinstance(retry_count, Column) else F.lit(retry_count)
    text = F.col(event).cast("string")
    return failed.select(
        F.col(topic).alias("original_topic"),
        text.alias("original_event"),
        "error_message",
        "error_type",
        at.cast("bigint").alias("timestamp"),
        count.cast("int").alias("retry_count"),
        F.lit(max_retries).alias("max_retries"),
        _carried(failed, "dlq_event_id").alias("event_id"),
        (
            F.concat_ws("-", F.lit("dlq"), F.col(topic), F.col("partition"), F.col("offset"))
            if {"partition", "offset"} <= set(failed.columns)
            else F.concat(F.lit("dlq-"), at.cast("bigint").cast("string"))
        ).alias("fallback__"),
    ).withColumn(
        "event_id", F.coalesce(F.get_json_object("original_event", "$.event_id"), "event_id", "fallback__")
    ).drop("fallback__")


def _carried(messages: DataFrame, name: str) -> Column:
    """A value that a replayed message carries in its headers, or in a column of its own."""
    found = []
    if "headers" in messages.columns:
        found.append(F.get(F.filter("headers", lambda h: h["key"] == name), 0)["value"].cast("string"))
    if name in messages.columns:
        found.append(F.col(name).cast("string"))
    return F.coalesce(*found, F.lit(None).cast("string"))


def retries_so_far(messages: DataFrame) -> Column:
    """How often a message has been replayed; 0 if it says nothing."""
    return F.coalesce(_carried(messages, "retry_count").cast("int"), F.lit(0))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) by ``error_type``; persist the input if both sides are written."""
    good = checked.filter(F.col("error_type").isNull()).drop("error_type", "error_message")
    return good, checked.filter(F.col("error_type").isNotNull())


def can_retry() -> Column:
    return F.col("retry_count") < F.col("max_retries")


def increment_retry(letters: DataFrame) -> DataFrame:
    return letters.withColumn("retry_count", (F.col("retry_count") + 1).cast("int"))


def replay(letters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages back to their original topics, letters to archive for good).

    Replayed messages carry the raised ``retry_count`` and their id for the next failure, as
    columns and as message headers, which a topic keeps.
    """
    again = increment_retry(letters.filter(can_retry())).select(
        F.col("event_id").cast("binary").alias("key"),
        F.col("original_event").cast("binary").alias("value"),
        F.col("original_topic").alias("topic"),
        "retry_count",
        "max_retries",
        F.col("event_id").alias("dlq_event_id"),
        F.array(
            F.struct(F.lit("retry_count").alias("key"), F.col("retry_count").cast("string").cast("binary").alias("value")),
            F.struct(F.lit("dlq_event_id").alias("key"), F.col("event_id").cast("binary").alias("value")),
        ).alias("headers"),
    )
    return again, letters.filter(~can_retry())


def to_messages(letters: DataFrame, topic: str = "events.dlq") -> DataFrame:
    """Envelopes as keyed messages; ``original_event`` stays a JSON object where it is one."""
    parsed = letters.select("*", once(F.try_parse_json("original_event"), "v__"))
    nested = F.struct(*[F.col("v__").alias(n) if n == "original_event" else F.col(n) for n in _NAMES])
    text = F.when(F.col("v__").isNotNull(), F.to_json(nested)).otherwise(F.to_json(F.struct(*_NAMES)))
    return parsed.select(
        F.col("event_id").cast("binary").alias("key"), text.cast("binary").alias("value"), F.lit(topic).alias("topic")
    )


def from_messages(messages: DataFrame) -> DataFrame:
    """Restore envelopes; messages that are no envelope, or have unknown keys, are skipped."""
    text = F.col("value").cast("string")
    known = F.array(*[F.lit(n) for n in _NAMES])
    needed = F.array(*[F.lit(n) for n in _NAMES[:4]])
    read = F.struct(json_record(text, ENVELOPE).alias("e"), F.json_object_keys(text).alias("keys"))
    parsed = messages.select(once(read, "r")).select("r.e", "r.keys")
    strict = parsed.filter(
        F.col(f"e.{CORRUPT}").isNull()
        & (F.size(F.array_except("keys", known)) == 0)
        & (F.size(F.array_except(needed, "keys")) == 0)
    )
    return _with_defaults(strict.select(*[F.col(f"e.{n}").alias(n) for n in _NAMES]))


def from_files(rows: DataFrame) -> DataFrame:
    """Envelopes read with ``spark.read.schema(ENVELOPE).json(path)``, defaults filled in."""
    return _with_defaults(rows.select(*_NAMES))


def _with_defaults(letters: DataFrame) -> DataFrame:
    filled = letters.withColumns(
        {
            "timestamp": F.coalesce("timestamp", F.unix_millis(F.current_timestamp())),
            "retry_count": F.coalesce("retry_count", F.lit(0)),
            "max_retries": F.coalesce("max_retries", F.lit(MAX_RETRIES)),
        }
    )
    fallback = F.concat(F.lit("dlq-"), F.col("timestamp").cast("string"))
    own = F.get_json_object("original_event", "$.event_id")
    return filled.withColumn("event_id", F.coalesce("event_id", own, fallback))


def report(letters: DataFrame) -> DataFrame:
    return letters.groupBy("original_topic", "error_type").agg(
        F.count("*").alias("failures"), F.max("retry_count").alias("max_retry_count")
    )


def guarded(
    rows: DataFrame, function: Callable[[dict], None], columns: list[str], given: list[str] | None = None
) -> DataFrame:
    """Run a per-row callback in Python; a row whose call raises gets its error, the rest none.

    The result has ``columns`` and the error; the callback sees ``given`` of them, by default all.

    The callback is the user's own code, so this is the one place rows pass through Python;
    they do so in Arrow batches, spread over all partitions.
    """
    ship(rows.sparkSession)
    fields = rows.select(*columns).schema.fields
    schema = T.StructType(
        [*fields, T.StructField("error_type", T.StringType()), T.StructField("error_message", T.StringType())]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            types, messages = [], []
            for record in frame[given or columns].to_dict("records"):
                try:
                    function(record)
                    types.append(None)
                    messages.append(None)
                except Exception as err:
                    types.append(type(err).__name__)
                    messages.append(str(err))
            yield frame.assign(error_type=types, error_message=messages)

    return rows.select(*columns).mapInPandas(run, schema)
