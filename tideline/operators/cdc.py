"""Change-data envelopes: parsing, routing, current state, audit and diffs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import topic_schema_and_table
from tideline.operators import dlq
from tideline.operators.ranking import latest
from tideline.sources.decode import CORRUPT, json_record, once

# Operation codes of the change envelope.
OP_NAMES = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}
TOMBSTONE = "TOMBSTONE"

_SOURCE = T.StructType(
    [
        T.StructField("db", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("txId", T.LongType()),
        T.StructField("lsn", T.LongType()),
    ]
)


def _envelope(image: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("source", _SOURCE),
        ]
    )


def _absent(raw: Column, key: str) -> Column:
    return ~F.array_contains(F.json_object_keys(raw), key)


def parse_changes(messages: DataFrame, row: T.StructType | None = None, keep_corrupt: bool = False) -> DataFrame:
    """Messages to change rows: op, op_name, schema, table, data, before, after, ts_ms, source, raw.

    ``data`` is the before image of a delete and the after image otherwise; an image that is
    absent (not null) gives ``{}``.  Images are JSON text, because the topics may span many
    tables; for the topic of one table, ``row`` types them in the same parse and an absent
    image is null.  A null value is a tombstone.  Messages that are no JSON object are skipped;
    ``keep_corrupt`` keeps them with ``error_type`` set.  A value that does not fit its column is
    null, whether images are typed here or later, and never costs the change; ``keep_corrupt``
    marks such a change ``MistypedField`` if its images are typed here.  ``key``, ``topic``, ``partition`` and
    ``offset`` are carried along.
    """
    raw = F.col("value").cast("string")
    tombstone = F.col("value").isNull()
    schema, table = topic_schema_and_table("topic")
    parsed = messages.withColumn("raw", raw).select("*", once(json_record(raw, _envelope(row or T.StringType())), "e"))
    corrupt = ~tombstone & F.json_object_keys("raw").isNull()
    mistyped = ~tombstone & F.col(f"e.{CORRUPT}").isNotNull()
    if not keep_corrupt:
        parsed = parsed.filter(~corrupt)

    op = F.when(F.col("e.op").isNotNull(), F.col("e.op")).when(_absent(F.col("raw"), "op"), "unknown")
    op_name = F.lit("UNKNOWN")
    for code, name in OP_NAMES.items():
        op_name = F.when(F.col("e.op") == code, name).otherwise(op_name)
    image = F.when(F.col("e.op") == "d", F.col("e.before")).otherwise(F.col("e.after"))
    no_image = F.when(F.col("e.op") == "d", _absent(F.col("raw"), "before")).otherwise(_absent(F.col("raw"), "after"))
    data = image if row else F.when(tombstone, "{}").when(image.isNotNull(), image).when(no_image, "{}")

    columns = [
        F.when(tombstone, "d").otherwise(op).alias("op"),
        F.when(tombstone, TOMBSTONE).otherwise(op_name).alias("op_name"),
        schema.alias("schema"),
        table.alias("table"),
        data.alias("data"),
        F.col("e.before").alias("before"),
        F.col("e.after").alias("after"),
        F.col("e.ts_ms").alias("ts_ms"),
        F.col("e.source").alias("source"),
        "raw",
        "key",
        "topic",
        "partition",
        "offset",
    ]
    if keep_corrupt:
        columns.append(F.when(corrupt, "CorruptRecord").when(mistyped, "MistypedField").alias("error_type"))
    return parsed.select(*columns)


def table_changes(changes: DataFrame, table: str) -> DataFrame:
    return changes.filter(F.col("table") == table)


def typed_rows(changes: DataFrame, row: T.StructType, images: tuple[str, ...] = ("data",)) -> DataFrame:
    """Give the JSON row images of one table their column types."""
    return changes.withColumns({image: F.from_json(image, row) for image in images})


def last_changes(changes: DataFrame, row: T.StructType, keys: list[str]) -> DataFrame:
    """One table's last change per key by log position, deletes included.

    Result: ``op, lsn, offset`` and the row.  Applying it to its own output, or to a union
    of outputs, changes nothing, so replayed batches are harmless.
    """
    typed = isinstance(changes.schema["data"].dataType, T.StructType)
    data = F.col("data").alias("row") if typed else once(F.from_json("data", row), "row")
    rows = changes.filter(F.col("op_name") != TOMBSTONE).select("op", F.col("source.lsn").alias("lsn"), "offset", data)
    return latest(rows.select("op", "lsn", "offset", "row.*"), keys, ["lsn", "offset"])


def live_rows(last: DataFrame) -> DataFrame:
    """Rows that exist: their last change is not a delete."""
    return last.filter(F.col("op") != "d").drop("op", "offset")


def current_state(changes: DataFrame, row: T.StructType, keys: list[str]) -> DataFrame:
    """One table's rows as of the last change."""
    return live_rows(last_changes(changes, row, keys))


def merge_state(state: DataFrame, changes: DataFrame, row: T.StructType, keys: list[str]) -> DataFrame:
    """Fold new changes into a stored result of :func:`last_changes`."""
    return latest(state.unionByName(last_changes(changes, row, keys)), keys, ["lsn", "offset"])


def audit_rows(changes: DataFrame) -> DataFrame:
    """Append-only log of every change with its operation and time."""
    return changes.select(
        F.timestamp_millis("ts_ms").alias("changed_at"),
        "schema",
        "table",
        "op",
        "op_name",
        "before",
        "after",
        F.col("source.lsn").alias("lsn"),
        F.col("source.txId").alias("tx_id"),
        "topic",
        "partition",
        "offset",
    )


def changed_columns(changes: DataFrame) -> DataFrame:
    """Add ``changed_columns`` (sorted names) to updates that carry both images."""
    image = "map<string,string>"
    both = changes.filter((F.col("op") == "u") & F.col("before").isNotNull() & F.col("after").isNotNull())
    both = both.withColumns({"b__": F.from_json("before", image), "a__": F.from_json("after", image)})
    names = F.array_distinct(F.concat(F.map_keys("b__"), F.map_keys("a__")))
    differs = F.filter(
        names,
        lambda n: ~F.try_element_at(F.col("b__"), n).eqNullSafe(F.try_element_at(F.col("a__"), n)),
    )
    return both.withColumn("changed_columns", F.array_sort(differs)).drop("b__", "a__")


def operation_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("table", "op_name").agg(F.count("*").alias("count"))


class ChangeRouter:
    """Per-table handlers for ``foreachBatch``: each gets its table's changes as a DataFrame.

    Tables without a handler are ignored.  The batch is persisted once, however many
    handlers read it.  Messages that are no JSON object go to ``bad`` as dead letters; without
    one they are skipped.
    """

    def __init__(self, bad: Callable[[DataFrame, int], None] | None = None):
        self._handlers: dict[str, Callable[[DataFrame, int], None]] = {}
        self._bad = bad

    def add_handler(self, table: str, handler: Callable[[DataFrame, int], None]) -> ChangeRouter:
        self._handlers[table] = handler
        return self

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        changes = parse_changes(messages, keep_corrupt=self._bad is not None).persist()
        try:
            if self._bad is not None:
                corrupt = changes.filter("error_type = 'CorruptRecord'")
                message = F.lit("Payload is not a JSON object")
                self._bad(dlq.dead_letters(corrupt.withColumn("error_message", message), event="raw", failed_at=_message_time()), batch_id)
                changes = changes.filter("error_type IS NULL OR error_type <> 'CorruptRecord'").drop("error_type")
            for table, handler in self._handlers.items():
                handler(table_changes(changes, table), batch_id)
        finally:
            changes.unpersist()

    def run(self, messages: DataFrame) -> None:
        """The bounded form: one pass over a stored log."""
        self(messages, 0)


def _message_time() -> Column:
    return F.coalesce("ts_ms", F.unix_millis(F.current_timestamp()))


class EventHandler:
    """A handler that calls ``function`` with every change of a table, as a dict of ``columns``.

    The calls run in the executors.  A change whose call raises goes to ``bad`` as a dead letter
    with the error's name and text; the others go on to ``good``, if there is one.  A repeated
    batch calls again, so the function should not mind; its letters overwrite the earlier ones
    where ``bad`` keeps a folder per batch.
    """

    def __init__(
        self,
        function: Callable[[dict], None],
        columns: list[str],
        bad: Callable[[DataFrame, int], None],
        good: Callable[[DataFrame, int], None] | None = None,
    ):
        self.function = function
        self.columns = columns
        self.bad = bad
        self.good = good

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        kept = ["raw", "topic", "partition", "offset", "ts_ms"]
        wanted = [*dict.fromkeys([*self.columns, *kept])]
        called = dlq.guarded(changes, self.function, wanted, self.columns).persist()
        try:
            good, bad = dlq.split(called)
            self.bad(dlq.dead_letters(bad, event="raw", failed_at=_message_time()), batch_id)
            if self.good is not None:
                self.good(good.select(*self.columns), batch_id)
        finally:
            called.unpersist()
