"""Message payloads to typed event columns, and back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import event_type_of, strip_registry_header, topic_for
from tideline.functions.times import event_time
from tideline.plans.schema import TIMESTAMP, avro_json, fields_of, struct_type
from tideline.plans.spec import Domain, EventType

CORRUPT = "_corrupt_record"
EVENT_TIME = "event_time"
EVENT_TYPE = "event_type"


def json_record(value: Column, schema: T.StructType) -> Column:
    """PERMISSIVE parse of a JSON payload that keeps unparsable text in ``_corrupt_record``."""
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return F.from_json(
        value.cast("string"),
        nullable.add(CORRUPT, T.StringType()),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def once(column: Column, name: str) -> Column:
    """A costly column computed a single time per row.

    Filters on a plain column are pushed below its projection and repeat its expression;
    they cannot pass a generator, and a one-element array makes this one free of new rows.
    """
    return F.explode(F.array(column)).alias(name)


def decode_json(messages: DataFrame, event_type: EventType, entity_key: str) -> DataFrame:
    """Messages of one event type to flat columns plus ``event_type`` and ``event_time``.

    Messages that :func:`checked` calls unparsable, mistyped or without a timestamp are left
    out; split by it first to route them, or ``observe`` :func:`skipped` to count them.
    """
    schema = struct_type(event_type, entity_key)
    return _flatten(messages.filter(F.col("topic").endswith("." + event_type.name)), schema)


def _flatten(messages: DataFrame, schema: T.StructType, record: Column | None = None) -> DataFrame:
    record = json_record(F.col("value"), schema) if record is None else record
    parsed = messages.select(event_type_of("topic").alias(EVENT_TYPE), once(record, "e"))
    good = parsed.filter(F.col(f"e.{CORRUPT}").isNull() & F.col(f"e.{TIMESTAMP}").isNotNull())
    return _with_event_time(good.select(EVENT_TYPE, *[F.col(f"e.{n}").alias(n) for n in schema.names]))


def skipped() -> Column:
    """How many :func:`checked` messages decoding leaves out, as an aggregate to observe."""
    return F.count_if(F.col("error_type").isNotNull()).alias("skipped")


def decode_avro(messages: DataFrame, event_type: EventType, entity_key: str) -> DataFrame:
    """Registry-framed Avro payloads; needs the spark-avro connector on the classpath.

    The schema is given as written to the registry (epoch millis carry a logical type), so
    ``timestamp`` arrives as an instant and is turned back to the long the JSON path yields.
    """
    from pyspark.sql.avro.functions import from_avro

    record = from_avro(strip_registry_header("value"), avro_json(event_type, entity_key))
    names = [name for name, _, _ in fields_of(event_type, entity_key)]
    decoded = messages.filter(F.col("topic").endswith("." + event_type.name)).select(
        event_type_of("topic").alias(EVENT_TYPE), record.alias("e")
    )
    columns = [
        (F.unix_millis(f"e.{n}") if n == TIMESTAMP else F.col(f"e.{n}")).alias(n) for n in names
    ]
    return _with_event_time(decoded.select(EVENT_TYPE, *columns))


def _with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn(EVENT_TIME, event_time(TIMESTAMP))


def decode_types(
    messages: DataFrame, domain: Domain, event_types: list[str], fields: list[str] | None = None
) -> DataFrame:
    """Several event types as one table; a field a type lacks is null.

    Every message is parsed once, by the fields of its own type, so a stream needs a single
    source and a field that only another type declares costs no event.  ``fields`` restricts the
    parse to the columns a query reads; ``timestamp`` always stays.
    """
    found: dict[str, T.StructField] = {}
    own: dict[str, T.StructType] = {}
    for name in event_types:
        whole = struct_type(domain.event_type(name), domain.entity_key).fields
        own[name] = T.StructType([f for f in whole if fields is None or f.name in fields or f.name == TIMESTAMP])
        for f in own[name].fields:
            if f.name in found and found[f.name].dataType != f.dataType:
                raise ValueError(f"{f.name} has different types in {event_types}")
            found.setdefault(f.name, f)
    wanted = messages.filter(event_type_of("topic").isin(event_types))
    if all(set(schema.names) == set(found) for schema in own.values()):
        return _flatten(wanted, T.StructType(list(found.values())))
    union = [*found.values(), T.StructField(CORRUPT, T.StringType())]

    def filled(record: Column, schema: T.StructType) -> Column:
        has = {*schema.names, CORRUPT}
        return F.struct(*[(record[f.name] if f.name in has else F.lit(None).cast(f.dataType)).alias(f.name) for f in union])

    record = by_type(own, lambda schema: bound(json_record(F.col("value"), schema), lambda e: filled(e, schema)))
    return _flatten(wanted, T.StructType(list(found.values())), record)


def bound(column: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a costly column, which is worked out once however often it is used."""
    return F.transform(F.array(column), use)[0]


def by_type(schemas: dict[str, T.StructType], use: Callable[[T.StructType], Column]) -> Column:
    """What ``use`` makes of the schema of a message's own type; equal schemas share a branch."""
    types: dict[T.StructType, list[str]] = {}
    for name, schema in schemas.items():
        types.setdefault(schema.json(), []).append(name)
    result = None
    for names in types.values():
        here = event_type_of("topic").isin(names)
        made = use(schemas[names[0]])
        result = F.when(here, made) if result is None else result.when(here, made)
    return result


def union_types(tables: dict[str, DataFrame]) -> DataFrame:
    """Already decoded per-type tables as one; works on streams as well."""
    merged = None
    for table in tables.values():
        merged = table if merged is None else merged.unionByName(table, allowMissingColumns=True)
    return merged


def checked(messages: DataFrame, domain: Domain) -> DataFrame:
    """Every message with ``error_type`` / ``error_message``; both are null on good rows.

    Errors are, in order: a type the domain does not declare, an unparsable payload, a value
    that does not fit its field as the message's own type declares it, a missing required field.
    The parse is the one decoding does, so whatever is good here is decoded whole.  One parse of
    each message, no shuffle.
    """
    type_col = F.col(EVENT_TYPE)
    schemas = {t.name: struct_type(t, domain.entity_key) for t in domain.event_types}

    def found(schema: T.StructType) -> Column:
        needed = [f.name for f in schema.fields if not f.nullable]

        def flaws(e: Column) -> Column:
            missing = F.filter(F.array(*[F.when(e[f].isNull(), F.lit(f)) for f in needed]), lambda f: f.isNotNull())
            return F.struct((e.isNull() | e[CORRUPT].isNotNull()).alias("flawed"), missing.alias("missing"))

        return bound(json_record(F.col("value"), schema), flaws)

    unknown = F.col("e").isNull()
    # A mistyped value spoils a record too, but leaves it a JSON object.
    is_object = F.json_object_keys(F.col("value").cast("string")).isNotNull()
    corrupt, mistyped = F.col("e.flawed") & ~is_object, F.col("e.flawed") & is_object
    lacking = F.size("e.missing") > 0
    return (
        messages.withColumn(EVENT_TYPE, event_type_of("topic"))
        .select("*", once(by_type(schemas, found), "e"))
        .withColumn(
            "error_type",
            F.when(unknown, "UnknownEventType")
            .when(corrupt, "CorruptRecord")
            .when(mistyped, "MistypedField")
            .when(lacking, "MissingField"),
        )
        .withColumn(
            "error_message",
            F.when(unknown, F.concat(F.lit("Unknown event type: "), F.coalesce(type_col, F.lit("null"))))
            .when(corrupt, F.lit("Payload is not a JSON object"))
            .when(mistyped, F.lit("A value does not have its field's type"))
            .when(lacking, F.concat(F.lit("Missing required fields: "), F.array_join("e.missing", ", "))),
        )
        .drop("e")
    )


def encode_json(events: DataFrame, event_type: EventType, entity_key: str, prefix: str = "events") -> DataFrame:
    """Flat events to keyed messages: key = the domain's entity, value = the JSON record."""
    names = [name for name, _, _ in fields_of(event_type, entity_key)]
    return events.select(
        F.coalesce(F.col(entity_key), F.lit("")).cast("binary").alias("key"),
        F.to_json(F.struct(*names)).cast("binary").alias("value"),
        F.lit(topic_for(event_type.name, prefix)).alias("topic"),
    )


def encode_avro(
    events: DataFrame, event_type: EventType, entity_key: str, schema_id: int, prefix: str = "events"
) -> DataFrame:
    """Registry-framed Avro: zero byte, big-endian schema id, record."""
    from pyspark.sql.avro.functions import to_avro

    names = [name for name, _, _ in fields_of(event_type, entity_key)]
    typed = [F.timestamp_millis(n).alias(n) if n == TIMESTAMP else F.col(n) for n in names]
    header = F.unhex(F.lpad(F.hex(F.lit(schema_id)), 10, "0"))
    return events.select(
        F.coalesce(F.col(entity_key), F.lit("")).cast("binary").alias("key"),
        F.concat(header, to_avro(F.struct(*typed), avro_json(event_type, entity_key))).alias("value"),
        F.lit(topic_for(event_type.name, prefix)).alias("topic"),
    )
