"""Event type -> record schema, as a Spark StructType and as Avro JSON text."""

from __future__ import annotations

import json

from pyspark.sql import types as T

from tideline.plans.spec import Domain, EventType, MONEY_FIELDS, SpecError

# Fields every event carries, and the default record namespace.
EVENT_ID, TIMESTAMP = "event_id", "timestamp"
NAMESPACE = "com.streaming.events"

_SPARK = {
    "string": T.StringType(),
    "money": T.LongType(),
    "long": T.LongType(),
    "timestamp-millis": T.LongType(),
    "int": T.IntegerType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}
_AVRO = {"money": "long", "float": "double", "timestamp-millis": "long", "timestamp": "long"}


def fields_of(event_type: EventType, entity_key: str) -> list[tuple[str, str, bool]]:
    """(name, type, nullable) in record order."""
    fields = [(EVENT_ID, "string", False), (TIMESTAMP, "timestamp-millis", False), (entity_key, "string", False)]
    fields += [(a, "money" if a in MONEY_FIELDS else "string", True) for a in event_type.attributes]
    fields += [(m, kind, True) for m, kind in event_type.typed_metrics()]
    for dimension in event_type.dimensions:
        money = dimension in MONEY_FIELDS
        fields.append((dimension, "money" if money else "string", money))
    names = [f[0] for f in fields]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise SpecError(f"{event_type.name}: repeated fields {repeated}")
    return fields


def struct_type(event_type: EventType, entity_key: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _SPARK[kind], nullable) for name, kind, nullable in fields_of(event_type, entity_key)]
    )


def required_fields(event_type: EventType, entity_key: str) -> list[str]:
    return [name for name, _, nullable in fields_of(event_type, entity_key) if not nullable]


def avro_schema(event_type: EventType, entity_key: str, namespace: str = NAMESPACE) -> dict:
    fields = []
    for name, kind, nullable in fields_of(event_type, entity_key):
        avro = _AVRO.get(kind, kind)
        if kind.startswith("timestamp"):
            avro = {"type": "long", "logicalType": "timestamp-millis"}
        entry = {"name": name, "type": ["null", avro] if nullable else avro}
        if nullable:
            entry["default"] = None
        fields.append(entry)
    return {"type": "record", "namespace": namespace, "name": event_type.name, "fields": fields}


def avro_json(event_type: EventType, entity_key: str, namespace: str = NAMESPACE) -> str:
    return json.dumps(avro_schema(event_type, entity_key, namespace))


def domain_schemas(domain: Domain) -> dict[str, T.StructType]:
    return {t.name: struct_type(t, domain.entity_key) for t in domain.event_types}


def from_avro_schema(schema: dict) -> T.StructType:
    """Column types for an Avro record; unions with null are nullable, millis become timestamps."""
    fields = []
    for entry in schema["fields"]:
        kind, nullable = entry["type"], False
        if isinstance(kind, list):
            nullable = "null" in kind
            kind = next(k for k in kind if k != "null")
        if isinstance(kind, dict):
            kind = "timestamp" if kind.get("logicalType") == "timestamp-millis" else kind.get("type", "string")
        fields.append(T.StructField(entry["name"], _SPARK.get(kind, T.StringType()), nullable))
    return T.StructType(fields)
