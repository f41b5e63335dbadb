"""Topic names, money and binary framing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bytes in front of a registry-framed Avro payload: one magic byte, four schema-id bytes.
REGISTRY_HEADER_BYTES = 5


def topic_for(event_type: str, prefix: str = "events") -> str:
    return f"{prefix}.{event_type}"


def event_type_of(topic: Column | str) -> Column:
    """``events.purchase`` -> ``purchase``."""
    return F.substring_index(topic, ".", -1)


def topic_schema_and_table(topic: Column | str) -> tuple[Column, Column]:
    """``server.schema.table`` -> (schema, table); short topics are tables of ``public``."""
    column = F.col(topic) if isinstance(topic, str) else topic
    parts = F.split(column, r"\.")
    schema = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("public"))
    table = F.coalesce(F.try_element_at(parts, F.lit(3)), column)
    return schema, table


def strip_registry_header(value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.substring(column, REGISTRY_HEADER_BYTES + 1, 2_147_483_647)


def to_cents(amount: Column | str) -> Column:
    """Currency amount to whole cents, so that sums are exact and order-independent."""
    cents = (F.col(amount) if isinstance(amount, str) else amount) * 100
    # Half away from zero.  round() on a double goes through a decimal object per row.
    return F.when(cents < 0, F.ceil(cents - 0.5)).otherwise(F.floor(cents + 0.5))
