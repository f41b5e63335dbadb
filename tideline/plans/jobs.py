"""Run a declared aggregation by name: source, decode, custom step, aggregate, sink."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.aggregate import aggregate
from tideline.plans.schema import struct_type
from tideline.plans.spec import AggregationSpec, Condition, Domain, resolve_path
from tideline.sources.decode import EVENT_TIME, EVENT_TYPE, decode_types
from tideline.streaming.queries import StreamRunner


_TYPE_TEST = re.compile(rf"\s*{EVENT_TYPE}\s*=\s*'[^']*'\s*")


class AggregationJob:
    """The transforms of one domain, over any table or stream of messages."""

    def __init__(
        self,
        domain: Domain,
        watermark: str = "10 minutes",
        output_mode: str = "update",
        step: Callable[[DataFrame], DataFrame] | None = None,
    ):
        self.domain = domain
        self.watermark = watermark
        self.output_mode = output_mode
        self.step = step

    def events(self, messages: DataFrame, event_types: list[str], fields: list[str] | None = None) -> DataFrame:
        """Decoded events; on a stream the windowed column itself carries the watermark."""
        events = decode_types(messages, self.domain, event_types, None if self.step else fields)
        if messages.isStreaming:
            events = events.withWatermark(EVENT_TIME, self.watermark)
        return events.transform(self.step) if self.step else events

    def result(self, messages: DataFrame, name: str, event_types: list[str] | None = None, **options) -> DataFrame:
        spec: AggregationSpec = self.domain.aggregation(name)
        types = event_types or self.domain.source_types(spec)
        events = self.events(messages, types, self.fields_read(spec, types))
        return aggregate(
            events, spec, EVENT_TIME, self.domain.entity_key, output_mode=self.output_mode, **options
        )

    def fields_read(self, spec: AggregationSpec, event_types: list[str]) -> list[str] | None:
        """The record fields a spec needs, or None (all) when a SQL-string filter may name any.

        A SQL string needs none only if it is exactly one test of the event type.
        """
        if isinstance(spec.where, str) and not _TYPE_TEST.fullmatch(spec.where):
            return None
        names = [n for t in event_types for n in struct_type(self.domain.event_type(t), self.domain.entity_key).names]
        paths = [*spec.group_by]
        if spec.field:
            paths.append(spec.field)
        if isinstance(spec.where, Condition):
            paths.append(spec.where.field)
        # The event type comes from the topic, not from the record.
        return [resolve_path(path, self.domain.entity_key, names) for path in paths if path != EVENT_TYPE]

    def start(self, messages: DataFrame, name: str, runner: StreamRunner, sink=None) -> StreamingQuery:
        """Start the stream; ``sink(batch, batch_id)`` or, without one, the console."""
        result = self.result(messages, name)
        if sink is None:
            return runner.console(result, name, self.output_mode)
        return runner.foreach_batch(result, sink, name, self.output_mode)
