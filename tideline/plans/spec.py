"""Declarative specs: event types, windowed aggregations, alerts and domains.

Specs are plain data.  ``from_dict`` accepts the keys a domain file uses; everything is
validated here, before any plan is built.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from tideline.functions.times import duration_micros


class SpecError(ValueError):
    """A spec that cannot be turned into a plan."""


# Measure column per aggregate type.
MEASURES = {
    "count": "count",
    "count_distinct": "unique_count",
    "sum": "total",
    "avg": "average",
}
WINDOW_KINDS = ("tumbling", "sliding")
DEFAULT_SLIDE = "1 minute"

# Accepted operator spellings.
_OPERATORS = {"eq": "eq", "lt": "lt", "gt": "gt", "less_than": "lt", "greater_than": "gt"}

# Fields that hold money in whole cents, whatever their category.
MONEY_FIELDS = ("price", "total_amount", "unit_price", "revenue", "cost", "amount")
FIELD_TYPES = ("money", "float", "double", "long", "int", "boolean", "string", "timestamp")


@dataclass(frozen=True)
class WindowSpec:
    kind: str
    size: str
    slide: str | None = None

    def __post_init__(self):
        if self.kind not in WINDOW_KINDS:
            raise SpecError(f"unknown window type: {self.kind}")
        try:
            duration_micros(self.size)
            if self.kind == "sliding":
                if self.slide is None:
                    object.__setattr__(self, "slide", DEFAULT_SLIDE)
                duration_micros(self.slide)
        except (TypeError, ValueError) as err:
            raise SpecError(f"bad window duration: {err}") from err

    @classmethod
    def from_dict(cls, raw: dict) -> WindowSpec:
        size = raw["size"] if "size" in raw else raw.get("duration")
        return cls(raw.get("type"), size, raw.get("slide"))


@dataclass(frozen=True)
class Condition:
    """``field operator value``; ``field`` is empty for a condition on an aggregate's measure."""

    operator: str
    value: object
    field: str | None = None

    def __post_init__(self):
        if self.operator not in _OPERATORS:
            raise SpecError(f"unknown operator: {self.operator}")
        object.__setattr__(self, "operator", _OPERATORS[self.operator])

    @classmethod
    def from_dict(cls, raw: dict) -> Condition:
        return cls(raw["operator"], raw["value"], raw.get("field"))


@dataclass(frozen=True)
class AggregationSpec:
    name: str
    kind: str
    window: WindowSpec
    field: str | None = None
    where: str | Condition | None = None
    group_by: tuple[str, ...] = ()
    # Event types the aggregation reads; empty means every type of its domain.
    event_types: tuple[str, ...] = ()

    def __post_init__(self):
        if self.kind not in MEASURES:
            raise SpecError(f"unknown aggregation type: {self.kind}")
        if self.kind != "count" and not self.field:
            raise SpecError(f"{self.name}: {self.kind} needs a field")

    @property
    def measure(self) -> str:
        return MEASURES[self.kind]

    @classmethod
    def from_dict(cls, raw: dict) -> AggregationSpec:
        where = raw.get("filter")
        return cls(
            name=raw["name"],
            kind=raw["type"],
            window=WindowSpec.from_dict(raw["window"]),
            field=raw.get("field"),
            where=Condition.from_dict(where) if isinstance(where, dict) else where,
            group_by=tuple(raw.get("group_by") or ()),
            event_types=tuple(raw.get("event_types") or ()),
        )


@dataclass(frozen=True)
class AlertSpec:
    """Either ``metric`` (an aggregation's name) or ``event_type`` is set."""

    name: str
    condition: Condition
    severity: str
    metric: str | None = None
    event_type: str | None = None
    cooldown: str | None = None

    def __post_init__(self):
        if (self.metric is None) == (self.event_type is None):
            raise SpecError(f"{self.name}: set exactly one of metric and event_type")
        if self.event_type and not self.condition.field:
            raise SpecError(f"{self.name}: an event alert needs a field")
        if self.cooldown is not None:
            duration_micros(self.cooldown)

    @classmethod
    def from_dict(cls, raw: dict) -> AlertSpec:
        return cls(
            name=raw["name"],
            condition=Condition.from_dict(raw["condition"]),
            severity=raw["severity"],
            metric=raw.get("metric"),
            event_type=raw.get("event_type"),
            cooldown=raw.get("cooldown"),
        )


@dataclass(frozen=True)
class EventType:
    """A flat record type.  ``metrics`` entries are names or (name, type) pairs."""

    name: str
    attributes: tuple[str, ...] = ()
    metrics: tuple[str | tuple[str, str], ...] = ()
    dimensions: tuple[str, ...] = ()

    def __post_init__(self):
        for _, kind in self.typed_metrics():
            if kind not in FIELD_TYPES:
                raise SpecError(f"{self.name}: unknown field type {kind}")

    def typed_metrics(self) -> list[tuple[str, str]]:
        typed = []
        for metric in self.metrics:
            name, kind = (metric, "double") if isinstance(metric, str) else metric
            typed.append((name, "money" if name in MONEY_FIELDS else kind))
        return typed

    @classmethod
    def from_dict(cls, raw: dict) -> EventType:
        metrics = tuple(
            m if isinstance(m, str) else (m["name"], m.get("type", "double"))
            for m in raw.get("metrics") or ()
        )
        return cls(
            name=raw["name"],
            attributes=tuple(raw.get("attributes") or ()),
            metrics=metrics,
            dimensions=tuple(raw.get("dimensions") or ()),
        )


@dataclass(frozen=True)
class Domain:
    name: str
    entity_key: str
    event_types: tuple[EventType, ...]
    aggregations: tuple[AggregationSpec, ...] = ()
    alerts: tuple[AlertSpec, ...] = ()
    samples: dict[str, tuple[str, ...]] = field(default_factory=dict)
    synthetic: dict = field(default_factory=dict)

    def event_type(self, name: str) -> EventType:
        for candidate in self.event_types:
            if candidate.name == name:
                return candidate
        known = [t.name for t in self.event_types]
        raise SpecError(f"unknown event type: {name}; known: {known}")

    def aggregation(self, name: str) -> AggregationSpec:
        for candidate in self.aggregations:
            if candidate.name == name:
                return candidate
        raise SpecError(f"aggregation not found: {name}")

    def alert(self, name: str) -> AlertSpec:
        for candidate in self.alerts:
            if candidate.name == name:
                return candidate
        raise SpecError(f"alert not found: {name}")

    def source_types(self, spec: AggregationSpec) -> list[str]:
        return list(spec.event_types) or [t.name for t in self.event_types]

    @classmethod
    def from_dict(cls, raw: dict) -> Domain:
        alerts = raw.get("alerts") or {}
        return cls(
            name=raw.get("domain", "domain"),
            entity_key=raw["entity"]["primary_key"],
            event_types=tuple(EventType.from_dict(e) for e in raw.get("event_types") or ()),
            aggregations=tuple(AggregationSpec.from_dict(a) for a in raw.get("aggregations") or ()),
            alerts=tuple(
                AlertSpec.from_dict(a)
                for a in [*(alerts.get("metric_alerts") or ()), *(alerts.get("event_alerts") or ())]
            ),
            samples={k: tuple(v) for k, v in (raw.get("sample_data") or {}).items()},
            synthetic=raw.get("synthetic") or {},
        )


def resolve_path(path: str, entity_key: str | None, columns: list[str]) -> str:
    """Map ``metrics.x`` / ``attributes.x`` / ``dimensions.x`` / ``entity_id`` to a flat column.

    ``<money>_cents`` names the money field itself, which already holds cents.
    """
    head, _, tail = path.partition(".")
    name = tail if tail and head in ("metrics", "attributes", "dimensions") else path
    if name == "entity_id" and entity_key:
        name = entity_key
    if name not in columns and name.endswith("_cents") and name[: -len("_cents")] in columns:
        name = name[: -len("_cents")]
    if name not in columns:
        raise SpecError(f"field {path!r} is not one of {columns}")
    return name
