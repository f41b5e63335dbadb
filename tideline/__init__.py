"""tideline: event-stream and change-data analytics expressed as Spark DataFrame transforms."""

from tideline.plans.spec import (
    AggregationSpec,
    AlertSpec,
    Condition,
    Domain,
    EventType,
    SpecError,
    WindowSpec,
)
from tideline.operators.aggregate import aggregate, flatten_window
from tideline.plans.jobs import AggregationJob

__all__ = [
    "AggregationJob",
    "AggregationSpec",
    "AlertSpec",
    "Condition",
    "Domain",
    "EventType",
    "SpecError",
    "WindowSpec",
    "aggregate",
    "flatten_window",
]
