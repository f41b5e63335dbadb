"""Filters and alert conditions as Catalyst expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.plans.spec import Condition

_OPS: dict[str, Callable[[Column, Column], Column]] = {
    "eq": lambda a, b: a == b,
    "lt": lambda a, b: a < b,
    "gt": lambda a, b: a > b,
}
_QUOTED_OR_PATH = re.compile(
    r"'(?:[^'\\]|\\.|'')*'|\b(?:metrics|attributes|dimensions)\.[A-Za-z_]\w*|\bentity_id\b"
)


def condition_column(condition: Condition, resolve: Callable[[str], str], default_field: str | None = None) -> Column:
    """``field op value``; ``default_field`` is used by conditions on a measure."""
    field = condition.field or default_field
    if field is None:
        raise ValueError("condition has no field")
    name = resolve(field) if condition.field else field
    return _OPS[condition.operator](F.col(name), F.lit(condition.value))


def filter_column(where: str | Condition, resolve: Callable[[str], str]) -> Column:
    """A SQL-string or structured filter; field paths in either form become flat columns."""
    if isinstance(where, Condition):
        return condition_column(where, resolve)

    def flatten(match: re.Match) -> str:
        token = match.group(0)
        return token if token.startswith("'") else f"`{resolve(token)}`"

    return F.expr(_QUOTED_OR_PATH.sub(flatten, where))
