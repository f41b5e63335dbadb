"""Event time, epoch milliseconds and interval arithmetic."""

from __future__ import annotations

import re
from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
_DURATION = re.compile(r"\s*(\d+)\s+([a-z]+?)s?\s*", re.IGNORECASE)
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def duration_micros(text: str) -> int:
    """Length of a fixed duration such as ``5 minutes`` in microseconds."""
    match = _DURATION.fullmatch(text)
    if not match or match.group(2).lower() not in _MICROS or int(match.group(1)) == 0:
        raise ValueError(f"not a fixed positive duration: {text!r}")
    return int(match.group(1)) * _MICROS[match.group(2).lower()]


def duration_text(micros: int) -> str:
    return f"{micros} microseconds"


def common_pane(size: str, slide: str) -> str:
    """The longest duration that divides both window size and slide."""
    return duration_text(gcd(duration_micros(size), duration_micros(slide)))


def event_time(millis: Column | str) -> Column:
    """Epoch milliseconds to an instant (a plain cast would read the long as seconds)."""
    return F.timestamp_millis(F.col(millis) if isinstance(millis, str) else millis)


def epoch_millis(instant: Column | str) -> Column:
    return F.unix_millis(F.col(instant) if isinstance(instant, str) else instant)


def _wall_micros(name: str) -> str:
    # unix_timestamp() of a zoneless time ignores the session zone but drops the fraction;
    # the fraction survives a cast, because zone offsets are whole seconds.
    return f"(unix_timestamp(`{name}`) * 1000000L + pmod(unix_micros(cast(`{name}` as timestamp)), 1000000L))"


def wall_micros(name: str) -> Column:
    """Microseconds since the epoch of a zoneless UTC wall time."""
    return F.expr(_wall_micros(name))


def wall_millis(name: str) -> Column:
    return F.expr(f"{_wall_micros(name)} div 1000L")


def wall_to_instant(name: str) -> Column:
    """A zoneless UTC wall time as an instant, whatever the session time zone is."""
    return F.expr(f"timestamp_micros({_wall_micros(name)})")


def instant_to_wall(name: str) -> Column:
    """An instant as zoneless UTC wall time, whatever the session time zone is."""
    return micros_to_wall(f"unix_micros(`{name}`)")


def micros_to_wall(micros: str) -> Column:
    """SQL text of epoch microseconds to zoneless UTC wall time."""
    return F.expr(f"timestampadd(MICROSECOND, {micros}, {_EPOCH})")
