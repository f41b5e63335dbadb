"""Fragments of the checking SQL."""

from __future__ import annotations

import zlib

SEED = 42
_PRIME = 2_147_483_647
_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def _micros(text: str) -> int:
    """Microseconds of a duration such as ``5 minutes``."""
    number, unit = text.split()
    return int(number) * _MICROS[unit.removesuffix("s")]


def tumbling(us: str, size: str) -> tuple[str, str]:
    """(start, end) of the epoch-aligned window around a microsecond expression."""
    w = _micros(size)
    return f"make_timestamp(({us} // {w}) * {w})", f"make_timestamp(({us} // {w}) * {w} + {w})"


def sliding(us: str, size: str, slide: str) -> tuple[str, str, str]:
    """(start, end, copies): cross the rows with ``generate_series(0, copies - 1) g(i)``."""
    w, s = _micros(size), _micros(slide)
    start = f"(({us} // {s}) - i) * {s}"
    return f"make_timestamp({start})", f"make_timestamp({start} + {w})", f"generate_series(0, {w // s - 1}) g(i)"


def draw(id_column: str, purpose: str, seed: int = SEED) -> str:
    # The definition of a draw: an affine map whose factors are checksums of what it is for.
    slope = zlib.crc32(f"{seed}:{purpose}:slope".encode()) % (_PRIME - 1) + 1
    offset = zlib.crc32(f"{seed}:{purpose}:offset".encode()) % _PRIME
    residue = f"(({id_column} % {_PRIME} + {id_column} // {_PRIME} % {_PRIME} * 16807) % {_PRIME})"
    return f"(({residue} * {slope} + {offset}) % {_PRIME})"


def draw_between(id_column: str, purpose: str, low: int, high: int, seed: int = SEED) -> str:
    return f"({draw(id_column, purpose, seed)} % {high - low + 1} + {low})"


def pick(id_column: str, name: str, choices: tuple[str, ...], seed: int = SEED) -> str:
    items = ", ".join("'" + c.replace("'", "''") + "'" for c in choices)
    return f"list_value({items})[{draw_between(id_column, name, 1, len(choices), seed)}]"


def nullable(id_column: str, name: str, value: str, seed: int = SEED) -> str:
    return f"CASE WHEN {draw(id_column, name + '?', seed)} % 1000 >= 100 THEN {value} END"
