"""What the operators of this subpackage share: stored tables, Arrow columns."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.session import ship
from tideline.session import stored as written

__all__ = ["WORD", "free_name", "map_arrow", "pieces", "sampled", "ship", "utf8_column", "written"]

# Words are runs of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def map_arrow(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with the package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever its other columns are called."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def sampled(hashed: Column, wanted: int, total: int) -> Column:
    """Whether a row is in a sample of about ``wanted`` of ``total`` rows, by its 64-bit hash.

    The threshold has 40 bits and is never 0, so a sample of a very large table is not empty.
    """
    share = min(1.0, wanted / total) if total else 1.0
    return F.shiftrightunsigned(hashed, 24) < F.lit(math.ceil(share * (1 << 40)))


def utf8_column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null counts as the empty string."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def pieces(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows holding about ``size`` bytes each, at least one row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end
