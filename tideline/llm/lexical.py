"""Lower-case words of many texts at once: runs of digits, letters and all beyond ASCII."""

from __future__ import annotations

import numpy as np

from tideline.llm.text import word_spans

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[ord("0") : ord("9") + 1] = True
_INSIDE[ord("a") : ord("z") + 1] = True
_INSIDE[128:] = True


def lower_words(data: np.ndarray, offsets: np.ndarray):
    """(bytes with A-Z in lower case, starts, ends, rows) of all words of the texts."""
    base = int(offsets[0])
    data = _LOWER[data[base : int(offsets[-1])]]
    starts, ends, rows = word_spans(data, offsets - base, _INSIDE)
    return data, starts, ends, rows
