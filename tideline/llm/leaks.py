"""Benchmark decontamination: short test items found inside long documents.

A min-hash comparison needs sets of like size, so both sides are partitioned by size.  Items fall
into classes of up to U = 1, 2, 4, ... shingles.  For each class that occurs, a document is cut
into windows of two neighbouring blocks of U shingles: wherever an item of the class lies, one
window holds it, and their Jaccard similarity is above 1/4 (0.19 if the item is there to 80 %).
``POSITIONS`` min-hash tokens, one of which has to agree, miss such a pair with a chance below
1e-4.  Candidates are then checked exactly: the share of the item's distinct shingles that the
whole document holds.  Documents stay in their partition; the items are sent to every executor in
shards of bounded size, each shard being one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import map_arrow, pieces, utf8_column
from tideline.llm.text import shingles, word_hashes, word_spans

POSITIONS = 48
#: Most bytes of item text in one shard, which is what an executor holds of the items.
SHARD_BYTES = 8_000_000

_rng = np.random.default_rng(7)
_SEEDS = _rng.integers(0, 2**32, POSITIONS, dtype=np.uint32)
_ODDS = _rng.integers(0, 2**31, POSITIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


class Index:
    """The items of one shard: their shingles, and their tokens by shingle length and size class."""

    def __init__(self, items: list[tuple[int | None, str]], n: int = 5):
        self.ids = [i for i, _ in items]
        self.sets: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(items)
        by_class: dict[tuple[int, int], list[int]] = {}
        for k, (_, text) in enumerate(items):
            data, offsets = utf8_column(pa.array([text], pa.string()))
            starts, ends, rows = word_spans(data, offsets)
            if not len(starts):
                continue
            length = min(n, len(starts))
            values, _ = shingles(word_hashes(data, starts, ends), rows, length, short=False)
            self.sets[k] = np.unique(values)
            size = 1 << (len(self.sets[k]) - 1).bit_length()
            by_class.setdefault((length, size), []).append(k)
        # length -> [(size class, per position: sorted tokens, their items, a table of low bits)]
        self.classes: dict[int, list] = {}
        for (length, size), members in sorted(by_class.items()):
            parts = []
            for p in range(POSITIONS):
                tokens = np.array([_tokens(self.sets[k], p).min() for k in members], np.uint32)
                order = np.argsort(tokens, kind="stable")
                present = np.zeros(1 << 16, bool)
                present[tokens & np.uint32(0xFFFF)] = True
                parts.append((tokens[order], np.array(members)[order], present))
            self.classes.setdefault(length, []).append((size, parts))

    def candidates(self, length: int, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Distinct (row, item) pairs, one window of the row sharing a token with the item."""
        classes = self.classes[length]
        heads = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        lengths = np.diff(np.concatenate([heads, [len(rows)]]))
        inner = np.arange(len(rows)) - np.repeat(heads, lengths)
        x = (values >> np.uint64(32)).astype(np.uint32)
        found = []
        smallest = classes[0][0]
        starts = np.flatnonzero(inner % smallest == 0)
        coarser = []  # per class: the first fine block of each of its blocks, and their rows
        for size, _ in classes:
            blocks = np.flatnonzero(inner[starts] % size == 0)
            coarser.append((blocks, rows[starts[blocks]]))
        for p in range(POSITIONS):
            fine = np.minimum.reduceat((x ^ _SEEDS[p]) * _ODDS[p], starts)
            for (size, parts), (blocks, at) in zip(classes, coarser):
                tokens, members, present = parts[p]
                least = np.minimum.reduceat(fine, blocks)
                together = at[1:] == at[:-1]
                window = least.copy()
                np.minimum(window[:-1], least[1:], out=window[:-1], where=together)
                hit = np.flatnonzero(present[window & np.uint32(0xFFFF)])
                if not len(hit):
                    continue
                a = np.searchsorted(tokens, window[hit], "left")
                count = np.searchsorted(tokens, window[hit], "right") - a
                total = int(count.sum())
                if total:
                    first = np.repeat(a - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
                    found.append(np.stack([np.repeat(at[hit], count), members[first + np.arange(total)]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def search(self, data: np.ndarray, offsets: np.ndarray, least: float) -> list[tuple[int, int, int]]:
        """(row, item, shared shingles) of every item that a text holds to ``least`` or more."""
        starts, ends, rows = word_spans(data, offsets)
        hashes = word_hashes(data, starts, ends)
        out = []
        for length in self.classes:
            values, at = shingles(hashes, rows, length, short=False)
            if not len(values):
                continue
            row, held = -1, values[:0]
            for r, k in self.candidates(length, values, at).tolist():
                if r != row:
                    row = r
                    held = np.unique(values[np.searchsorted(at, r, "left") : np.searchsorted(at, r, "right")])
                s = self.sets[k]
                where = np.minimum(np.searchsorted(held, s), len(held) - 1)
                shared = int(np.count_nonzero(held[where] == s))
                if shared >= least * len(s) - 1e-9:
                    out.append((r, k, shared))
        return out


def _tokens(values: np.ndarray, position: int) -> np.ndarray:
    return ((values >> np.uint64(32)).astype(np.uint32) ^ _SEEDS[position]) * _ODDS[position]


def _shards(items: DataFrame, item_id: str, text: str, n: int) -> Iterator[Index]:
    """The distinct items in shards of bounded size."""
    rows = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.where("text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    # A shard holds half the bound on average, so hashing unevenly does not pass the bound.
    count = max(1, -(-2 * int(total) // SHARD_BYTES))
    for shard in range(count):
        own = rows if count == 1 else rows.where(F.pmod(F.xxhash64("text", F.lit(9)), F.lit(count)) == shard)
        yield Index([(r["item_id"], r["text"]) for r in own.orderBy("item_id", "text").collect()], n)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: float = 0.8,
    n: int = 5,
) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment``: every item that a document holds.

    Containment is the share of the item's distinct word ``n``-grams that stand in the document;
    ``least`` or more counts.  An item of fewer than ``n`` words is one run of all its words; items
    without words are in no document.  Repeated documents give a row each, repeated items one.
    Words are runs of anything but space and control characters 9 to 13, compared as they are.
    """
    kept = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = "doc_id long, item_id long, n_item long, n_shared long, containment double"
    found = None
    for index in _shards(items, item_id, item_text, n):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                data, offsets = utf8_column(batch.column(1))
                for first, end in pieces(offsets, 1 << 20):
                    hits = index.search(data, offsets[first : end + 1], least)
                    sizes = [len(index.sets[k]) for _, k, _ in hits]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array([first + r for r, _, _ in hits], pa.int64())),
                            pa.array([index.ids[k] for _, k, _ in hits], pa.int64()),
                            pa.array(sizes, pa.int64()),
                            pa.array([s for _, _, s in hits], pa.int64()),
                            pa.array([s / m for (_, _, s), m in zip(hits, sizes)], pa.float64()),
                        ],
                        names=["doc_id", "item_id", "n_item", "n_shared", "containment"],
                    )

        part = map_arrow(kept, run, schema)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", least: float = 0.8, n: int = 5, **columns
) -> DataFrame:
    """``docs`` without the rows that hold an item; no row leaves its partition."""
    at = docs.columns.index(text)
    clean = docs
    for index in _shards(items, columns.get("item_id", "item_id"), columns.get("item_text", "text"), n):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = utf8_column(batch.column(at))
                keep = np.ones(batch.num_rows, bool)
                for first, end in pieces(offsets, 1 << 20):
                    for r, _, _ in shared.value.search(data, offsets[first : end + 1], least):
                        keep[first + r] = False
                yield batch.filter(pa.array(keep))

        clean = map_arrow(clean, run, docs.schema)
    return clean
