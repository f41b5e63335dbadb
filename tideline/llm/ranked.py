"""Ranked lexical search by hashed max-sketches and exact rescoring in descending order of bounds.

The index holds one row per document: its number of terms, a sketch, and its exact terms.  The
sketch folds the impacts of all terms that hash to one of ``COORDINATES`` coordinates into their
maximum; only coordinates that are not zero are stored.  An impact grows with the term's
frequency alone once the document is given, so the sketch keeps the largest frequency and needs
no statistics of the corpus: the index can be added to, and the impact is worked out at search.

A search takes the items in blocks.  For a batch of documents one lookup of all coordinates that
any item of the block uses gives, for each document and item, the sum of weight times impact
bound: never less than the score.  First the documents with the highest bounds of each item are
scored exactly, and the ``k``-th best of these scores is a threshold that the result cannot fall
below.  Then every document whose bound reaches the threshold of an item is scored from its exact
terms, in descending order of bounds, until the next bound is below the k-th best score so far.
Equal bounds go by ascending id, so that of many copies only those are scored that may still
enter.  No pair of a document and an item leaves a task but the k best.

Terms are told apart by 64-bit hashes.  Null and empty texts have no terms: such documents are
never found, such items find nothing.  Repeated documents and items are found and answered each;
equal scores go by ascending id (null last).  Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import map_arrow, pieces, utf8_column, written
from tideline.llm.lexical import lower_words
from tideline.llm.text import word_hashes

COORDINATES = 1 << 16
TOP = 50
#: Documents scored for the first threshold, by item.
FIRST = 100
#: Most items of a block on average, and bytes of their texts.
BLOCK_ITEMS = 256
BLOCK_BYTES = 4 << 20
#: Tasks that merge the best of one item, before the last.
SALTS = 16

_CHUNK = 1 << 20
_ROWS = 512  # documents looked up at once
_SCALE = 1_000_000_000
_ENTRIES = 1 << 18
_FULL = 65_535  # a frequency of this or more, for the bound as good as endless


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every term of the texts."""
    data, starts, ends, rows = lower_words(data, offsets)
    return word_hashes(data, starts, ends), rows


def indexed(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of ``docs``: (row, id, n, coordinates, peaks, hashes, tfs), stored."""
    kind = dict(docs.dtypes)[id]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_column(batch.column(1))
            for a, b in pieces(offsets, _CHUNK):
                hashes, rows = term_hashes(data, offsets[a : b + 1])
                bounds = np.searchsorted(rows, np.arange(b - a + 1))
                out = [[], [], [], []]
                for k in range(b - a):
                    terms, tf = np.unique(hashes[bounds[k] : bounds[k + 1]], return_counts=True)
                    at = (terms >> np.uint64(48)).astype(np.uint16)  # in order, as the hashes are
                    heads = np.flatnonzero(np.concatenate([[len(at) > 0], at[1:] != at[:-1]])) if len(at) else np.zeros(0, int)
                    peaks = np.maximum.reduceat(tf, heads) if len(heads) else tf
                    out[0].append(at[heads].astype("<u2").tobytes())
                    out[1].append(np.minimum(peaks, _FULL).astype("<u2").tobytes())
                    out[2].append(terms.astype("<u8").tobytes())
                    out[3].append(tf.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(bounds), pa.int64()), *(pa.array(c, pa.binary()) for c in out)],
                    names=["id", "n", "coordinates", "peaks", "hashes", "tfs"],
                )

    chosen = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    built = map_arrow(chosen, build, f"id {kind}, n long, coordinates binary, peaks binary, hashes binary, tfs binary")
    return written(built.withColumn("row", F.monotonically_increasing_id()), "lexical-index")


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of ranges one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


@dataclass
class Block:
    """Some items and what is known of their terms; goes to every task."""

    names: list  # of the items
    terms: np.ndarray  # hashes, ascending
    documents: int
    total: int
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    # Items of each term: those of term t are items[starts[t]:starts[t + 1]].
    items: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """20 times the length factor of documents with ``n`` terms."""
        return 20 * (100 - 50 + (50 * n * self.documents) // max(self.total, 1))

    @cached_property
    def at_coordinate(self) -> np.ndarray:
        """The terms of each coordinate, which are neighbours: those of c from [c] to [c + 1]."""
        return np.searchsorted((self.terms >> np.uint64(48)).astype(np.int64), np.arange(COORDINATES + 1))

    def sums(self, rows: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_rows: int) -> np.ndarray:
        """By row and item the sum of weight times impact over (row, term, impact)."""
        out = np.zeros(n_rows * len(self.names), np.int64)
        sizes = self.starts[terms + 1] - self.starts[terms]
        values = self.weights[terms] * impacts
        ends = np.cumsum(sizes)
        at = 0
        while at < len(terms):  # some entries at once, however many the documents have
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _ENTRIES)))
            places = _ranges(self.starts[terms[at:to]], sizes[at:to])
            cells = np.repeat(rows[at:to] * len(self.names), sizes[at:to]) + self.items[places]
            np.add.at(out, cells, np.repeat(values[at:to], sizes[at:to]))
            at = to
        return out.reshape(n_rows, len(self.names))

    def bounds(self, n: np.ndarray, coordinates: list[bytes], peaks: list[bytes]) -> np.ndarray:
        """Upper bounds of the scores of some documents for all items."""
        at = np.frombuffer(b"".join(coordinates), "<u2")
        peak = np.frombuffer(b"".join(peaks), "<u2").astype(np.int64)
        rows = np.repeat(np.arange(len(n)), [len(c) // 2 for c in coordinates])
        first = self.at_coordinate
        sizes = first[at.astype(np.int64) + 1] - first[at]
        used = np.flatnonzero(sizes)
        at, peak, rows, sizes = at[used], peak[used], rows[used], sizes[used]
        impact = np.where(peak == _FULL, _SCALE // 1000, (_SCALE * peak) // (1000 * peak + self.lengths(n)[rows]))
        terms = _ranges(first[at], sizes)
        return self.sums(np.repeat(rows, sizes), terms, np.repeat(impact, sizes), len(n))

    def scores(self, n: np.ndarray, hashes: list[bytes], tfs: list[bytes]) -> np.ndarray:
        """The scores of some documents for all items."""
        terms = np.frombuffer(b"".join(hashes), "<u8")
        tf = np.frombuffer(b"".join(tfs), "<u4").astype(np.int64)
        rows = np.repeat(np.arange(len(n)), [len(h) // 8 for h in hashes])
        found = self.found(terms)
        kept = np.flatnonzero(found >= 0)
        rows, tf = rows[kept], tf[kept]
        return self.sums(rows, found[kept], (_SCALE * tf) // (1000 * tf + self.lengths(n)[rows]), len(n))

    def found(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of the terms with these hashes, -1 for others."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)


def _block(index: DataFrame, rows: list, documents: int, total: int) -> Block | None:
    """The block of some (item, text) rows, with the weights of their terms; None without terms."""
    data, offsets = utf8_column(pa.array([r["text"] for r in rows], pa.string()))
    hashes, at = term_hashes(data, offsets)
    terms, which = np.unique(hashes, return_inverse=True)
    if not len(terms):
        return None
    pairs = np.unique(which.astype(np.int64) * len(rows) + at)  # once for each item
    block = Block([r["item"] for r in rows], terms, documents, total)
    block.items = pairs % len(rows)
    block.starts = np.searchsorted(pairs // len(rows), np.arange(len(terms) + 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(terms), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                found = block.found(np.frombuffer(b"".join(batch.column(0).slice(at, _ROWS).to_pylist()), "<u8"))
                df += np.bincount(found[found >= 0], minlength=len(terms))
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(df[used])], names=["term", "df"])

    df = np.zeros(len(terms), np.int64)
    for r in map_arrow(index.select("hashes"), count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    block.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    return block


def _order(values: np.ndarray, ids: list) -> np.ndarray:
    """Numbers by descending value, then ascending id, nulls last."""
    by_id = sorted(range(len(ids)), key=lambda k: (ids[k] is None, 0 if ids[k] is None else ids[k]))
    rank = np.empty(len(ids), np.int64)
    rank[by_id] = np.arange(len(ids))
    return np.lexsort((rank, -values))


def _best(rows: DataFrame, k: int, value: str) -> DataFrame:
    """The ``k`` best rows of each item: first in each of some shares of its rows, then among these."""
    order = [F.desc(value), F.col("id").asc_nulls_last(), "row"]
    some = Window.partitionBy("item", F.pmod(F.xxhash64("row"), F.lit(SALTS))).orderBy(*order)
    all_rows = Window.partitionBy("item").orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    return rows.withColumn("rank", F.row_number().over(all_rows)).where(F.col("rank") <= k)


def _after(value: int, id, last: tuple) -> bool:
    """Whether a document with this score or bound comes after the last of the best."""
    if value != last[0]:
        return value < last[0]
    return last[1] is not None and (id is None or id > last[1])


def _highest_bounds(index: DataFrame, block: Block, kind: str, first: int) -> DataFrame:
    """(item, value, id, row) of the documents with the highest bounds for each item."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in block.names]
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                row, ids, n, coordinates, peaks = (c.to_pylist() if k != 2 else c.to_numpy() for k, c in enumerate(part.columns))
                bounds = block.bounds(n, coordinates, peaks)
                for item, own in enumerate(held):
                    column = bounds[:, item]
                    some = np.flatnonzero(column > (own[-1][0] - 1 if len(own) == first else 0))
                    if len(some):
                        own.extend((int(column[k]), ids[k], row[k]) for k in some.tolist())
                        own.sort(key=lambda r: (-r[0], r[1] is None, 0 if r[1] is None else r[1], r[2]))
                        del own[first:]
        flat = [(item, *r) for item, own in enumerate(held) for r in own]
        yield _pairs(flat, batch_type)

    batch_type = index.schema["id"].dataType
    found = map_arrow(index.select("row", "id", "n", "coordinates", "peaks"), bound, f"item int, value long, id {kind}, row long")
    return _best(found, first, "value")


def _pairs(flat: list[tuple], id_type) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type

    columns = list(zip(*flat)) if flat else [()] * 4
    types = [pa.int32(), pa.int64(), to_arrow_type(id_type), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["item", "value", "id", "row"])


def _thresholds(index: DataFrame, block: Block, kind: str, k: int, first: int) -> dict[int, tuple]:
    """By item the (score, id) of the k-th best of the documents with the highest bounds."""
    chosen = _highest_bounds(index, block, kind, first).select("item", "row")
    # At most ``first`` rows for each item of a block.
    own = index.select("row", "id", "n", "hashes", "tfs").join(F.broadcast(chosen), "row")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, ids, n, hashes, tfs, item = (c.to_numpy() if k in (2, 5) else c.to_pylist() for k, c in enumerate(batch.columns))
            flat = []
            for at in range(0, len(row), _ROWS):
                cut = slice(at, at + _ROWS)
                scores = block.scores(n[cut], hashes[cut], tfs[cut])[np.arange(len(row[cut])), item[cut]]
                flat += zip(item[cut].tolist(), scores.tolist(), ids[cut], row[cut])
            yield _pairs(flat, id_type)

    id_type = index.schema["id"].dataType
    scored = map_arrow(own.select("row", "id", "n", "hashes", "tfs", "item"), exact, f"item int, value long, id {kind}, row long")
    last = _best(scored, k, "value").where((F.col("rank") == k) & (F.col("value") > 0))
    return {r["item"]: (r["value"], r["id"]) for r in last.collect()}


def _rescored(index: DataFrame, block: Block, kind: str, k: int, thresholds: dict[int, tuple]) -> DataFrame:
    """(item, value, id, row) of the best documents of each task for each item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in block.names]
        last = [thresholds.get(item, (1, None)) for item in range(len(block.names))]
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                row, ids, n, coordinates, peaks = (c.to_numpy() if i == 2 else c.to_pylist() for i, c in enumerate(part.columns[:5]))
                bounds = block.bounds(n, coordinates, peaks)
                exact: dict[int, np.ndarray] = {}  # each document is scored once, for all items
                for item, own in enumerate(best):
                    column = bounds[:, item]
                    some = np.flatnonzero(column >= last[item][0])
                    if not len(some):
                        continue
                    some = some[_order(column[some], [ids[s] for s in some])]
                    for start in range(0, len(some), 16):
                        now = [s for s in some[start : start + 16].tolist() if not _after(int(column[s]), ids[s], last[item])]
                        new = [s for s in now if s not in exact]
                        if new:
                            scores = block.scores(n[new], [part.column(5)[s].as_py() for s in new], [part.column(6)[s].as_py() for s in new])
                            exact.update(zip(new, scores))
                        own.extend((int(exact[s][item]), ids[s], row[s]) for s in now if exact[s][item] > 0)
                        own.sort(key=lambda r: (-r[0], r[1] is None, 0 if r[1] is None else r[1], r[2]))
                        del own[k:]
                        if len(own) == k and _after(last[item][0], last[item][1], own[-1]):
                            last[item] = own[-1][:2]
                        if int(column[some[min(start + 16, len(some)) - 1]]) < last[item][0]:
                            break
        yield _pairs([(item, *r) for item, own in enumerate(best) for r in own], id_type)

    id_type = index.schema["id"].dataType
    columns = ["row", "id", "n", "coordinates", "peaks", "hashes", "tfs"]
    return map_arrow(index.select(*columns), search, f"item int, value long, id {kind}, row long")


def searched(
    index: DataFrame,
    items: DataFrame,
    k: int = TOP,
    item: str = "item_id",
    text: str = "text",
    id: str = "doc_id",
    first: int = FIRST,
) -> DataFrame:
    """(item, rank, id, score): the ``k`` best documents of ``index`` for each row of ``items``."""
    spark = index.sparkSession
    kind, item_kind = dict(index.dtypes)["id"], dict(items.dtypes)[item]
    counts = index.where("n > 0").agg(F.count("*").alias("documents"), F.sum("n").alias("total")).first()
    given = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text"))
    size = given.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-size["rows"] // BLOCK_ITEMS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    results = []
    for number in range(blocks):
        own = given.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
        rows = own.collect()
        block = _block(index, rows, counts["documents"], counts["total"] or 0) if counts["documents"] else None
        if block is None:
            continue
        thresholds = _thresholds(index, block, kind, k, first)
        found = _best(_rescored(index, block, kind, k, thresholds), k, "value")
        names = spark.createDataFrame([(n, r["item"]) for n, r in enumerate(rows)], f"item int, name {item_kind}")
        named = found.join(F.broadcast(names), "item")
        named = named.select(F.col("name").alias(item), "rank", F.col("id").alias(id), F.col("value").alias("score"))
        # With several blocks each is written before the next begins.
        results.append(named if blocks == 1 else written(named, "lexical-found"))
    empty = spark.createDataFrame([], f"`{item}` {item_kind}, rank int, `{id}` {kind}, score long")
    for result in results:
        empty = empty.unionByName(result)
    return results[0] if len(results) == 1 else empty
