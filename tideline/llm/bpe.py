"""Byte-level BPE by tree concatenation: halves apart, joined where re-encoded windows agree.

A long text is cut in halves until a piece has ``LEAF`` characters.  The pieces are encoded
apart, wherever the cuts fall, and joined in pairs up the tree.  A join encodes a window of some
tokens on both sides of the border anew and looks for a token that the window and the left side
have in the same place, and one that the window and the right side have; up to the first the
left side holds, between them the window, after the second the right side.  Where a side does
not agree, the window grows on that side, in the end over all of it.

Why one common token is enough: the pre-tokenizer reads from left to right with a short look
ahead, so two encodings that share a token lie in the same run of letters, digits, signs or
spaces there and end it in the same place; and a row of BPE tokens is the encoding of its text
if each two neighbours are the encoding of theirs, which holds left of the token in the one and
right of it in the other.  Tokens within ``margin`` bytes of an end that the text goes on after
are never taken as common: what follows may still change them (spaces, contractions, specials).

Texts of more than ``SPREAD`` characters are cut into rows of their own, so that their pieces
are encoded by many tasks; ``FAN`` neighbours meet in one group per level of the tree.

Null and empty texts have no tokens.  The strings of special tokens inside texts become these
tokens, as the library does by default.  Repeated rows are encoded each; other columns stay, and
a column already called like the result is replaced.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tideline.llm.common import free_name, map_arrow, pieces, ship, utf8_column, written
from tideline.llm.tokens import model_path

#: Characters of a piece that is encoded at once.
LEAF = 4096
#: Characters of a text that stays in one task, and of a row's piece of a longer one.
SPREAD = 32_768
#: Rows of neighbours joined in one group.
FAN = 8
#: Tokens of each side in the first window of a join.
WINDOW = 24

#: Bytes of text encoded or decoded before the result leaves the worker.
_CHUNK = 1 << 20

# Letters, digits and spaces below this are the same in all versions of Unicode, so that the
# two libraries cut a text of them alike; other texts go to the one that defines the result.
_LATER = re.compile("[^\x00-ɏ]")
_codecs: dict[tuple, Decoder] = {}


def byte_letters() -> dict[str, int]:
    """The letter under which a byte-level vocabulary writes each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Decoder:
    """The bytes of each token of one public byte-level BPE file, and the texts of ids."""

    def __init__(self, name: str):
        with open(model_path(name), encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        )
        if not plain or spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex"):
            raise ValueError(f"{name}: no plain byte-level BPE")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{name}: special tokens that take in their surroundings")
        letters, vocabulary = byte_letters(), model["vocab"]
        last = -1
        for m in model["merges"]:
            merged = vocabulary["".join(m.split(" ") if isinstance(m, str) else m)]
            if merged < last:
                raise ValueError(f"{name}: ids are not in the order of the merges")
            last = merged
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.table = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, i in vocabulary.items():
            if token not in self.special:
                self.table[i] = bytes(map(letters.__getitem__, token))
        for token, i in self.special.items():
            self.table[i] = token.encode()
        self.sizes = np.array([len(t) for t in self.table], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.table), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of rows of ids; bytes that are no UTF-8 become replacement characters."""
        ids = ids[offsets[0] : offsets[-1]].astype(np.int64)
        sizes = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = self.flat[np.repeat(self.starts[ids] - ends[:-1], sizes) + np.arange(int(ends[-1]))]
        bounds = ends[offsets - offsets[0]]
        texts = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data.tobytes()))
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            raw = data.tobytes()
            texts = pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:])], pa.large_string())
        return texts


class Codec(Decoder):
    """Encoding and decoding under one public byte-level BPE file."""

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken

        super().__init__(name)
        self.name = name
        # What follows a token by less than this may still change it.
        self.margin = max([3, *(len(t.encode()) for t in self.special)]) + 4
        ranks = {t: i for i, t in enumerate(self.table) if t and i not in self.special.values()}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)

    @cached_property
    def exact(self):
        """The library that defines the result."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(model_path(self.name))

    def leaf(self, text: str) -> np.ndarray:
        """The ids of a text, by a library."""
        if _LATER.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode(text, allowed_special="all", disallowed_special=()), np.uint32)

    def encode(self, text: str | None, leaf: int | None = None) -> np.ndarray:
        """The ids of a whole text, from halves."""
        text, leaf = text or "", leaf or LEAF
        if len(text) <= leaf:
            return self.leaf(text) if text else np.zeros(0, np.uint32)
        level = [self.leaf(text[a:b]) for a, b in halves(len(text), leaf)]
        return self.tree(level)

    def tree(self, level: list[np.ndarray]) -> np.ndarray:
        """Neighbouring pieces joined in pairs until one is left."""
        while len(level) > 1:
            pairs = [self.join(a, b) for a, b in zip(level[::2], level[1::2])]
            level = pairs + level[len(pairs) * 2 :]
        return level[0]

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of the text of both, from the ids of each."""
        if not len(left) or not len(right):
            return left if len(left) else right
        table, a, b = self.table, WINDOW, WINDOW
        while True:
            i, j = max(0, len(left) - a), min(len(right), b)
            # The window begins and ends between characters.
            while i and table[left[i]][0] & 0xC0 == 0x80:
                i -= 1
            while j < len(right) and table[right[j]][0] & 0xC0 == 0x80:
                j += 1
            head, tail = left[i:].tolist(), right[:j].tolist()
            border = sum(len(table[t]) for t in head)
            ids = self.leaf(b"".join([table[t] for t in head + tail]).decode())
            window = self._places(ids.tolist(), 0)
            last = border + sum(len(table[t]) for t in tail)
            first = self._common(self._places(head, 0), window, border - self.margin, last=True) if i else (0, 0)
            if first is None:
                a *= 2
                continue
            goes_on = j < len(right)
            second = self._common(window, self._places(tail, border), last - self.margin) if goes_on else (len(ids), j)
            if second is None:
                b *= 2
                continue
            return np.concatenate([left[: i + first[0]], ids[first[1] : second[0]], right[second[1] :]])

    def _places(self, ids: list[int], at: int) -> dict[tuple[int, int], int]:
        """The number of each token, by its id and first byte."""
        out = {}
        for k, t in enumerate(ids):
            out[(t, at)] = k
            at += len(self.table[t])
        return out

    def _common(self, one: dict, other: dict, limit: int, last: bool = False) -> tuple[int, int] | None:
        """The numbers of the first (last) token that both have in one place and that ends before ``limit``."""
        both = [k for k in one if k in other and k[1] + len(self.table[k[0]]) <= limit]
        return (one[both[-1 if last else 0]], other[both[-1 if last else 0]]) if both else None


def halves(n: int, most: int) -> list[tuple[int, int]]:
    """``n`` characters cut in halves until none has more than ``most``."""
    parts = 1
    while n > parts * most:
        parts *= 2
    cuts = [n * k // parts for k in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def codec(name: str, kind: type[Decoder] = Codec) -> Decoder:
    """The codec of ``name``, one per worker."""
    if (name, kind) not in _codecs:
        _codecs[name, kind] = kind(name)
    return _codecs[name, kind]


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)])
    values = np.concatenate([np.zeros(0, np.uint32), *rows]).view(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _encoded(name: str):
    @arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(name)
        for batch in batches:
            # A piece of a batch at a time: what is made of it leaves before the next.
            for a, b in pieces(utf8_column(batch)[1], _CHUNK):
                yield _lists([own.encode(t) for t in batch[a:b].to_pylist()])

    return encoded


def _joined(name: str, kind: str, out: str):
    """Rows of pieces in order, as texts or as bytes of ids, to the ids of the whole."""

    @arrow_udf(out)
    def joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(name)
        for batch in batches:
            for k in range(len(batch)):
                parts = [r["piece"] for r in batch[k].as_py()]
                row = own.tree([own.encode(p) if kind == "text" else np.frombuffer(p, "<u4") for p in parts])
                yield pa.array([row.astype("<u4").tobytes()], pa.binary()) if out == "binary" else _lists([row])

    return joined


def _cut(spread: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                bounds = halves(len(text), spread)
                for k in range(0, len(bounds), 64):
                    some = bounds[k : k + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row] * len(some), pa.int64()),
                            pa.array(range(k, k + len(some)), pa.int64()),
                            pa.array([text[a:b] for a, b in some], pa.string()),
                        ],
                        names=["row", "node", "piece"],
                    )

    return cut


def _of_pieces(long: DataFrame, row: str, text: str, name: str, spread: int) -> DataFrame:
    """(row, ids) of texts whose pieces are encoded as rows of their own."""
    longest = long.agg(F.max(F.char_length(F.col(f"`{text}`")))).first()[0]
    count = len(halves(longest, spread))
    chosen = long.select(F.col(f"`{row}`").alias("row"), F.col(f"`{text}`").alias("text"))
    level = map_arrow(chosen, _cut(spread), "row long, node long, piece string")
    kind = "text"
    while True:
        count = -(-count // FAN)
        node = F.floor(F.col("node") / FAN).alias("node")
        groups = (
            level.select("row", node, F.struct("node", "piece").alias("part"))
            .groupBy("row", "node")
            .agg(F.sort_array(F.collect_list("part")).alias("parts"))
        )
        if count == 1:
            return groups.select("row", _joined(name, kind, "array<int>")("parts").alias("ids"))
        level = groups.select("row", "node", _joined(name, kind, "binary")("parts").alias("piece"))
        kind = "ids"


def with_ids(
    docs: DataFrame, name: str = "byte_bpe_50k.json", text: str = "text", ids: str = "ids", spread: int = SPREAD
) -> DataFrame:
    """``docs`` with the token ids of every whole text, as the library encodes it."""
    ship(docs.sparkSession)
    docs = docs.drop(ids) if ids != text else docs
    column = F.col(f"`{text}`")
    length = F.coalesce(F.char_length(column), F.lit(0))
    short = docs.where(length <= spread)
    short = short.withColumn(ids, _encoded(name)(column))
    row = free_name(docs, "row")
    long = written(docs.where(length > spread).withColumn(row, F.monotonically_increasing_id()), "long-texts")
    if long.isEmpty():
        return short
    found = _of_pieces(long, row, text, name, spread).select(F.col("row").alias(row), F.col("ids").alias(free_name(docs, "found")))
    result = long.join(found, row).withColumn(ids, F.col(found.columns[1]))
    return short.unionByName(result.select(*[F.col(f"`{c}`") for c in short.columns]))


def with_text(rows: DataFrame, name: str = "byte_bpe_50k.json", ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of their token ids; null ids give the empty text."""
    ship(rows.sparkSession)

    @arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(name, Decoder)
        for batch in batches:
            if batch.null_count:
                batch = pa.array([r or [] for r in batch.to_pylist()], pa.list_(pa.int32()))
            offsets, values = np.asarray(batch.offsets).astype(np.int64), np.asarray(batch.values)
            for a, b in pieces(offsets, _CHUNK // 4):
                yield own.decode(values, offsets[a : b + 1]).cast(pa.string())

    return rows.withColumn(text, decoded(F.col(f"`{ids}`")))
