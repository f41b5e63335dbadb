"""Token counts by a two-tier lookup of pre-tokens, without shuffling any of them.

A SentencePiece BPE model whose pieces never hold a space mark after another character, nor a
line feed beside anything, can only merge inside the runs this module calls pre-tokens: spaces
with the word after them, or a line feed with the word after it.  The count of a text is then
the sum of the counts of its pre-tokens.

A chunk of texts is cut into pre-tokens and hashed (64 bits) as NumPy arrays over its bytes, and
each different one is looked up once: first in a compact hash table of frequent pre-tokens that
every executor gets, then in a bounded cache of the worker; what is in neither is encoded by the
library.  Both tiers only save time: the result is what the library gives for the whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tideline.llm.common import map_arrow, pieces, ship, utf8_column
from tideline.llm.text import word_hashes

PRETOKEN = re.compile(r" +[^ \n]*|\n[^ \n]*")

#: Bytes of text cut up and looked up at once.
CHUNK = 2 << 20
#: Most entries of one worker's cache; a full cache starts anew.
CACHE_ENTRIES = 250_000
#: Longer pre-tokens are encoded each time, so that a cache's bytes are bounded too.
CACHED_LENGTH = 64
#: Texts encoded whole for the table of frequent pre-tokens, and its most entries.
SAMPLE_ROWS = 4_000
TABLE_ENTRIES = 30_000

_MARK = "▁".encode()
_models: dict[str, object] = {}
_caches: dict[tuple[str, str], dict[int, object]] = {}


def model_path(name: str) -> str:
    """Where the public tokenizer file ``name`` lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def load_model(name: str):
    if name not in _models:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path(name))
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(re.search("[^▁]▁", p) or ("\n" in p and len(p) > 1) for p in pieces):
            raise ValueError(f"{name}: pieces cross the borders of pre-tokens")
        space = model.encode("a ")[len(model.encode("a")) :]
        _models[name] = (model, space)
    return _models[name]


def encode_pretokens(name: str, words: list[bytes]) -> list[list[int]]:
    """The ids of each pre-token (UTF-8), as they stand inside a text.

    The library puts a space before every text it is given, so the pre-token's own first space
    is left off, and after a line feed the ids of that added space are.
    """
    model, space = load_model(name)
    ids = model.encode([w if w[0] == 0x0A else w[1:] for w in words], num_threads=1)
    for k, w in enumerate(words):
        if w[0] == 0x0A:
            ids[k] = ids[k][len(space) :]
        elif len(w) == 1:
            ids[k] = list(space)
    return ids


def pretokens(text: str | None) -> list[str]:
    """A text as pre-tokens; the library's added space stands before the first."""
    return PRETOKEN.findall(" " + text.replace("▁", " ")) if text else []


def hash_words(words: list[str]) -> np.ndarray:
    """The hashes under which pre-tokens are looked up."""
    data, offsets = utf8_column(pa.array(words, pa.string()))
    return word_hashes(data, offsets[:-1], offsets[1:]) if words else np.zeros(0, np.uint64)


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, rows) of all pre-tokens; each ends where the next starts.

    The library's added space stands before every text that is not empty, and the space mark
    is written as the space it stands for.
    """
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    raw = data.tobytes()
    if _MARK in raw:
        texts = [raw[a:b].replace(_MARK, b" ") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        data, offsets = utf8_column(pa.array(texts, pa.binary()))
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    data = np.insert(data, offsets[:-1][filled], 0x20)
    heads = offsets[:-1][filled] + np.arange(len(filled))
    space = data == 0x20
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins |= data == 0x0A
    begins[heads] = True
    # A text's own first spaces go on from the added one.
    after = heads[heads + 1 < len(data)] + 1
    begins[after[space[after] & ~np.isin(after, heads)]] = False
    starts = np.flatnonzero(begins)
    return data, starts, filled[np.searchsorted(heads, starts, "right") - 1]


class Lookup:
    """What ``made`` makes of the ids of each pre-token: from the shared table, the cache, the library.

    ``table`` is (sorted hashes, values).  Workers keep one cache per model and ``kind``.
    """

    def __init__(self, name: str, kind: str, made, table: tuple[np.ndarray, list] | None = None):
        self.name, self.made = name, made
        self.hashes, self.known = table if table is not None else (np.zeros(0, np.uint64), [])
        self.cache = _caches.setdefault((name, kind), {})

    def _values(self, data: np.ndarray, starts: np.ndarray) -> tuple[list, np.ndarray]:
        """(values of the different pre-tokens, which of them each is)."""
        ends = np.append(starts[1:], len(data))
        hashes, first, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        cache = self.cache
        keys = hashes.tolist()
        values = list(map(cache.get, keys))
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            for k in np.flatnonzero(self.hashes[at] == hashes).tolist():
                values[k] = self.known[at[k]]
        missing = [k for k, v in enumerate(values) if v is None]
        raw, new = data.tobytes(), {}
        for start in range(0, len(missing), 4096):
            part = missing[start : start + 4096]
            own = first[part]
            words = [raw[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist())]
            for k, word, ids in zip(part, words, encode_pretokens(self.name, words)):
                values[k] = value = self.made(ids)
                if len(word) <= CACHED_LENGTH:
                    new[keys[k]] = value
        if len(cache) + len(new) > CACHE_ENTRIES:
            cache.clear()
        cache.update(new)
        return values, which

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of every text, for values that are numbers of ids."""
        out = [np.zeros(0, np.int64)]
        for a, b in pieces(offsets, CHUNK):
            part, starts, rows = cut(data, offsets[a : b + 1])
            if not len(starts):
                out.append(np.zeros(b - a, np.int64))
                continue
            values, which = self._values(part, starts)
            each = np.array(values, np.int64)[which]
            out.append(np.bincount(rows, weights=each, minlength=b - a).astype(np.int64))
        return np.concatenate(out)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of every text in order, for values that are the ids' bytes (2 each)."""
        for a, b in pieces(offsets, CHUNK):
            part, starts, rows = cut(data, offsets[a : b + 1])
            if not len(starts):
                yield from (np.zeros(0, "<u2") for _ in range(a, b))
                continue
            values, which = self._values(part, starts)
            flat = np.frombuffer(b"".join(values), "<u2")
            sizes = np.array([len(v) // 2 for v in values], np.int64)
            places = np.cumsum(sizes) - sizes
            each = sizes[which]
            before = np.cumsum(each) - each
            ids = flat[np.repeat(places[which] - before, each) + np.arange(int(each.sum()))]
            bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, weights=each, minlength=b - a).astype(np.int64))])
            for k in range(b - a):
                yield ids[bounds[k] : bounds[k + 1]]


def frequent_table(docs: DataFrame, text: str, name: str) -> tuple[np.ndarray, list[int]]:
    """Hashes and lengths of the most frequent pre-tokens of a random sample of the texts.

    The sample (about ``SAMPLE_ROWS`` texts, picked by a hash) and the table have fixed size
    bounds; what they hold changes the speed only.
    """
    rows = docs.count()
    if not rows:
        return np.zeros(0, np.uint64), []
    share = min(1.0, SAMPLE_ROWS / rows)
    picked = docs.select(F.col(text).alias("text")).where(
        F.pmod(F.xxhash64("text", F.lit(17)), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                seen.update(pretokens(value))
            if len(seen) > 10 * TABLE_ENTRIES:
                seen = Counter(dict(seen.most_common(2 * TABLE_ENTRIES)))
        best = [(w, n) for w, n in seen.most_common(TABLE_ENTRIES) if n > 1 and len(w) <= 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())],
            names=["word", "n"],
        )

    parts = map_arrow(picked, count, "word string, n long")
    top = parts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(TABLE_ENTRIES)
    words = [r["word"] for r in top.collect()]
    hashes = hash_words(words)
    order = np.argsort(hashes)
    lengths = list(map(len, encode_pretokens(name, [w.encode() for w in words]))) if words else []
    return hashes[order], [lengths[k] for k in order]


def with_token_counts(
    docs: DataFrame, name: str = "piece_bpe_32k.model", text: str = "text", count: str = "n_tokens"
) -> DataFrame:
    """``docs`` with the number of tokens of every whole text, as the library counts them.

    No begin, end or other special tokens; a null or empty text has none; a column already
    called ``count`` is replaced.  Texts never leave their partition.
    """
    spark = docs.sparkSession
    ship(spark)
    table = spark.sparkContext.broadcast(frequent_table(docs, text, name))

    @arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lookup = Lookup(name, "length", len, table.value)
        for batch in batches:
            yield pa.array(lookup.counts(*utf8_column(batch)), pa.int64())

    return docs.withColumn(count, counted(F.col(text)))
