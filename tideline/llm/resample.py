"""Importance resampling towards a target: array-scored weights, then a distributed quickselect.

A document's features are its runs of one and two consecutive words, each hashed to a bucket.
The share of a bucket in the target texts against its share in the documents, as the logarithm of
the smoothed ratio, is the bucket's gain: one array with an entry per bucket, which goes to every
task and turns the features of a batch into sums by array lookups.  The weight is the mean gain,
the score adds Gumbel noise fixed by the id, and the highest scores are drawn without
replacement.

The draw never sorts all rows.  The k-th of the composite keys (score downwards, id, row) is
found by rounds: a few random keys of the remaining range are pivots, one aggregation counts the
rows before, at and after each, and the range narrows to where the k-th key lies.  Only the
winners are then sorted, by ranges, and ranked by the sizes of the ranges before theirs.

Null and empty texts have no features and weight 0.  A null id draws as an empty id and comes
last among equal scores; rows with equal ids are drawn each, in the order they were scored in.
Empty tables give no rows; without target texts the target counts are all 0.  Other columns are
not looked at, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.llm.common import map_arrow, pieces, utf8_column, written
from tideline.llm.lexical import lower_words

BUCKETS = 10_000
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
SHARE = (25, 100)
SEED = 7
#: Pivots of a round of the quickselect.
PIVOTS = 31
#: Winners in one range of the final sort.
RANGE_ROWS = 1_000_000

#: Bytes of text hashed at once, and of a word hashed as part of an array.
_CHUNK = 2 << 20
_ARRAY_WORD = 48


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


def _step(state: np.ndarray, byte) -> np.ndarray:
    return _TABLE[(state ^ byte) & 0xFF] ^ (state >> 8)


def _crc_on(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The running (inverted) crc32 ``state`` of each row after its bytes ``data[start:end]``."""
    sizes = ends - starts
    order = np.argsort(-np.minimum(sizes, _ARRAY_WORD + 1), kind="stable")  # the long ones first
    long = int((sizes > _ARRAY_WORD).sum())
    out = np.empty_like(state)
    for row in np.flatnonzero(sizes > _ARRAY_WORD).tolist():
        before = int(state[row]) ^ 0xFFFFFFFF
        out[row] = zlib.crc32(data[starts[row] : ends[row]].tobytes(), before) ^ 0xFFFFFFFF
    order = order[long:]
    own, at, left = state[order], starts[order], sizes[order]
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k, "left"))  # rows of more than k bytes
        own[:n] = _step(own[:n], data[at[:n] + k])
    out[order] = own
    return out


def feature_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every feature of the texts, and the words of each text."""
    data, starts, ends, rows = lower_words(data, offsets)
    words = np.bincount(rows, minlength=len(offsets) - 1)
    state = _crc_on(np.full(len(starts), 0xFFFFFFFF, np.uint32), data, starts, ends)
    follows = rows[1:] == rows[:-1]
    pairs = _crc_on(_step(state[:-1][follows], 0x20), data, starts[1:][follows], ends[1:][follows])
    crc = np.concatenate([state, pairs]) ^ np.uint32(0xFFFFFFFF)
    return (crc % np.uint32(buckets)).astype(np.int64), np.concatenate([rows, rows[1:][follows]]), words


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows of the one text column; summed in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = utf8_column(batch.column(0))
            for a, b in pieces(offsets, _CHUNK):
                total += np.bincount(feature_buckets(data, offsets[a : b + 1], buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = map_arrow(texts, count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(buckets, np.int64)
    for r in rows:
        found[r["bucket"]] = r["n"]
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket in thousandths of a nat, rounded down."""
    size, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(((t + 1) * (all_source + size)) / ((s + 1) * (all_target + size))))
            for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())
        ],
        np.int64,
    )


def weighted(docs: DataFrame, gain: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every document."""
    kind = dict(docs.dtypes)[id]
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_column(batch.column(1))
            parts = []
            for a, b in pieces(offsets, _CHUNK):
                found, rows, words = feature_buckets(data, offsets[a : b + 1], buckets)
                features = np.bincount(rows, minlength=b - a)
                total = np.zeros(b - a, np.int64)
                np.add.at(total, rows, gain[found])
                parts.append((words, features, np.where(features > 0, total // np.maximum(features, 1), 0)))
            columns = [np.concatenate([np.zeros(0, np.int64), *c]).astype(np.int64) for c in zip(*parts)] if parts else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                names=["id", "n_words", "n_features", "weight"],
            )

    chosen = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return map_arrow(chosen, score, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(id: Column, seed: int = SEED) -> Column:
    """Noise in thousandths, fixed by the seed and the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def kth_key(keys: DataFrame, k: int, seed: int = SEED, pivots: int = PIVOTS):
    """The k-th smallest (from 1) of the different structs in column ``key``, without sorting them.

    Each round draws random pivots from the range that is left and counts the rows between and
    at them; the range shrinks to the part that holds the k-th.  None if there are fewer.
    """
    low = high = None
    kind = keys.schema["key"].dataType
    before, turn = 0, 0
    while True:
        left = keys
        left = left if low is None else left.where(F.expr(f"key > {_text(low, kind)}"))
        left = left if high is None else left.where(F.expr(f"key < {_text(high, kind)}"))
        drawn = left.orderBy(F.xxhash64("key", F.lit(seed + turn)), "key").limit(pivots)
        chosen = sorted((tuple(r["key"]) for r in drawn.collect()), key=_nulls_first)
        if not chosen:
            return None
        sides = f"array({', '.join(_text(p, kind) for p in chosen)})"
        # Twice the pivots before the key, and one more for a pivot that is the key.
        place = F.expr(f"size(filter({sides}, p -> p < key)) + size(filter({sides}, p -> p <= key))")
        counts = {r["place"]: r["count"] for r in left.groupBy(place.alias("place")).count().collect()}
        for at in range(2 * len(chosen) + 1):
            if before + counts.get(at, 0) >= k:
                break
            before += counts.get(at, 0)
        else:
            return None
        if at % 2:
            return chosen[at // 2]
        low = chosen[at // 2 - 1] if at else low
        high = chosen[at // 2] if at // 2 < len(chosen) else high
        turn += 1


def _text(key: tuple, kind: StructType) -> str:
    """A key as an SQL literal."""

    def value(v, type_name: str) -> str:
        if v is None:
            return f"CAST(NULL AS {type_name})"
        return f"CAST(decode(unhex('{str(v).encode().hex()}'), 'UTF-8') AS {type_name})"

    return f"named_struct({', '.join(f"'{f.name}', {value(v, f.dataType.simpleString())}" for v, f in zip(key, kind))})"


def _nulls_first(key: tuple) -> tuple:
    return tuple((v is not None, v) for v in key)


def ranked(rows: DataFrame, key: Column, range_rows: int = RANGE_ROWS, count: int | None = None) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... by ``key``: ranges sorted apart, and the sizes of those before."""
    count = rows.count() if count is None else count
    parts = max(1, -(-count // range_rows), min(32, count // 1000))
    ranged = rows.withColumn("key", key).repartitionByRange(parts, "key").sortWithinPartitions("key")
    # The number of a row is its range and its place inside it.
    numbered = written(ranged.withColumn("number", F.monotonically_increasing_id()), "resample-winners")
    part, place = F.shiftright("number", 33), F.col("number").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row for each range.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = numbered.withColumn("part", part).join(starts, "part")
    return placed.withColumn("rank", F.col("start") + place + 1).drop("part", "start", "number", "key")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = SHARE,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document; undrawn ones have no rank.

    ``share`` (a fraction) of the documents with ``least_words`` words and more are drawn.
    """
    source = bucket_counts(docs.select(F.col(f"`{text}`")), buckets)
    gain = gains(source, bucket_counts(target.select(F.col(f"`{target_text}`")), buckets))
    scored = weighted(docs, gain, id, text).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "resample-scores")
    fit = F.col("n_words") >= least_words
    key = F.struct((-F.col("score")).alias("s"), F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"))
    k = scored.where(fit).count() * share[0] // share[1]
    last = kth_key(scored.where(fit).select(key.alias("key")), k, seed) if k else None
    out = [F.col("id").alias(id), "n_words", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    kind = scored.select(key.alias("key")).schema["key"].dataType
    drawn = fit & (key <= F.expr(_text(last, kind)))
    winners = ranked(scored.where(drawn), key, count=k).select(*out, "rank")
    rest = scored.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return winners.unionByName(rest)
