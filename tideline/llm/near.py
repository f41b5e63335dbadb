"""N-gram Jaccard self-join of texts by the chosen-path method.

Texts with the same set of word 5-grams form a class; all else happens between classes.

1. Every text gets a class id (a hash of its set of shingles) and ``TOKENS`` min-hash tokens,
   its set in the fixed-length form in which the share of equal tokens estimates Jaccard.
2. A run of the join starts from ``FIRST`` sampled token positions: classes that share all those
   tokens stay together.  A bucket of up to ``bucket`` classes is compared by brute force on the tokens;
   a larger one is split again on ``BRANCH`` more positions chosen by the hash of its path, and
   so on; what is still large after ``DEPTH`` splits is compared block by block.  The number of
   runs follows from the recall asked for (``runs_for``).
3. Brute force leaves a spanning forest of the pairs that look similar, not the pairs.  Its
   components are small groups in which every true link lies; inside each, all pairs are counted
   exactly on the full shingle sets (blocks of a group against blocks, each pair once).
4. Components of the exact links are the groups of near copies.

No step emits the pairs of a group, so a group of near copies costs rows in proportion to its
members (times members per block).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import map_arrow, pieces, utf8_column, written
from tideline.llm.components import components
from tideline.llm.text import mix, shingle_sets

TOKENS = 128
#: Tokens that the first buckets share; with fewer, a passage common to many texts fills buckets.
FIRST = 3
#: Children of a bucket that is split; with similarity 0.8 the expected shared children exceed 1.
BRANCH = 2
DEPTH = 4
#: Classes compared with each other in one piece, at most.
BUCKET = 1024
#: Members of one block of a group in the exact count.
BLOCK = 256
#: Standard deviations of the token estimate that a candidate may lie under the threshold.
MARGIN = 4.0

_rng = np.random.default_rng(20)
_SEEDS = _rng.integers(0, 2**32, TOKENS, dtype=np.uint32)
_ODDS = _rng.integers(0, 2**31, TOKENS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def runs_for(similarity: float, recall: float) -> int:
    """Runs after which a pair at ``similarity`` is found with probability ``recall``.

    A run finds it if the first tokens agree and the line of shared buckets does not die out;
    the chance that it dies is the least root of q = (1 - s + s q) ** BRANCH.
    """
    q = 0.0
    for _ in range(200):
        q = (1 - similarity + similarity * q) ** BRANCH
    found = similarity**FIRST * (1 - q)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))


def first_positions(runs: int) -> np.ndarray:
    """The token positions each run starts from: all different as long as there are enough."""
    rng = np.random.default_rng(3)
    order = np.concatenate([rng.permutation(TOKENS) for _ in range(-(-runs * FIRST // TOKENS))])
    return order[: runs * FIRST].reshape(runs, FIRST)


def tokens_of(shingles: np.ndarray) -> np.ndarray:
    """The min-hash token of every position, for one non-empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(x), 2048):
        part = (x[None, start : start + 2048] ^ _SEEDS[:, None]) * _ODDS[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def class_of(shingles: np.ndarray) -> int:
    """The class id of a set: equal sets only (up to 64-bit digests) have equal ids."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, runs: int, n: int = 5) -> DataFrame:
    """``doc_id, key, class, roots, tokens`` of every text; class is null for a text without words.

    ``docs`` has ``doc_id, key, text``.  ``roots`` are the first buckets of every run, ``tokens``
    the low byte of all tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts, starts = mix(np.arange(runs, dtype=np.uint64) + np.uint64(977)), first_positions(runs)
        for batch in batches:
            data, offsets = utf8_column(batch.column(2))
            for first, end in pieces(offsets, 1 << 20):
                classes, roots, tokens = [], [], []
                for s in shingle_sets(data, offsets[first : end + 1], n):
                    if not len(s):
                        classes.append(None), roots.append(None), tokens.append(None)
                        continue
                    t = tokens_of(s)
                    classes.append(class_of(s))
                    root = salts
                    for k in range(FIRST):
                        root = mix(root ^ t[starts[:, k]].astype(np.uint64))
                    roots.append(root.view(np.int64))
                    tokens.append((t & np.uint32(255)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first),
                     pa.array(classes, pa.int64()), pa.array(roots, pa.list_(pa.int64())), pa.array(tokens, pa.binary())],
                    names=["doc_id", "key", "class", "roots", "tokens"],
                )

    schema = "doc_id long, key long, class long, roots array<long>, tokens binary"
    return map_arrow(docs.select("doc_id", "key", "text"), run, schema)


class Forest:
    """Union-find over a few members."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, xs: list[int], ys: list[int]) -> None:
        find, parent = self.find, self.parent
        for x, y in zip(xs, ys):
            a, b = find(x), find(y)
            if a < b:
                parent[b] = a
            elif b < a:
                parent[a] = b

    def edges(self, ids: np.ndarray) -> list[tuple[int, int]]:
        return [(int(ids[r]), int(ids[x])) for x in range(len(self.parent)) if (r := self.find(x)) != x]


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by their first ``keys`` columns.

    Rows of small groups come together, about a batch at a time; a group is never cut.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1].as_py() for k in range(keys)]
        same = np.ones(batch.num_rows, bool)
        for k in range(keys):
            same &= np.asarray(batch.column(k).to_numpy(zero_copy_only=False) == last[k])
        cut = int(np.argmax(same))  # the rows from here on may go on in the next batch
        if cut or not held:
            if cut:
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        else:
            before = [held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in range(keys)]
            if before != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _bytes_matrix(column, width: int) -> np.ndarray:
    """A column of byte strings of one width as rows of a matrix."""
    data, offsets = utf8_column(column)
    return data[offsets[0] : offsets[-1]].reshape(-1, width)


def compare_buckets(rows: DataFrame, least_equal: int) -> DataFrame:
    """Candidate links inside buckets as a spanning forest: ``a, b``.

    ``rows`` has ``bucket, side, class, tokens``.  Two classes of one bucket are a candidate when
    ``least_equal`` tokens agree.  Where a bucket has rows of side 0 and of side 1 only pairs
    across are compared (blocks of a large bucket), else all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, 1):
            bucket = table.column(0).to_numpy()
            side = table.column(1).to_numpy()
            ids = table.column(2).to_numpy()
            tokens = _bytes_matrix(table.column(3), TOKENS)
            forest = Forest(len(ids))
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(ids)]]))
            # One step compares each row with the row ``step`` further on in its bucket.
            position = np.arange(len(ids)) - np.repeat(starts, sizes)
            left = np.repeat(sizes, sizes) - position
            across = np.repeat(np.add.reduceat(side, starts) > 0, sizes) if len(starts) else side > 0
            for step in range(1, int(sizes.max(initial=1))):
                here = np.flatnonzero(left > step)
                here = here[~across[here] | (side[here] != side[here + step])]
                for at in range(0, len(here), 65536):
                    x = here[at : at + 65536]
                    alike = np.count_nonzero(tokens[x] == tokens[x + step], axis=1) >= least_equal
                    if alike.any():
                        forest.join(x[alike].tolist(), (x[alike] + step).tolist())
            edges = forest.edges(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())],
                names=["a", "b"],
            )

    ready = rows.select("bucket", "side", "class", "tokens").repartition("bucket").sortWithinPartitions("bucket")
    return map_arrow(ready, run, "a long, b long")


def split_buckets(rows: DataFrame, level: int) -> DataFrame:
    """``bucket, class, tokens`` one level down: a row for each chosen position's token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = batch.column(0).to_numpy().view(np.uint64)
            tokens = _bytes_matrix(batch.column(2), TOKENS)
            for branch in range(BRANCH):
                path = mix(bucket + np.uint64(1 + branch + BRANCH * level))
                position = (path % np.uint64(TOKENS)).astype(np.int64)
                token = tokens[np.arange(len(position)), position].astype(np.uint64)
                child = mix(path ^ (token + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(child.view(np.int64)), batch.column(1), batch.column(2)], names=["bucket", "class", "tokens"]
                )

    return map_arrow(rows, run, "bucket long, class long, tokens binary")


def candidate_links(classes: DataFrame, similarity: float, bucket: int = BUCKET) -> DataFrame:
    """A spanning forest ``a, b`` of the pairs of classes that look similar.

    ``classes`` has one row per class: ``class, roots, tokens``.
    """
    least_equal = math.ceil(
        TOKENS * similarity - MARGIN * math.sqrt(TOKENS * similarity * (1 - similarity))
    )
    members = classes.select("class", F.explode("roots").alias("bucket"))
    sizes = written(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-sizes")
    payload = classes.select("class", "tokens")
    rows = members.join(sizes, "bucket").join(payload, "class").select("bucket", "class", "tokens", "size")
    small = rows.where(F.col("size") <= bucket)
    found = compare_buckets(small.withColumn("side", F.lit(0)), least_equal)
    large = written(rows.where(F.col("size") > bucket).drop("size"), "near-large")
    for level in range(DEPTH):
        if large.isEmpty():
            return found
        large = written(split_buckets(large.select("bucket", "class", "tokens"), level), "near-split")
        sizes = written(large.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-sizes")
        rows = large.join(sizes, "bucket")
        small = rows.where(F.col("size") <= bucket)
        found = found.unionByName(compare_buckets(small.withColumn("side", F.lit(0)), least_equal))
        large = rows.where(F.col("size") > bucket)
    # What remains is cut into blocks; every pair of blocks is a bucket of its own.
    half = bucket // 2
    blocks = (
        large.withColumn("blocks", F.ceil(F.col("size") / F.lit(half)).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("class", F.lit(3)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("bucket"),
            (F.col("block") > F.col("other")).cast("int").alias("side"),
            "class",
            "tokens",
        )
    )
    return found.unionByName(compare_buckets(blocks, least_equal))


def exact_links(rows: DataFrame, similarity: float, n: int = 5) -> DataFrame:
    """Exact links inside groups: ``a, b, n``.

    ``rows`` has ``group, low, high, block, class, copies, text`` sorted into one task per
    (group, low, high).  A row with ``b`` null says that class ``a`` has links to ``n`` documents
    in the other block (or the same, where low = high); the other rows are a spanning forest.
    """
    keys = ["group", "low", "high"]

    def overlaps(sets: list[np.ndarray], rows_x: np.ndarray, rows_y: np.ndarray, same: bool):
        """(x, y) pairs above the threshold, each pair once."""
        values = np.concatenate([sets[y] for y in rows_y])
        owner = np.repeat(np.arange(len(rows_y)), [len(sets[y]) for y in rows_y])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        lengths = np.array([len(sets[y]) for y in rows_y])
        for i, x in enumerate(rows_x.tolist()):
            s = sets[x]
            a, b = np.searchsorted(values, s, "left"), np.searchsorted(values, s, "right")
            count = b - a
            if not count.sum():
                continue
            # All postings of x's shingles, as one index array.
            at = np.repeat(a - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            shared = np.bincount(owner[at], minlength=len(rows_y))
            hit = shared >= similarity * (len(s) + lengths - shared) - 1e-9
            if same:
                hit[: i + 1] = False
            if hit.any():
                yield x, rows_y[hit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A group's texts become shingle sets as they arrive, so only sets are held.
        key, held = None, []

        def counted():
            out: list[tuple] = []
            if len(held) > 1:
                sets = [h[3] for h in held]
                ids = np.array([h[0] for h in held])
                copies = np.array([h[1] for h in held])
                block = np.array([h[2] for h in held])
                links = np.zeros(len(held), np.int64)
                forest = Forest(len(held))
                rows_x, rows_y = np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])
                if len(rows_x) and len(rows_y):
                    for x, ys in overlaps(sets, rows_x, rows_y, key[1] == key[2]):
                        links[x] += int(copies[ys].sum())
                        links[ys] += copies[x]
                        forest.join([x] * len(ys), ys.tolist())
                out += [(int(ids[i]), None, int(links[i])) for i in np.flatnonzero(links)]
                out += [(a, b, 0) for a, b in forest.edges(ids)]
            return pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], pa.int64()) for i in range(3)], names=["a", "b", "n"]
            )

        for batch in batches:
            data, offsets = utf8_column(batch.column(6))
            for first, end in pieces(offsets, 1 << 20):
                columns = [batch.column(c).slice(first, end - first).to_pylist() for c in range(6)]
                for group, low, high, block, cls, copies, s in zip(*columns, shingle_sets(data, offsets[first : end + 1], n)):
                    if (group, low, high) != key:
                        if held:
                            yield counted()
                        key, held = (group, low, high), []
                    # A text of another class under the same id, or a second copy, is not counted.
                    if len(s) and class_of(s) == cls and not (held and held[-1][0] == cls):
                        held.append((cls, copies, block, s))
        if held:
            yield counted()

    ready = (
        rows.select(*keys, "block", "class", "copies", "text")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "block", "class")
    )
    return map_arrow(ready, run, "a long, b long, n long")


def row_key(id_column: str = "doc_id", text: str = "text") -> Column:
    """A hash of a row's id and text; equal for rows repeated whole, null id or not."""
    given, body = F.col(f"`{id_column}`").cast("long"), F.col(f"`{text}`")
    return F.xxhash64(given.isNull(), given, body.isNull(), body)


def near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    similarity: float = 0.8,
    n: int = 5,
    recall: float = 0.9999,
) -> DataFrame:
    """Every row of ``docs`` as ``doc_id, key, class_id, kept, links``: one row in, one row out.

    ``links`` is the number of other rows whose set of word ``n``-grams has a Jaccard similarity
    of ``similarity`` or more, exact copies included.  ``class_id`` names the group that links
    connect (through other members too) by its least doc_id, and ``kept`` is the ``key`` of the
    row that stands for it; ``key`` is ``row_key`` of a row.  Words are runs of anything but
    space and control characters 9 to 13, compared as they are; a text of fewer than ``n`` words
    has one shingle, all its words.  A text without words (null, empty, blank) has no links and
    is its own group.  Rows repeated whole count as copies of each other.  A null doc_id stays
    null and names a group only if all its members have none.  Extra columns are ignored.
    """
    source = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        row_key(id_column, text).alias("key"),
        F.col(f"`{text}`").alias("text"),
    )
    runs = runs_for(similarity, recall)
    signed = written(signatures(source, runs, n), "near-signatures")
    member = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    classes = written(
        signed.where("class IS NOT NULL").groupBy("class").agg(F.min(member).alias("first"), F.count(F.lit(1)).alias("copies")),
        "near-classes",
    )
    # One row per class carries the tokens; rows repeated whole have equal ones.
    firsts = signed.join(classes.select("class", F.col("first.key").alias("key")), ["class", "key"])
    firsts = written(
        firsts.groupBy("class").agg(F.first("roots").alias("roots"), F.first("tokens").alias("tokens")), "near-tokens"
    )
    groups = components(candidate_links(firsts, similarity), "near-groups")
    groups = groups.withColumnsRenamed({"node": "class", "root": "group"})
    # A group of many classes is cut into blocks; each pair of blocks is one task's work.
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    members = (
        groups.join(sizes, "group")
        .join(classes.select("class", "copies", F.col("first.key").alias("key")), "class")
        .withColumn("blocks", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("class", F.lit(5)), F.col("blocks")).cast("int"))
    )
    texts = members.join(source.select("key", "text"), "key")
    pairs = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "group",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "class",
        "copies",
        "text",
    )
    links = written(exact_links(pairs, similarity, n), "near-links")
    linked = links.where("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    joined = components(links.where("b IS NOT NULL").select("a", "b"), "near-components")
    per_class = (
        classes.join(linked, "class", "left")
        .join(joined.withColumnsRenamed({"node": "class", "root": "rep"}), "class", "left")
        .select(
            "class",
            "first",
            F.coalesce("rep", "class").alias("rep"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"),
        )
    )
    per_class = written(per_class, "near-per-class")
    names = per_class.groupBy("rep").agg(F.min("first").alias("name"))
    named = per_class.join(names, "rep").select(
        "class", F.col("name.doc_id").alias("class_id"), F.col("name.key").alias("kept"), "links"
    )
    return signed.select("doc_id", "key", "class").join(named, "class", "left").select(
        "doc_id",
        "key",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("kept")).alias("kept"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near copies, that of the least doc_id.

    Texts without words all stay, but for rows repeated whole, of which one stays.
    """
    found = near_copies(docs, id_column, text, **options)
    kept = found.select(F.col("kept").alias("_row_key")).distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_key(id_column, text).alias("_row_key")
    ).withColumn("_copy", F.row_number().over(Window.partitionBy("_row_key").orderBy("_row_key")))
    return rows.where("_copy = 1").join(kept, "_row_key", "left_semi").select("_row.*")
