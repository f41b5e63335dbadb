"""Training-order output: token ids in fixed-stride binary shards under a keyed permutation.

Texts become token ids, cut into sequences of ``length`` ids.  All sequences have dense numbers,
0 to N - 1, in the order of the files' paths, the rows in a file and the places in a text.  A keyed
Feistel network over the next even power of two, applied again while its result is not below N
(cycle walking), permutes the numbers: the result is the sequence's global slot.  Slot s is record
s mod ``per_shard`` of shard s div ``per_shard``.  Shards are dealt to tasks by ranges of slots;
every record has the same size, so a reader finds any slot by one division and one seek.

A first pass counts the sequences of each piece of the scan, a run of neighbouring rows of one file
read by one task; a prefix sum over files and pieces gives each piece its first number, whatever the
pieces are, so the order is the same for any split of the files and any number of cores.  The second
pass finds the first number of each piece in a broadcast table, of one small row per piece up to
``PIECES`` of them (256 TB at 128 MB a piece); beyond that each row is a piece and Spark joins the two
tables.  Texts are read twice, records shuffled once; one task writes a whole shard through Spark's
file writer, so a lost or repeated task leaves no half shard.  Both passes give texts to the workers
in batches of about ``BATCH`` bytes and look pre-tokens up ``CHUNK`` bytes at a time: what a batch
and its arrays take, in Spark's buffers and in the worker, follows from these and the longest text.

Record: doc_id (8 bytes), number of the sequence in its text (4), ids in use (4; the highest bit
set if the row has no doc_id), ``length`` ids of 2 bytes, all little-endian, and a line feed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.common import map_arrow, pieces, utf8_column, written
from tideline.llm.text import word_hashes
from tideline.llm.tokens import cut, encode_pretokens
from tideline.session import scratch_path

MODEL = "piece_bpe_32k.model"
LENGTH = 1024
PER_SHARD = 2048
KEY = "epoch-0"
HEADER = 16
NO_ID = 1 << 31
#: Bytes of rows given to a worker at once, and of text cut up and looked up at once.
BATCH = 2 << 20
CHUNK = 1 << 19
#: Most pieces whose first numbers are broadcast, some 60 bytes each.
PIECES = 2_000_000
#: Most pre-tokens that a worker keeps, about 25 bytes each.
ENTRIES = 1_000_000
#: Shards that a task writes, if there are more than the session's shuffle partitions.
SHARDS_PER_TASK = 32


def stride(length: int = LENGTH) -> int:
    """Bytes of a record."""
    return HEADER + 2 * length + 1


def permuted(numbers: np.ndarray, total: int, key: str, rounds: int = 6) -> np.ndarray:
    """The slots of ``numbers``, a permutation of range(total) that ``key`` chooses."""
    half = max(1, ((max(total, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [
        np.uint64(int.from_bytes(hashlib.blake2b(f"{key}/{r}".encode(), digest_size=8).digest(), "little"))
        for r in range(rounds)
    ]

    def step(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            f = (right + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + k
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(32)
            left, right = right, left ^ (f & mask)
        return (left << np.uint64(half)) | right

    x = step(np.asarray(numbers).astype(np.uint64))
    outside = np.flatnonzero(x >= total)
    while len(outside):
        x[outside] = step(x[outside])
        outside = outside[x[outside] >= total]
    return x.astype(np.int64)


class Words:
    """The ids of pre-tokens that this worker has met, as arrays; both passes use them.

    Entries are two sorted runs of hashes, old and new, with places in one array of ids; the new
    run joins the old one when it has an eighth of its size.  Beyond ``ENTRIES`` entries, or eight
    times as many ids, the worker starts anew.
    """

    def __init__(self, model: str):
        self.model = model
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.runs, self.ids, self.used = [none, none], np.zeros(1 << 16, "<u2"), 0

    def _add(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Places and sizes of more lists of ids."""
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        total = int(sizes.sum())
        if self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.empty(total + self.used // 2, "<u2")])
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(lists), "<u2", total)
        places = self.used + np.cumsum(sizes) - sizes
        self.used += total
        return places, sizes

    def found(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``ids``, number of ids) of every pre-token that begins at one of ``starts``."""
        if sum(len(run[0]) for run in self.runs) > ENTRIES or self.used > 8 * ENTRIES:
            self.clear()
        ends = np.append(starts[1:], len(data))
        hashes, first, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        places, sizes = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        known = np.zeros(len(hashes), bool)
        for own, at, size in self.runs:
            if len(own):
                near = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
                hit = own[near] == hashes
                places[hit], sizes[hit] = at[near[hit]], size[near[hit]]
                known |= hit
        missing = np.flatnonzero(~known)
        raw = data.tobytes() if len(missing) else b""
        for begin in range(0, len(missing), 4096):
            part = missing[begin : begin + 4096]
            words = [raw[a:b] for a, b in zip(starts[first[part]].tolist(), ends[first[part]].tolist())]
            places[part], sizes[part] = self._add(encode_pretokens(self.model, words))
        self._keep(hashes[missing], places[missing].astype(np.uint32), sizes[missing].astype(np.uint32))
        return places[which], sizes[which]

    def _keep(self, *new: np.ndarray) -> None:
        old, recent = self.runs
        recent = _merged(recent, new)
        if 8 * len(recent[0]) > len(old[0]):
            old, recent = _merged(old, recent), tuple(c[:0] for c in recent)
        self.runs = [old, recent]

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Numbers of ids of every text."""
        out = [np.zeros(0, np.int64)]
        for a, b in pieces(offsets, CHUNK):
            part, starts, rows = cut(data, offsets[a : b + 1])
            sizes = self.found(part, starts)[1] if len(starts) else np.zeros(0, np.int64)
            out.append(np.bincount(rows, weights=sizes, minlength=b - a).astype(np.int64))
        return np.concatenate(out)

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of every text in order."""
        for a, b in pieces(offsets, CHUNK):
            part, starts, rows = cut(data, offsets[a : b + 1])
            if not len(starts):
                yield from (np.zeros(0, "<u2") for _ in range(a, b))
                continue
            places, sizes = self.found(part, starts)
            before = np.cumsum(sizes) - sizes
            ids = self.ids[np.repeat(places - before, sizes) + np.arange(int(sizes.sum()))]
            bounds = np.cumsum(np.bincount(rows, weights=sizes, minlength=b - a).astype(np.int64))
            yield from np.split(ids, bounds[:-1])


def _merged(one: tuple, two: tuple) -> tuple:
    """Two runs of entries, sorted by hash, as one."""
    at = np.searchsorted(one[0], two[0])
    return tuple(np.insert(a, at, b) for a, b in zip(one, two))


_words: dict[str, Words] = {}


def words_of(model: str) -> Words:
    """This worker's pre-tokens under ``model``."""
    return _words.setdefault(model, Words(model))


@contextmanager
def _passes(spark: SparkSession):
    """Settings of the two passes, where the session has none of its own.

    Files are split alike, whatever executors come and go, and batches of rows are small.
    """
    wanted = {
        "spark.sql.files.minPartitionNum": str(spark.sparkContext.defaultParallelism),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH),
    }
    own = {name: value for name, value in wanted.items() if spark.conf.get(name, None) is None}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in own:
            spark.conf.unset(name)


def _rows(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``file, path, row, doc_id, text``: every row with its place in the stored table.

    Rows of a Parquet scan with chosen or computed columns have places; all others are stored first.
    """
    plan = docs._jdf.queryExecution().analyzed()
    deterministic = plan.deterministic()
    while plan.nodeName() in ("Project", "SubqueryAlias"):
        plan = plan.child()
    docs = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        *([docs.metadataColumn("_metadata")] if plan.nodeName() == "LogicalRelation" else []),
    )
    if not (deterministic and len(docs.columns) == 3 and "row_index" in docs.schema[2].dataType.names):
        docs = written(docs.select("doc_id", "text"), "sequences")
        docs = docs.select("doc_id", "text", docs.metadataColumn("_metadata"))
    place = F.col(docs.columns[2])
    path = place.getField("file_path")
    return docs.select(
        F.xxhash64(path).alias("file"), path.alias("path"), place.getField("row_index").alias("row"), "doc_id", "text"
    )


def _breaks(files: np.ndarray, rows: np.ndarray, last: tuple[int, int] | None) -> np.ndarray:
    """Which rows do not follow the one before them in the same file; ``last`` stands before all."""
    file, row = last or (0, -2)
    return (files != np.append(file, files[:-1])) | (rows != np.append(row, rows[:-1]) + 1)


def _pieces(rows: DataFrame, model: str, length: int, single: bool) -> DataFrame:
    """``file, row, n``: first row and sequences of each piece of the scan, or of each row (``single``)."""
    names = ["file", "row", "n"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last, piece = words_of(model), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            files, places = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            n = -(-words.lengths(*utf8_column(batch.column(2))) // length)
            if single:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (files, places, n)], names=names)
                continue
            breaks, done = _breaks(files, places, last), []
            heads = np.union1d(np.flatnonzero(breaks), [0])
            for at, total in zip(heads.tolist(), np.add.reduceat(n, heads).tolist()):
                if breaks[at]:
                    if piece:
                        done.append(piece)
                    piece = (int(files[at]), int(places[at]), total)
                else:
                    piece = (*piece[:2], piece[2] + total)
            last = (int(files[-1]), int(places[-1]))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done)], names=names)
        if piece:
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()) for c in piece], names=names)

    return map_arrow(rows.select("file", "row", "text"), count, "file long, row long, n long")


def _numbered(rows: DataFrame, model: str, length: int, most: int) -> tuple[DataFrame, int]:
    """(``rows`` with the number of a piece's first sequence, ``start``, in its first row; all sequences)."""
    parts = written(_pieces(rows, model, length, False), "pieces")
    few = parts.count() <= most
    if not few:
        parts = written(_pieces(rows, model, length, True), "pieces")
    paths = rows.groupBy("file").agg(F.min("path").alias("path"), F.max("path").alias("other"))
    files = written(paths.join(parts.groupBy("file").agg(F.sum("n").alias("n")), "file"), "files")
    total = files.agg(F.sum("n").alias("n"), F.count_if(F.col("path") != F.col("other")).alias("clashes")).first()
    if total["clashes"]:
        raise RuntimeError("two files have equal hashes of their paths")

    def before(window) -> Column:
        return F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # One row per file; these alone are ordered in one task.
    firsts = files.select("file", before(Window.orderBy("path")).alias("first"))
    inside = parts.withColumn("inside", before(Window.partitionBy("file").orderBy("row")))
    starts = inside.join(firsts, "file").select("file", "row", (F.col("first") + F.col("inside")).alias("start"))
    starts = written(starts, "starts")
    # Few pieces are sent to the rows, which so stay in the order of the scan.
    return rows.join(F.broadcast(starts) if few else starts, ["file", "row"], "left"), total["n"] or 0


def write_shards(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text: str = "text",
    model: str = MODEL,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    key: str = KEY,
    most_pieces: int = PIECES,
) -> None:
    """Write all texts to shards under ``path``, ``shard=<number>/part-*``.

    The order follows from the key and from the rows' places in the stored files, so it is the same
    every time and on any cluster; a table that is no plain Parquet scan is stored first, and its
    order is that of the stored rows.  An id that is no number counts as null in a session without
    ANSI mode and fails in one with it.  A null or empty text has no sequences.  Repeated rows are
    written as often as they come.  An empty table gives no shard.
    """
    spark = docs.sparkSession
    with _passes(spark):
        rows, total = _numbered(_rows(docs, id_column, text), model, length, most_pieces)
        shards = max(1, -(-total // per_shard))
        tasks = max(min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-shards // SHARDS_PER_TASK))

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, number, last = words_of(model), 0, None

            def packed(numbers: list[int], records: list[bytes]) -> pa.RecordBatch:
                slots = permuted(np.array(numbers, np.int64), total, key)
                task = (slots // per_shard * tasks // shards).astype(np.int32)
                return pa.RecordBatch.from_arrays(
                    [pa.array(task), pa.array(slots), pa.array(records, pa.binary())], names=["task", "slot", "record"]
                )

            for batch in batches:
                if not batch.num_rows:
                    continue
                files, places = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                if np.any(_breaks(files, places, last) & batch.column(2).is_null().to_numpy(zero_copy_only=False)):
                    raise RuntimeError("the files were split in another way when their sequences were counted")
                last = (int(files[-1]), int(places[-1]))
                numbers: list[int] = []
                records: list[bytes] = []
                for start, doc_id, found in zip(
                    batch.column(2).to_pylist(), batch.column(3).to_pylist(), words.texts(*utf8_column(batch.column(4)))
                ):
                    number = number if start is None else start
                    ids = found.tobytes()
                    head = (doc_id or 0).to_bytes(8, "little", signed=True)
                    for at in range(0, len(ids), 2 * length):
                        own = ids[at : at + 2 * length]
                        used = len(own) // 2 | (NO_ID if doc_id is None else 0)
                        records.append(
                            head + (at // (2 * length)).to_bytes(4, "little") + used.to_bytes(4, "little") + own
                        )
                        numbers.append(number)
                        number += 1
                    if len(records) >= 2048:
                        yield packed(numbers, records)
                        numbers, records = [], []
                if records:
                    yield packed(numbers, records)

        # Records travel without their padding; it is put on as the shard is written.
        encoded = map_arrow(
            rows.select("file", "row", "start", "doc_id", "text"), encode, "task int, slot long, record binary"
        )
        size = stride(length) - 1
        full = F.rpad("record", F.lit(size), F.lit(b"\x00"))
        shard = F.expr(f"slot div {per_shard}")
        dealt = encoded.withColumn("shard", shard).repartitionById(tasks, "task").sortWithinPartitions("shard", "slot")
        out = dealt.select("shard", full.cast("string").alias("record"))
        out.write.partitionBy("shard").option("lineSep", "\n").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.withColumn("shard", F.regexp_extract("path", r"shard=(\d+)", 1).cast("long"))


def manifest(spark: SparkSession, path: str, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """``shard, first_slot, records`` of every shard, from the files' names and sizes."""
    records = F.expr(f"length div {stride(length)}").alias("records")
    return _files(spark, path).select("shard", (F.col("shard") * per_shard).alias("first_slot"), records)


def read_shards(spark: SparkSession, path: str, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """Every record of the shards under ``path``: one row per slot, read back from the files.

    ``slot, shard, byte_offset, doc_id, sequence, n_ids, ids`` (binary, the ids in use).
    """
    schema = "slot long, shard long, byte_offset long, doc_id long, sequence long, n_ids long, ids binary"
    wide = stride(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(content.as_buffer(), np.uint8)
                if len(data) % wide:
                    raise RuntimeError(f"shard {number} is not a whole number of records")
                data = data.reshape(-1, wide)
                for at in range(0, len(data), 512):
                    part = data[at : at + 512]
                    head = np.ascontiguousarray(part[:, :HEADER])
                    used = head[:, 12:16].copy().view("<u4")[:, 0]
                    n = (used & np.uint32(NO_ID - 1)).astype(np.int64)
                    place = np.arange(at, at + len(part), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(number * per_shard + place),
                            pa.array(np.full(len(part), number, np.int64)),
                            pa.array(place * wide),
                            pa.array(head[:, :8].copy().view("<i8")[:, 0], mask=used >= NO_ID),
                            pa.array(head[:, 8:12].copy().view("<u4")[:, 0].astype(np.int64)),
                            pa.array(n),
                            pa.array([r[HEADER : HEADER + 2 * k].tobytes() for r, k in zip(part, n)], pa.binary()),
                        ],
                        names=["slot", "shard", "byte_offset", "doc_id", "sequence", "n_ids", "ids"],
                    )

    return map_arrow(_files(spark, path).select("shard", "content"), run, schema)


def training_order(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` to shards in the shared folder; one row per sequence, as read back from them.

    ``slot, shard, byte_offset, doc_id, sequence, n_ids, sha256`` (of the little-endian ids).
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    write_shards(docs, path, **options)
    records = read_shards(spark, path, options.get("length", LENGTH), options.get("per_shard", PER_SHARD))
    return records.select(
        "slot", "shard", "byte_offset", "doc_id", "sequence", "n_ids", F.sha2("ids", 256).alias("sha256")
    )
