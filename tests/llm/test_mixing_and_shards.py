import glob
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm import mixing, shards, text, tokens
from tideline.llm.common import utf8_column

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def fair_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Reshare again and again, as the words say."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        rest, by = total - sum(target.values()), sum(weight[s] for s in free)
        over = {s for s in free if rest * weight[s] / by > most * sizes[s] + 1e-9}
        if not over:
            return target | {s: rest * weight[s] / by for s in free}
        target |= {s: most * sizes[s] for s in over}
        free -= over
    return target


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for k in range(900):
        source = rng.choice(["b", "b", "b", "a", "Z", "é", "ü", "", None])
        out.append((k, " ".join("w" for _ in range(rng.choice([0, 1, 3, 3, 3, 20, 80]))), source))
    return out + [out[5]] * 3 + [(None, "w w w", "a"), (None, "w w w", "a"), (2000, None, "only empty")]


def test_targets_match_repeated_sharing(spark):
    rng = random.Random(1)
    for _ in range(6):
        sizes = {s: rng.choice([0, 1, 10, 1000, 10**6]) for s in ["a", "B", "é", "zz", "", None][: rng.randint(1, 6)]}
        table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(table, (5, 2, 1), 1.5, 2.0).collect()}
        assert got == pytest.approx(fair_targets(sizes))


def test_mix_takes_its_targets(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("_size", mixing.word_count(F.col("text")))
    taken = mixing.copies(docs).collect()
    assert len(taken) == len(rows)
    size = lambda r: len(WORD.findall(r["text"] or ""))
    sizes = {}
    for r in taken:
        assert r["_size"] == size(r)
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r)
    goals = fair_targets(sizes)
    for source in sizes:
        own = [r for r in taken if r["source"] == source]
        assert all(r["_target"] == pytest.approx(goals[source]) and r["_source_size"] == sizes[source] for r in own)
        assert abs(sum(size(r) * r["_copies"] for r in own) - goals[source]) <= 2 * 80
    assert all(0 <= r["_copies"] <= 2 for r in taken)
    again = mixing.copies(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, taken))


def test_mixed_rows_keep_their_columns(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("_size", "_copies", "_rank", "_key", "_row"):
        docs = docs.withColumn(name, F.lit("x"))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    plain = mixing.copies(spark.createDataFrame(rows, SCHEMA).withColumn("_size", mixing.word_count(F.col("text"))))
    assert out.count() == plain.agg(F.sum("_copies")).first()[0]
    assert mixing.mixed(docs.where("doc_id < 0")).count() == 0
    assert mixing.mixed(docs.where("doc_id = 2000")).count() == 0


@pytest.mark.parametrize("total", [1, 2, 3, 17, 1000, 4097])
def test_slots_are_a_permutation(total):
    slots = shards.permuted(np.arange(total), total, "k")
    assert sorted(slots.tolist()) == list(range(total))
    if total > 100:
        assert slots.tolist() != list(range(total))
        assert slots.tolist() != shards.permuted(np.arange(total), total, "other").tolist()
        # Numbers may come in any grouping.
        assert shards.permuted(np.array([7, 3]), total, "k").tolist() == [slots[7], slots[3]]


def texts():
    rng = random.Random(4)
    out = [(k, " ".join(rng.choice(["the", "cat\n", "é漢", "x" * 30]) for _ in range(rng.choice([0, 1, 5, 60, 400])))) for k in range(80)]
    return out + [out[2], (None, "no id"), (-5, "negative"), (900, None), (901, "w " * 30_000)]


def test_shards_hold_every_id_of_every_text(spark, folder):
    rows = texts()
    stored = f"{folder}/docs"
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("clash")).repartition(5).write.parquet(stored)
    docs, path = spark.read.parquet(stored), f"{folder}/shards"
    shards.write_shards(docs, path, length=16, per_shard=50)
    model, _ = tokens.load_model(shards.MODEL)
    expected = []
    for doc_id, text in rows:
        ids = model.encode(text or "")
        expected += [(doc_id, k, tuple(ids[16 * k : 16 * k + 16])) for k in range(-(-len(ids) // 16))]
    records = shards.read_shards(spark, path, length=16, per_shard=50).collect()
    total = len(expected)
    assert len(records) == total
    got = [(r["doc_id"], r["sequence"], tuple(np.frombuffer(r["ids"], "<u2").tolist())) for r in records]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert sorted(r["slot"] for r in records) == list(range(total))
    # A reader needs the manifest only: a slot says the shard and the byte.
    wide = shards.stride(16)
    firsts = {r["shard"]: r["first_slot"] for r in shards.manifest(spark, path, 16, 50).collect()}
    assert len(firsts) > 10
    for r in records[:: max(1, total // 40)]:
        shard = max(s for s, first in firsts.items() if first <= r["slot"])
        assert (r["shard"], r["byte_offset"]) == (shard, (r["slot"] - firsts[shard]) * wide)
        [file] = glob.glob(f"{path}/shard={r['shard']}/part-*")
        with open(file, "rb") as f:
            f.seek(r["byte_offset"] + shards.HEADER)
            assert f.read(2 * r["n_ids"]) == bytes(r["ids"])


def test_order_is_the_keys(spark, folder):
    spark.createDataFrame(texts(), "doc_id long, text string").write.parquet(folder)
    docs = spark.read.parquet(folder)
    first, again, other = (
        {(r["doc_id"], r["sequence"], r["sha256"], r["slot"]) for r in shards.training_order(docs, key=k).collect()}
        for k in ("a", "a", "b")
    )
    assert first == again != other
    assert {r[:3] for r in first} == {r[:3] for r in other}


@pytest.mark.parametrize("entries", [0, 300, shards.ENTRIES])
def test_kept_words_change_no_ids(monkeypatch, entries):
    monkeypatch.setattr(shards, "ENTRIES", entries)
    monkeypatch.setattr(shards, "CHUNK", 3000)
    rng = random.Random(9)
    own = [text for _, text in texts()] + ["".join(rng.choice("ab é▁\n漢") for _ in range(rng.randrange(90))) for _ in range(300)]
    own += ["x" * 20_000, "\n\n ", " ", "▁"]
    model, _ = tokens.load_model(shards.MODEL)
    expected = [model.encode(text or "") for text in own]
    words = shards.Words(shards.MODEL)
    for _ in range(2):
        column = utf8_column(pa.array(own, pa.string()))
        assert words.lengths(*column).tolist() == [len(ids) for ids in expected]
        assert [ids.tolist() for ids in words.texts(*column)] == expected


def test_order_is_that_of_the_permutation(spark, folder):
    # Ten files of several row groups each, with texts of many sequences and repeated rows.
    rows = [(k % 190, text) for k in range(20) for _, text in texts()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(10)
    docs.write.option("parquet.block.size", 4096).option("parquet.page.row.count.limit", 20).parquet(folder)
    docs = spark.read.parquet(folder)
    model, _ = tokens.load_model(shards.MODEL)
    place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    expected = []
    for r in sorted(docs.select(*place, "doc_id", "text").collect(), key=lambda r: r[:2]):
        n = -(-len(model.encode(r["text"] or "")) // 32)
        expected += [(r["doc_id"], k) for k in range(n)]
    slots = shards.permuted(np.arange(len(expected)), len(expected), "k")
    expected = {slot: sequence for slot, sequence in zip(slots.tolist(), expected)}
    changed = {}
    name, limits = "spark.sql.files.maxPartitionBytes", ("128m", "3k", "40k")
    try:
        for limit, most in zip(limits, (shards.PIECES, shards.PIECES, 1)):
            spark.conf.set(name, limit)
            again = spark.read.parquet(folder)
            changed[limit] = again.rdd.getNumPartitions()
            out = shards.training_order(again.select("text", "doc_id"), length=32, per_shard=1000, key="k", most_pieces=most)
            rows = out.collect()
            assert len(rows) == len(expected)
            assert {r["slot"]: (r["doc_id"], r["sequence"]) for r in rows} == expected
            assert all(r["slot"] // 1000 == r["shard"] for r in rows)
    finally:
        spark.conf.unset(name)
    assert len(set(changed.values())) > 1
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_rows_without_a_place_are_stored_first(spark, folder):
    spark.createDataFrame(texts(), "doc_id long, text string").write.parquet(folder)
    docs = spark.read.parquet(folder)
    expected = sorted((r["doc_id"] or 0, r["sequence"]) for r in shards.training_order(docs).collect())
    twice = docs.withColumn("_metadata", F.lit("clash")).union(docs.withColumn("_metadata", F.lit("x")))
    for other in (twice, docs.withColumn("_metadata", F.explode(F.array(F.lit(1), F.lit(2))))):
        rows = shards.training_order(other).collect()
        assert sorted((r["doc_id"] or 0, r["sequence"]) for r in rows) == sorted(2 * expected)
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    clash = docs.withColumn("_metadata", F.lit("clash"))
    assert sorted((r["doc_id"] or 0, r["sequence"]) for r in shards.training_order(clash).collect()) == expected


def test_a_worker_needs_memory_for_a_batch_and_no_more(monkeypatch):
    rng = random.Random(3)
    own = [" ".join(rng.choice(["one", "two", "x\n", "三"]) for _ in range(500)) for _ in range(2000)]
    column = utf8_column(pa.array(own, pa.string()))
    monkeypatch.setattr(text, "_powers", np.ones(1, np.uint64))
    monkeypatch.setattr(text, "_inverses", np.ones(1, np.uint64))
    words = shards.Words(shards.MODEL)
    tokens.load_model(shards.MODEL)
    tracemalloc.start()
    try:
        words.lengths(*column)
        assert sum(1 for _ in words.texts(*column)) == len(own)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(column[0]) > 3e6
    assert peak < 60e6


@pytest.mark.parametrize("most", [shards.PIECES, 1])
def test_workers_get_small_batches(spark, folder, monkeypatch, most):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.rpad(F.lit("a b"), 4000, " cd").alias("text"))
    rows.coalesce(1).write.parquet(folder)
    made = shards.map_arrow

    def watched(df, function, schema):
        def run(batches):
            def small():
                for batch in batches:
                    if batch.nbytes > 4 << 20:
                        raise RuntimeError(f"a batch of {batch.nbytes} bytes")
                    yield batch

            return function(small())

        return made(df, run, schema)

    monkeypatch.setattr(shards, "map_arrow", watched)
    shards.write_shards(spark.read.parquet(folder), f"{folder}-shards", per_shard=500, most_pieces=most)
    monkeypatch.undo()
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None
    read = shards.read_shards(spark, f"{folder}-shards", per_shard=500).select("doc_id", "sequence", "slot").collect()
    assert sorted(r["slot"] for r in read) == list(range(len(read)))
    assert {r["doc_id"] for r in read if r["sequence"] == 0} == set(range(3000))


def test_nothing_to_write(spark, folder):
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert shards.training_order(empty).count() == 0
    assert shards.training_order(empty.where("doc_id = 9")).count() == 0
