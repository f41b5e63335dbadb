import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm import ranked, resample
from tideline.llm.common import utf8_column

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def buckets(text, n=10_000):
    w = words(text)
    return [zlib.crc32(f.encode()) % n for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def texts(seed, count, longest=60):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "of", "é漢", "Zürich", "x" * 70, "y" * 49, "z" * 48, "a1", "42", *(f"w{k}" for k in range(60))]
    make = lambda: rng.choice([" ", ", ", "\n", "-"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, longest)))
    return [make() for _ in range(count)] + [None, "", " . ", "È", "ÀB c"]


# ------------------------------------------------------------------ resampling


def test_features_match_a_plain_version():
    some = texts(1, 200)
    found, rows, n_words = resample.feature_buckets(*utf8_column(pa.array(some)), 10_000)
    assert n_words.tolist() == [len(words(t)) for t in some]
    for k, t in enumerate(some):
        assert Counter(found[rows == k].tolist()) == Counter(buckets(t))


def plain_resample(rows, target, share=(25, 100), least=20):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        own = buckets(text)
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in own)
        weight = gain // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(words(text)), len(own), weight, score))
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, [r[0] for r in fit[: len(fit) * share[0] // share[1]]]


def test_resampling_matches_a_plain_version(spark):
    rows = list(enumerate(texts(2, 300))) + [(None, "w1 w2 w3 " * 10), (None, "w1 w2 w3 " * 10), (7, "w4 " * 30), (7, "w4 " * 30)]
    target = ["w1 w2 w3 w1 w2", "w5 of the", None, ""]
    docs = spark.createDataFrame([(*r, 1, "own", 2.0) for r in rows], "doc_id long, text string, rank int, weight string, key double")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = resample.resampled(docs.repartition(4), goal).collect()
    plain, drawn = plain_resample(rows, target)
    assert sorted([tuple(r[:5]) for r in found], key=str) == sorted(plain, key=str)
    ranked_rows = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked_rows] == list(range(1, len(drawn) + 1))
    assert [r["doc_id"] for r in ranked_rows] == drawn


@pytest.mark.parametrize("ids", ["string", "long"])
def test_every_share_draws_the_highest_scores(spark, ids):
    docs = spark.range(90).select(F.col("id").cast(ids).alias("doc_id"), F.repeat(F.lit("one two "), 15).alias("text"))
    for part in (0, 1, 50, 99, 100):
        rows = resample.resampled(docs, docs.limit(0), share=(part, 100)).collect()
        best = sorted(rows, key=lambda r: (-r["score"], r["doc_id"]))[: 90 * part // 100]
        assert [r["doc_id"] for r in best] == [r["doc_id"] for r in sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])]


def test_the_kth_key_among_ties_and_nulls(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 5), rng.choice([None, "it's", "b\\n", "é"]), k) for k in range(200)]
    keys = spark.createDataFrame(rows, "s long, id string, row long").select(F.struct("s", "id", "row").alias("key"))
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, (r[1] or "").encode(), r[2]))
    for k in (1, 2, 77, 199, 200):
        assert resample.kth_key(keys, k, pivots=3) == order[k - 1]
    assert resample.kth_key(keys, 201) is None
    assert resample.kth_key(keys.limit(0), 1) is None


def test_ranks_go_on_over_ranges(spark):
    rows = spark.range(5000).withColumn("score", F.xxhash64("id"))
    found = resample.ranked(rows, F.struct("score", "id"), range_rows=100).collect()
    assert [r["id"] for r in sorted(found, key=lambda r: r["rank"])] == [r["id"] for r in sorted(found, key=lambda r: r["score"])]
    assert sorted(r["rank"] for r in found) == list(range(1, 5001))


def test_no_documents_and_no_target(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resampled(none, none).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    row = resample.resampled(one, none).first()
    assert (row["n_features"], row["weight"], row["rank"]) == (0, 0, None)


# ------------------------------------------------------------------ ranked search


def plain_search(rows, items, k=50):
    docs = [(doc_id, Counter(words(text))) for doc_id, text in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total, df = len(docs), sum(sum(c.values()) for _, c in docs), Counter()
    for _, c in docs:
        df.update(c.keys())
    out = []
    for item, text in items:
        scores = []
        for doc_id, c in docs:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = 0
            for term in set(words(text)):
                tf = c[term]
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def rows_of(found):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()], key=str)


@pytest.fixture(scope="module")
def corpus():
    rows = list(enumerate(texts(5, 400)))
    # A third of the rows are copies, and as many nearly.
    rows += [(1000 + k, "w1 w2 w3 of the w9") for k in range(200)]
    rows += [(2000 + k, f"w1 w2 w3 of the w9 v{k}") for k in range(200)]
    rows += [(None, "w1 w2"), (None, "w1 w2"), (7, "w5 w6"), (7, "w5 w6"), (3000, "w1 " * 70_000)]
    return rows


ITEMS = [(0, "w1 w2 w3"), (1, "the of The"), (2, None), (3, ""), (4, "unknown words"), (4, "w5 w6"), (None, "w9 É漢 é漢"), (5, "x" * 70), (6, "v17 w9 w1 w1")]


@pytest.mark.parametrize("k, first, block", [(50, 100, 256), (3, 3, 256), (50, 1, 2)])
def test_search_matches_a_plain_version(spark, corpus, monkeypatch, k, first, block):
    monkeypatch.setattr(ranked, "BLOCK_ITEMS", block)
    docs = spark.createDataFrame([(*r, 1, 2) for r in corpus], "doc_id long, text string, n int, rank int").repartition(6)
    items = spark.createDataFrame([(*i, "own") for i in ITEMS], "item_id long, text string, score string")
    found = ranked.searched(ranked.indexed(docs), items, k=k, first=first)
    assert rows_of(found) == plain_search(corpus, ITEMS, k)


def test_bounds_are_never_below_scores_whatever_collides():
    rng = np.random.default_rng(6)
    some = [t or "" for t in texts(7, 120)]
    hashes, rows = ranked.term_hashes(*utf8_column(pa.array(some)))
    hashes = hashes & np.uint64(0x0003FFFFFFFFFFFF)  # four coordinates for all
    n = np.bincount(rows, minlength=len(some)).astype(np.int64)
    sketch, exact = [], []
    for k in range(len(some)):
        terms, tf = np.unique(hashes[rows == k], return_counts=True)
        at = (terms >> np.uint64(48)).astype(np.uint16)
        peaks = {int(c): int(tf[at == c].max()) for c in np.unique(at)}
        sketch.append((np.array(list(peaks), "<u2").tobytes(), np.array(list(peaks.values()), "<u2").tobytes()))
        exact.append((terms.astype("<u8").tobytes(), tf.astype("<u4").tobytes()))
    terms = np.unique(hashes)[::3]
    block = ranked.Block(["a", "b"], terms, len(some), int(n.sum()), rng.integers(0, 9000, len(terms)))
    block.items = np.arange(len(terms)) % 2
    block.starts = np.arange(len(terms) + 1)
    bounds, scores = block.bounds(n, *zip(*sketch)), block.scores(n, *zip(*exact))
    assert (bounds >= scores).all() and (bounds > scores).any() and (scores > 0).any()


def test_sums_in_parts_are_the_same(monkeypatch):
    block = ranked.Block(["a", "b"], np.arange(5, dtype=np.uint64), 1, 1, np.arange(5))
    block.items, block.starts = np.array([0, 1, 0, 1, 0, 1, 1]), np.array([0, 2, 4, 5, 6, 7])
    args = np.array([0, 0, 1, 2, 2]), np.array([0, 1, 4, 2, 3]), np.array([5, 6, 7, 8, 9]), 3
    whole = block.sums(*args)
    monkeypatch.setattr(ranked, "_ENTRIES", 1)
    assert np.array_equal(block.sums(*args), whole)


def test_long_frequencies_and_ids_that_are_no_numbers(spark):
    rows = [("b", "w1 " * 70_000), ("a", "w1 " * 70_000), ("c", "w1 w2")]
    docs = spark.createDataFrame(rows, "name string, body string")
    items = spark.createDataFrame([("q", "w1 w2")], "ask string, words string")
    found = ranked.searched(ranked.indexed(docs, "name", "body"), items, item="ask", text="words", id="name").collect()
    assert [(r["ask"], r["rank"]) for r in sorted(found, key=lambda r: r["rank"])] == [("q", k + 1) for k in range(len(found))]
    assert [r["name"] for r in sorted(found, key=lambda r: r["rank"])] == ["c", "a", "b"]


def test_no_documents_no_items_no_terms(spark):
    docs = spark.createDataFrame([(1, "w1")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    index = ranked.indexed(docs)
    assert ranked.searched(index, items.limit(0)).count() == 0
    assert ranked.searched(ranked.indexed(docs.limit(0)), items).count() == 0
    assert ranked.searched(ranked.indexed(docs.withColumn("text", F.lit(None).cast("string"))), items).count() == 0
    assert ranked.searched(index, items.withColumn("text", F.lit("?"))).columns == ["item_id", "rank", "doc_id", "score"]
