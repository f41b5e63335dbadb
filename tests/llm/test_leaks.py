import random
import re

import pytest
from pyspark.sql import functions as F

from tideline.llm import leaks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def grams(words, n):
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(docs, items, least=0.8, n=5):
    out = []
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        for item_id, item in set(items):
            own = WORD.findall(item or "")
            if own:
                k = min(n, len(own))
                need = grams(own, k)
                shared = len(need & grams(words, k))
                if shared >= least * len(need) - 1e-9:
                    out.append((doc_id, item_id, len(need), shared))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(prose(rng.choice([1, 2, 3, 4, 5, 6, 9, 15, 22, 40, 60, 130])))) for k in range(60)]
    items += [items[4], (4, "another text of item four with some words"), (None, "an item that has no id at all"), (90, ""), (91, None)]
    docs = []
    for k in range(120):
        words = prose(rng.choice([0, 3, 30, 300, 6000]))
        for _ in range(rng.randint(0, 3)):
            passage = WORD.findall(rng.choice(items)[1] or "")
            for _ in range(rng.choice([0, 0, 0, 1, 2, 6])):
                if passage:
                    passage[rng.randrange(len(passage))] = "changed"
            cut = rng.randrange(len(words) + 1)
            words[cut:cut] = passage
        docs.append((k, "\n".join(words) if k % 2 else "  ".join(words)))
    return docs + [docs[0], (None, docs[1][1]), (500, None), (501, "")], items


def test_pairs_match_brute_force(spark, tables):
    docs, items = tables
    found = leaks.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in found), key=str) == brute(docs, items)
    assert all(r.containment == r.n_shared / r.n_item for r in found)


def test_shards_of_items_give_the_same(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(leaks, "SHARD_BYTES", 6000)
    found = leaks.find_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in found), key=str) == brute(docs, items)


def test_clean_documents_stay(spark, tables):
    docs, items = tables
    given = spark.createDataFrame(docs, DOCS).withColumn("item_id", F.lit(1)).select("item_id", "text", "doc_id")
    kept = leaks.without_leaks(given, spark.createDataFrame(items, ITEMS))
    assert kept.columns == given.columns
    dirty = {d for d, *_ in brute([(i, t) for i, (_, t) in enumerate(docs)], items)}
    expected = [(d, t) for i, (d, t) in enumerate(docs) if i not in dirty]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_empty_tables(spark, tables):
    docs, items = tables
    no_docs, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert leaks.find_leaks(no_docs, spark.createDataFrame(items, ITEMS)).count() == 0
    assert leaks.find_leaks(spark.createDataFrame(docs, DOCS), no_items).count() == 0
    assert leaks.without_leaks(spark.createDataFrame(docs, DOCS), no_items).count() == len(docs)


def test_short_item_inside_a_very_long_document(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(5000)}" for _ in range(150_000)]
    item = " ".join(f"w{rng.randrange(5000)}" for _ in range(12))
    words[70_000:70_000] = item.split()
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:60_000]))], DOCS)
    assert [r.doc_id for r in leaks.find_leaks(docs, spark.createDataFrame([(1, item)], ITEMS)).collect()] == [1]
