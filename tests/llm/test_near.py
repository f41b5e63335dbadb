import random
import re

import pytest
from pyspark.sql import functions as F

from tideline.llm import near
from tideline.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def grams(text):
    w = WORD.findall(text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(doc_id, class_id, links) of every row by comparing all pairs."""
    sets = [grams(t) for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = root(i)
        least[r] = min(least.get(r, float("inf")), float("inf") if doc_id is None else doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        name = least[root(i)]
        out.append((doc_id, None if name == float("inf") else int(name), links[i]))
    return out


def family(rng, base, count, edits):
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
        out.append(" ".join(words))
    return out


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [" ".join(prose(rng.randint(1, 120))) for _ in range(60)]
    for size, edits in ((200, 5), (60, 2), (400, 12)):
        texts += family(rng, prose(size), 40, edits)
    texts += [texts[3]] * 30 + ["", None, " \n ", "one two", "one two", "one  two\n", "one", None]
    rows = [(k, t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [rows[0], (None, "no id here at all my friend"), (None, "no id here at all my friend"), (7000, texts[3])]


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_links_and_groups_match_brute_force(spark, rows):
    out = near.near_copies(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "class_id", "links").collect()
    assert sorted(map(tuple, out), key=key) == sorted(brute(rows), key=key)


def test_split_buckets_and_blocks_lose_nothing(spark, rows, monkeypatch):
    # With tiny limits every group takes the way of a hot one.
    monkeypatch.setattr(near, "BLOCK", 7)
    monkeypatch.setattr(near, "DEPTH", 2)
    monkeypatch.setattr(near.candidate_links, "__defaults__", (10,))
    out = near.near_copies(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "class_id", "links").collect()
    assert sorted(map(tuple, out), key=key) == sorted(brute(rows), key=key)


def test_one_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("_row_key", F.lit("x"))
    kept = near.without_copies(docs)
    assert kept.columns == docs.columns
    groups = {}
    for row, (_, name, links) in zip(rows, brute(rows)):
        groups.setdefault(("named", name) if links else ("alone", row), []).append(row)
    with_words = [r for r in map(tuple, kept.select("doc_id", "text").collect())]
    assert len(with_words) == len(groups)
    assert set(with_words) <= set(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert near.near_copies(none).count() == 0
    assert near.without_copies(none).count() == 0


def test_runs_follow_from_the_recall():
    assert near.runs_for(0.8, 0.9999) > near.runs_for(0.8, 0.9) >= 1
    assert near.runs_for(0.95, 0.9999) < near.runs_for(0.8, 0.9999)


def test_components_of_a_chain_a_star_and_a_ring(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(200, k) for k in range(201, 260)]
    edges += [(300 + k, 300 + (k + 1) % 40) for k in range(40)] + [(5, 5), (7, 6), (6, 7)]
    rng.shuffle(edges)
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {k: 100 for k in range(100, 161)} | {k: 200 for k in range(200, 260)} | {k: 300 for k in range(300, 340)}
    assert out == expected | {6: 6, 7: 6}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
