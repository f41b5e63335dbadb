import hashlib
import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tideline.llm import chat, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string"


def numbers(text):
    text = text or ""
    words = WORD.findall(text)
    windows, covered = {}, set()
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in windows.values():
        if len(places) > 1:
            covered |= {i + k for i in places for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_bangs": text.count("!"),
        "n_lines": len(lines),
        "n_doubled": sum(a == b for a, b in zip(words, words[1:])),
    }


def texts():
    rng = random.Random(6)
    some = lambda n, of: " ".join(rng.choice(of) for _ in range(n))
    out = ["", None, " \n\t ", "a", "a " * 8, "a " * 9, "one two three four five six seven eight " * 3]
    out += [some(rng.randint(0, 60), ["a", "b", "c"]) for _ in range(60)]
    out += [some(rng.randint(0, 90), [f"w{k}" for k in range(30)] + ["#x", "|", "!!", "é漢", "x\ny", "\x0b", "\n\n"]) for _ in range(60)]
    return out + [some(40, ["long"]) + " " + some(30_000, [f"v{k}" for k in range(9)])]


def test_numbers_match_a_plain_version(spark):
    rows = [(k, t, "en") for k, t in enumerate(texts())]
    for r in quality.features(spark.createDataFrame(rows, SCHEMA)).collect():
        expected = numbers(rows[r["doc_id"]][1])
        assert {n: r[n] for n in expected} == expected, rows[r["doc_id"]]


def exact_level(firsts, strata, alpha, delta):
    n, level = len(firsts), 0
    for k in range(1, quality.LEVELS + 1):
        rejected = sum(f <= k for f in firsts)
        chance = sum(math.comb(n, j) * alpha**j * (1 - alpha) ** (n - j) for j in range(rejected + 1))
        if rejected > alpha * n or chance > delta / strata:
            break
        level = k
    return level


def test_levels_follow_the_exact_binomial_bound(spark):
    rng = random.Random(8)
    rows, expected = [], {}
    groups = {"en": (900, 0.002), "de": (900, 0.02), "fr": (40, 0.0), None: (700, 0.0)}
    for name, (n, rate) in groups.items():
        firsts = [rng.randint(1, 6) if rng.random() < rate else 7 for _ in range(n)]
        expected[name or "none"] = exact_level(firsts, len(groups), 0.01, 0.05)
        rows += [(len(rows) + i, name or "none", f, False) for i, f in enumerate(firsts)]
    counted = spark.createDataFrame(rows, "doc_id long, _stratum string, _first int, base_failed boolean")
    labels = counted.select("doc_id", F.lit(1).alias("quality"))
    got = {r["_stratum"]: r["level"] for r in quality.chosen_levels(counted, labels, "lang", 0.01, 0.05).collect()}
    assert got == expected
    assert expected["fr"] == 0 and expected["none"] == quality.LEVELS


def test_verdicts(spark):
    clean = "some quite plain words that say one thing after the other without any noise in them at all today {}"
    rows = [(k, clean.format(k), "en") for k in range(800)]
    rows += [(1000, "### ||| $$$ " + clean, "en"), (1001, "!! " * 30 + clean, "en"), (1002, "short", "en"), (1003, None, None)]
    rows += [(1004, "### ||| $$$ " + clean, "xx"), (1005, "same words here " * 20, "en"), rows[0], (None, clean, "en")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("level", F.lit("clash")).withColumn("_first", F.lit(0))
    labels = spark.createDataFrame([(k, 1) for k in range(800)] + [(3, 0), (None, 1), (7, None)], "doc_id long, quality int")
    out = quality.judged(docs, labels).collect()
    assert len(out) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert all(kept[k] for k in range(800)) and kept[None]
    assert [kept[k] for k in range(1000, 1006)] == [False, False, False, False, True, False]
    assert {r["doc_id"] for r in out if r["base_failed"]} == {1001, 1002, 1003, 1005}
    none = labels.where("doc_id < 0")
    assert sum(r["kept"] for r in quality.judged(docs, none).collect()) == len(rows) - 4
    assert quality.judged(docs.where("doc_id < 0"), labels).count() == 0


CONTROL = ["<|turn:user|>", "<|end|>", "~1 ~0 ~2 ~~", "a<b|c>d\\e", "", None, "\n\n", "\\### Assistant: </turn> ok", "é漢\x00\x1f\"'", "x" * 200_000]


def turns_of(rows):
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    return [(r[2] or "", r[3] or "") for r in ordered]


def conversations():
    rng = random.Random(5)
    rows = []
    for conv in range(60):
        shape = rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["user"], None, ["assistant"] * 3])
        shape = shape or [rng.choice(["user", "assistant", "system", "tool|x", "a<b", "~", None, "human"]) for _ in range(rng.randint(1, 9))]
        rows += [(conv, k, role, rng.choice(CONTROL)) for k, role in enumerate(shape)]
    return rows + [(70, 1, "user", "tie"), (70, 1, "user", "tie"), (70, 1, "assistant", "tie"), (70, None, "user", "first"), (None, 0, "user", "x")]


def test_every_text_comes_back(spark):
    rows = conversations()
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("layout", F.lit(1))
    out = chat.formatted_records(chat.conversations_to_records(given)).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(r)
    assert len(out) == len(by_id)
    assert {r["layout"] for r in out} == {"prompt-response", "instruction", "from-value", "messages"}
    for r in out:
        expected = turns_of(by_id[r["conv_id"]])
        assert [(t["role"], t["text"]) for t in r["turns"]] == expected
        assert r["formatted"].count("<|end|>") == r["formatted"].count("<|turn:") == len(expected)
        plain = "".join(r["formatted"][s["start"] : s["end"]] for s in r["loss"])
        assert plain.replace("~1", "<").replace("~0", "~") == "".join(t for role, t in expected if role == "assistant")


def test_layouts_are_told_by_their_paths(spark):
    records = [
        {"id": 1, "messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]},
        {"messages": [{"role": "user", "content": None}], "id": 2},
        {"id": 3, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]},
        {"id": 4, "prompt": "q", "response": "a"},
        {"id": 5, "prompt": "q", "completion": "a"},
        {"id": 6, "instruction": "s", "input": "q", "output": "a"},
        {"id": 7, "question": "q", "answer": "a"},
        {"id": 8, "prompt": "q", "response": "a", "more": 1},
        {"id": 9, "messages": []},
        {},
    ]
    rows = [(k, json.dumps(r)) for k, r in enumerate(records)] + [(10, "no json"), (11, None), (12, "[1]")]
    out = chat.canonical(spark.createDataFrame(rows, "k int, record string")).orderBy("k").collect()
    assert [r["layout"] for r in out] == [
        "messages", "messages", "from-value", "prompt-response", "prompt-completion", "instruction", "question-answer",
    ] + [None] * 6
    turns = [[(t["role"], t["text"]) for t in r["turns"]] if r["turns"] is not None else None for r in out]
    pair = [("user", "q"), ("assistant", "a")]
    assert turns[:7] == [pair, [("user", "")], [*pair, ("tool", "t")], pair, pair, [("system", "s"), *pair], pair]
    assert turns[7:] == [None] * 6


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.formatted_records(chat.conversations_to_records(none)).count() == 0


def test_query_digests(spark, small):
    from tideline.llm.queries import QUERIES

    given = {}
    for r in spark.read.parquet(f"{small}/conversations.parquet").collect():
        given.setdefault(r["conv_id"], []).append((r["conv_id"], r["turn"], r["role"], r["text"]))
    given[-7] = [(-7, 0, "user", CONTROL[7]), (-7, 1, "assistant", CONTROL[7])]
    out = {r["conv_id"]: r for r in QUERIES["op8_chat_format"](spark, small).collect()}
    assert out.keys() == given.keys()
    for conv, rows in given.items():
        turns = turns_of(rows)
        loss = "".join(t for role, t in turns if role == "assistant")
        r = out[conv]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op2_quality_rules", "op8_chat_format"])
def test_native_queries_run_no_python(spark, small, name):
    from tideline.llm.queries import QUERIES

    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize(
    "record, layout, turns",
    [
        # Later elements with other fields or nested texts make another layout; nothing turns empty unseen.
        ({"id": "1", "messages": [{"role": "user", "content": "a"}, {"from": "gpt", "value": "b"}]}, None, None),
        ({"id": "1", "messages": [{"role": "user", "content": "a"}, {"role": "user", "content": [{"text": "b"}]}]}, None, None),
        ({"id": "1", "messages": [{"role": "user", "content": "a"}, {"role": "user", "content": {"parts": ["b"]}}]}, None, None),
        ({"id": "1", "messages": [{"role": "user", "content": "a"}, "b"]}, None, None),
        ({"id": "1", "messages": [{"role": "user", "content": "a"}, None]}, None, None),
        ({"id": "1", "prompt": {"text": "a"}, "response": "b"}, None, None),
        ({"id": "1", "messages": [{"role": "user", "content": "a"}, {"role": "tool", "content": 5}]}, "messages", [("user", "a"), ("tool", "5")]),
        ({"id": "1", "messages": [{"role": "user", "content": None}, {"role": "tool", "content": "b"}]}, "messages", [("user", ""), ("tool", "b")]),
        ({"id": "1", "instruction": "a", "output": "c"}, "instruction", [("system", "a"), ("assistant", "c")]),
        ({"id": "1", "instruction": "a", "input": None, "output": "c"}, "instruction", [("system", "a"), ("assistant", "c")]),
        ({"id": "1", "instruction": "a", "input": "", "output": "c"}, "instruction", [("system", "a"), ("user", ""), ("assistant", "c")]),
        ({"id": "1", "instruction": "a", "input": ["x"], "output": "c"}, None, None),
    ],
)
def test_layouts_of_heterogeneous_records(spark, record, layout, turns):
    row = chat.canonical(spark.createDataFrame([(json.dumps(record),)], "record string")).first()
    assert row["layout"] == layout
    assert row["turns"] == turns if turns is None else [tuple(t) for t in row["turns"]] == turns


def test_paths_cover_every_element_and_depth(spark):
    record = {"a": [{"x": 1}, {"y": [{"z": {"q": "s"}}]}], "b": {"c": [1.5]}, "d": [], "e.f": True}
    got = spark.createDataFrame([(json.dumps(record),), ("no json",)], "r string").select(chat.paths_of("r"), chat.fingerprint("r")).collect()
    assert got[0][0] == ["a", "a[].x", "a[].y:ARRAY<OBJECT<z: OBJECT<q: >>>", "b:OBJECT<c: ARRAY<>>", "d", "e.f"]
    assert got[1][0] is None and got[1][1] is None
