import random
import time

import pytest
from pyspark.sql import functions as F

from tideline.llm import chat, licenses, toxicity
from tideline.llm.common import sampled


@pytest.mark.parametrize("total", [5, 1000, 10**6, 6 * 10**9, 5 * 10**10, 10**13])
def test_samples_of_any_table_have_rows(spark, total):
    """The share of all hashes that a sample takes is about right, and never none."""
    rows = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    share = min(1.0, 6000 / total)
    found = rows.where(sampled(F.col("h"), 6000, total)).count()
    assert abs(found - share * 200_000) <= 5 * (share * 200_000) ** 0.5 + (share * 200_000 < 1)
    threshold = spark.range(1).select(sampled(F.lit(0).cast("long"), 6000, total)).first()[0]
    assert threshold is True


def test_samples_of_nothing(spark):
    assert spark.range(3).where(sampled(F.xxhash64("id"), 10, 0)).count() == 3


def records(spark, conversations):
    rows = [(c, t, role, text) for c, turns in conversations.items() for t, (role, text) in enumerate(turns)]
    return chat.conversations_to_records(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def test_roles_with_line_feeds_are_roles(spark):
    given = {
        1: [("user\nassistant", "one turn")],
        2: [("system\nuser", "a"), ("assistant", "b")],
        3: [("system", "a"), ("user\nassistant", "b")],
        4: [("user", "a"), ("assistant", "b")],
        5: [("", "")],
    }
    for r in chat.formatted_records(records(spark, given)).collect():
        assert [(t.role, t.text) for t in r.turns] == given[r.conv_id]


def test_own_columns_of_records(spark):
    more = records(spark, {1: [("user", "a"), ("assistant", "b")]})
    more = more.withColumns({"turns": F.lit(1), "layout": F.lit("x"), "formatted": F.lit(2), "loss": F.lit(3), "other": F.lit("stays")})
    r = chat.formatted_records(more).first()
    assert [t.text for t in r.turns] == ["a", "b"] and r.layout != "x" and r.other == "stays" and len(r.loss) == 1


def contained_in_none(found):
    """The detections by the definition: each against all that were kept before."""
    kept = []
    for _, _, a, b, label, confidence in sorted(found, key=lambda d: (-d[0], -d[1], d[2], d[4])):
        if not any(c <= a and b <= d for c, d, _, _ in kept):
            kept.append((a, b, label, confidence))
    return sorted(kept)


def test_overlaps_as_defined(monkeypatch):
    rng = random.Random(1)

    class Found:
        def __init__(self, a, b):
            self.a, self.b = a, b

        def start(self):
            return self.a

        def end(self):
            return self.b

    class Pattern:
        def __init__(self, spans):
            self.spans = spans

        def finditer(self, low):
            return [Found(a, b) for a, b in self.spans]

    for _ in range(200):
        made = []
        for k in range(rng.randint(1, 6)):
            starts = [rng.randint(0, 40) for _ in range(rng.randint(0, 12))]
            spans = [(a, a + rng.randint(1, 15)) for a in starts]
            made.append(licenses.Rule(f"r{k}", Pattern(spans), (), rng.randint(1, 3), 0.5))
        monkeypatch.setattr(licenses, "rules", lambda made=made: tuple(made))
        flat = [(r.priority, b - a, a, b, r.label, 0.5) for r in made for a, b in r.pattern.spans]
        assert licenses.detections(b"", gated=False) == contained_in_none(flat)


def test_a_megabyte_of_phrases_takes_seconds():
    low = b"released under the mit license. " * 33_000
    began = time.process_time()
    n_words, n_base, first, last, *_ = licenses._scan_one(low)
    assert (n_words, n_base, first, last) == (5 * 33_000, 33_000, 1, 5 * 32_999 + 1)
    assert time.process_time() - began < 10


@pytest.mark.parametrize(
    "text, labels",
    [
        ("SPDX-License-Identifier: (MIT OR Apache-2.0)", {"mit", "apache-2"}),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", {"gpl-2"}),
        ("SPDX-License-Identifier: BSD-3-Clause AND (MPL-2.0 OR LGPL-2.1)", {"bsd-3-clause", "mpl-2", "lgpl-2.1"}),
        ("It is dual licensed under MIT and Apache-2.0.", {"mit", "apache-2"}),
        ("dual-licensed under the MIT license or the GPL v3 license. Ruby is nice", {"mit", "gpl-3"}),
        ("see https://creativecommons.org/licenses/by-nc/4.0/", {"cc-by-nc-4"}),
        ("http://www.apache.org/licenses/LICENSE-2.0", {"apache-2"}),
        ("https://opensource.org/licenses/MIT", {"mit"}),
        ("https://www.gnu.org/licenses/lgpl-3.0.html", {"lgpl-3"}),
        ("two licensed dogs and a cat, or the boost of mit", set()),
    ],
)
def test_expressions_lists_and_addresses(text, labels):
    low = text.encode().translate(licenses.LOWER)
    found = {label for _, _, label, _ in licenses.detections(low)}
    assert labels <= found if labels else not found
    assert found == {label for _, _, label, _ in licenses.detections(low, gated=False)}


def test_kept_columns_called_like_results(spark):
    docs = spark.createDataFrame([(1, 5, "x", "under the MIT license")], "doc_id long, n_words int, Labels string, text string")
    row = licenses.scan(docs, keep=("doc_id", "n_words", "Labels")).first()
    assert (row["doc_id"], row["n_words"], row["labels"]) == (1, 4, "mit")


def test_many_harmless_phrases_take_little_time():
    model = toxicity.Model({"=trash": 2.0, "^idio": 2.0}, exceptions=("trash can", "a trash can fire"))
    text = "trash can and idiots " * 20_000
    began = time.process_time()
    hits = model.hits(text)
    assert {t for _, _, t in hits} == {"^idio"} and len(hits) == 20_000
    assert time.process_time() - began < 5


def test_hits_inside_phrases_as_defined():
    model = toxicity.Model({"=b": 1.0, "=c": 1.0, "^d": 1.0}, exceptions=("a b", "b c d", "d d"))
    rng = random.Random(2)
    for _ in range(300):
        text = " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 12)))
        spans = [(i, i + len(p)) for p in model.exceptions for i in range(len(text)) if text.startswith(p, i)]
        plain = [(i, i + 1) for i, c in enumerate(text) if c in "bcd" and not any(a <= i and i + 1 <= b for a, b in spans)]
        assert sorted((a, b) for a, b, _ in model.hits(text)) == plain


def test_beginnings_of_long_runs_are_terms():
    run = "漢" * 60
    assert "^" + run[: toxicity.PREFIXES[0]] in toxicity.terms_of(run)
    assert "=" + run not in toxicity.terms_of(run)
