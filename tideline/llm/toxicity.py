"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, strips accents, maps look-alike letters of other scripts and digits or signs
that stand for letters to one form, and drops invisible characters, so a term is found however it
is disguised.  A term is a whole word or the beginning of words.  Terms and weights are learned
from labelled texts: log ratios of how often toxic and clean texts hold the term, terms picked one
after the other by how many toxic texts they add, so that words which merely go along with picked
ones stay out.  A hit inside an exception phrase does not count.  The score is a logistic function
of the hits' weights, alone and by the text's length.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tideline.llm.common import map_arrow, sampled, ship, written

#: Most labelled texts that the model is fitted on; beyond, a hash picks so many at random.
SAMPLE_ROWS = 20_000
#: Terms looked at, and terms in a lexicon, at most.
CANDIDATES = 100_000
TERMS = 400
#: Lengths of word beginnings that may become terms.
PREFIXES = range(4, 9)
#: Least cautious log ratio of a term's frequencies in toxic and clean texts.
EVIDENCE = 2.5
#: A term counts this much less for a text that already holds a picked term.
FADE = 0.5

#: Terms known beforehand; labelled texts change their weights.
KNOWN = (
    "idiot", "moron", "stupid", "scum", "loser", "worthless", "pathetic", "disgusting", "trash", "clown",
    "imbecile", "retard", "bastard", "asshole", "bitch", "whore", "slut", "dumbass", "jerk", "creep",
)
KNOWN_WEIGHT = 3.0
#: Phrases in which a term is harmless.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "take out the trash", "clown fish", "class clown", "circus clown",
    "pathetic fallacy", "pond scum", "stupid question", "sore loser", "jerk chicken", "flame retardant",
)

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w",
    "х": "x", "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɡ": "g", "ɑ": "a", "ⅼ": "l", "ø": "o", "ł": "l",
}
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
_SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
_INVISIBLE = [0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)]
_SIGN_IN_WORD = re.compile(r"[@$!|](?=[^\W_])")
_WORDS = re.compile(r"[^\W_]+")


def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for code in [*range(0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F), *range(0x2170, 0x2180)]:
        low = unicodedata.normalize("NFKD", chr(code).lower())
        base = "".join(c for c in low if not unicodedata.combining(c)) if code > 127 else low
        base = "".join(_LOOKALIKES.get(c, c) for c in base)
        base = "".join(_DIGITS.get(c, c) for c in base)
        table[code] = base.replace("l", "i")  # one, l and i stand for each other
    table.update((code, None) for code in _INVISIBLE)
    return table


_FOLD = _table()


def folded(text: str | None) -> str:
    """The form of a text in which disguised letters are equal."""
    if not text:
        return ""
    if "@" in text or "$" in text or "!" in text or "|" in text:
        text = _SIGN_IN_WORD.sub(lambda m: _SIGNS[m.group()], text)
    return text.translate(_FOLD)


def terms_of(text: str | None) -> set[str]:
    """What may become a term: ``=word`` for whole words, ``^abcd`` for beginnings."""
    words = set(_WORDS.findall(folded(text)))
    # Of a longer run, such as a sentence of a script without spaces, only beginnings can be terms.
    out = {"=" + w for w in words if 2 < len(w) <= 40}
    for size in PREFIXES:
        out.update("^" + w[:size] for w in words if len(w) >= size)
    return out


@dataclass
class Model:
    """A lexicon with weights, and the logistic function over what it finds."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    coefficients: tuple[float, ...] = (-4.0, 1.0, 1.0, 0.5)
    _automaton: object = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            made, entries = ahocorasick.Automaton(), {}
            for term in self.weights:
                entries.setdefault(term[1:], []).append(term)
            for phrase in self.exceptions:
                entries.setdefault(folded(phrase), []).append("")
            for key, terms in entries.items():
                made.add_word(key, (len(key), tuple(terms)))
            if entries:
                made.make_automaton()
            self._automaton = made
        return self._automaton

    def hits(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, term) in a folded text, without those in exception phrases."""
        found, harmless = [], []
        if not len(self.automaton()):
            return []
        for end, (size, terms) in self.automaton().iter(text):
            start = end - size + 1
            if start and text[start - 1].isalnum():
                continue
            closed = end + 1 == len(text) or not text[end + 1].isalnum()
            for term in terms:
                if not term:
                    if closed:
                        harmless.append((start, end + 1))
                elif term[0] == "^" or closed:
                    found.append((start, end + 1, term))
        if harmless:
            # How far the phrases reach that begin at or before each place.
            harmless.sort()
            begins = [a for a, _ in harmless]
            reach = list(accumulate((b for _, b in harmless), max))
            found = [h for h in found if not (at := bisect_right(begins, h[0])) or reach[at - 1] < h[1]]
        return found

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Weight of all hits, the same for 100 words, and the number of different terms."""
        low = folded(text)
        hits = self.hits(low)
        if not hits:
            return 0.0, 0.0, 0.0
        weight = sum(self.weights[t] for _, _, t in hits)
        words = low.count(" ") + low.count("\n") + 1
        return math.log1p(weight), math.log1p(100 * weight / (words + 20)), float(min(len({t for _, _, t in hits}), 5))

    def score(self, text: str | None) -> float:
        c = self.coefficients
        z = c[0] + sum(a * b for a, b in zip(c[1:], self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _count_terms(docs: DataFrame, among=None) -> DataFrame:
    """``term, n``: texts that hold each term (one of ``among`` if given)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = among.value if among is not None else None
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"]
            )

        for batch in batches:
            for text in batch.column(0).to_pylist():
                terms = terms_of(text)
                seen.update(terms if known is None else terms & known)
                if len(seen) > 500_000:
                    yield out()
                    seen.clear()
        yield out()

    return map_arrow(docs.select("text"), run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _log_rate(toxic: int, n_toxic: int, clean: int, n_clean: int) -> tuple[float, float]:
    """How much more common a term is among toxic texts (log ratio), and a cautious lower value."""
    rate = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
    return rate, rate - 1.5 * math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def _pick(holders: list[set[str]], toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Terms and weights: again and again the term that adds most to the toxic texts found."""
    by_term: dict[str, list[int]] = {}
    for k, terms in enumerate(holders):
        for t in terms:
            by_term.setdefault(t, []).append(k)
    left = np.ones(len(holders))
    least = max(3.0, 0.005 * n_toxic)
    # What a clean text with the term costs, beside the toxic ones.
    cost = {t: 3.0 * clean.get(t, 0) * n_toxic / max(1, n_clean) for t in by_term}
    places = {t: np.array(v) for t, v in by_term.items()}
    # Gains only fall, so a term whose old gain is no longer the best need not be counted anew.
    heap = [(-(len(v) - cost[t]), -(t[0] == "="), -len(t), t) for t, v in places.items()]
    heapq.heapify(heap)
    picked: dict[str, float] = {}
    while heap and len(picked) < TERMS:
        old, whole, size, t = heapq.heappop(heap)
        gain = float(left[places[t]].sum()) - cost[t]
        if gain < least:
            if -old < least:
                break
            continue
        if -old > gain + 1e-9:
            heapq.heappush(heap, (-gain, whole, size, t))
            continue
        stem = t[1:]
        if any(p[1:].startswith(stem) or stem.startswith(p[1:]) for p in picked):
            continue
        picked[t] = min(8.0, _log_rate(toxic[t], n_toxic, clean.get(t, 0), n_clean)[0])
        left[places[t]] *= FADE
    return picked


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Model:
    """A model from labelled texts: ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Rows without an id or label are left out, an id labelled twice is toxic if either label is.
    At most about ``sample`` labelled texts, picked by a hash of the id, are used, and texts that
    occur twice count once.  Without toxic or without clean texts the known terms are all there is.
    """
    spark = docs.sparkSession
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # The ids picked are bounded by the sample's size, so they may be broadcast.
    picked = F.broadcast(marked.where(sampled(F.xxhash64("doc_id", F.lit(31)), sample, marked.count())))
    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(picked, "doc_id")
    texts = texts.withColumn("_mark", F.xxhash64("text")).dropDuplicates(["_mark", "toxic"])
    texts = written(texts.select("text", (F.col("toxic") > 0).cast("int").alias("toxic")).repartition(24), "toxic-sample")
    counts = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    known = {"=" + folded(w): KNOWN_WEIGHT for w in KNOWN}
    if not n_toxic or not n_clean:
        return Model(known)
    bad, good = texts.where("toxic = 1"), texts.where("toxic = 0")
    frequent = _count_terms(bad).where(F.col("n") >= max(3.0, 0.005 * n_toxic)).orderBy(F.desc("n"), "term").limit(CANDIDATES)
    toxic = {r["term"]: r["n"] for r in frequent.collect()}
    among = spark.sparkContext.broadcast(set(toxic) | set(known))
    clean = {r["term"]: r["n"] for r in _count_terms(good, among).collect()}
    strong = {t for t, n in toxic.items() if _log_rate(n, n_toxic, clean.get(t, 0), n_clean)[1] >= EVIDENCE}
    chosen = spark.sparkContext.broadcast(strong)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted(terms_of(t) & chosen.value) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], names=["terms"])

    holders = [set(r["terms"]) for r in map_arrow(bad.select("text"), held, "terms array<string>").toLocalIterator()]
    weights = _pick(holders, toxic, clean, n_toxic, n_clean)
    # A known term that clean texts hold as often as toxic ones says nothing here.
    rare = {r["term"]: r["n"] for r in _count_terms(bad, spark.sparkContext.broadcast(set(known))).collect()}
    idle = {t for t in known if clean.get(t, 0) and clean[t] * n_toxic >= rare.get(t, 0) * n_clean}
    for term, weight in known.items():
        if not any(term[1:].startswith(t[1:]) for t in weights) and term not in idle and term not in toxic:
            weights[term] = weight
    model = Model(weights)
    shared = spark.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [shared.value.features(t) for t in batch.column(0).to_pylist()]
            columns = [pa.array([r[i] for r in rows], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(1)], names=["a", "b", "c", "toxic"])

    rows = map_arrow(texts, measured, "a double, b double, c double, toxic int").groupBy("a", "b", "c", "toxic").count().collect()
    # Texts alike in all features are one row that weighs as many.
    x = np.array([[1.0, r["a"], r["b"], r["c"]] for r in rows])
    n = np.array([r["count"] for r in rows], float)
    y = np.array([r["toxic"] for r in rows], float)
    model.coefficients = tuple(float(v) for v in _logistic(x, y, n))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression of rows that stand for ``n`` texts each, by damped Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-4
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + penalty * w
        curve = (x.T * (n * (p * (1 - p)) + 1e-9)) @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def with_scores(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the toxicity of every whole text, 0 to 1; null and empty texts score like clean ones."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for batch in batches:
            yield pd.Series([model.score(t) for t in batch], dtype="float64")

    return docs.withColumn(score, scored(F.col(f"`{text}`")))
