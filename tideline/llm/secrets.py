"""Secret scans: candidates by signature and shape, false findings removed by a random forest.

A candidate is

- a string in the form of an issuer's keys, wherever it begins at a border (also inside a path,
  a dotted name or a longer run),
- a run of 16 and more key-like characters that mixes letters with digits, and each such part of
  it between slashes and dots, or
- a value of four and more characters assigned to a name with a ``FOR`` word ('password = "..."').

Candidates may lie inside each other; the forest judges each for itself.  It sees its length, how its characters change class and
follow each other, how much of it dictionary words cover, the path of its document, and the
words beside it.  It is trained from labelled findings: a table of texts with the place of one
candidate and whether it is a secret.  ``planted_findings`` makes such a table from documents, by
writing keys and harmless look-alikes of known kind into their texts.
"""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import map_arrow, sampled, written

#: Signatures of issuers: fixed forms that their keys have.
SIGNATURES: tuple[tuple[str, str], ...] = (
    ("aws-access-key", r"(?:AKIA|ASIA)[0-9A-Z]{16}"),
    ("github-token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    ("slack-token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("google-api-key", r"AIza[0-9A-Za-z_-]{35}"),
    ("stripe-key", r"[sr]k_(?:live|test)_[0-9a-zA-Z]{16,}"),
    ("json-web-token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    ("private-key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
# A signature is searched for only in texts with one of the literals it cannot do without.
_LITERALS = (("AKIA", "ASIA"), ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), ("xox",), ("AIza",), ("k_live_", "k_test_"), ("eyJ",), ("PRIVATE KEY",))
_FORMS = tuple(re.compile(p) for _, p in SIGNATURES)
_BORDERED = tuple(re.compile(p if p.startswith("-") else f"(?<![A-Za-z0-9]){p}") for _, p in SIGNATURES)
_RUN = re.compile(r"[A-Za-z0-9_+/~.-]{16,}={0,2}")
_PART = re.compile(r"[^/.]+")
_ASSIGN = re.compile(r"[:=]")
_NAME = re.compile(r"[A-Za-z0-9_.\-]+(?=[\"'\])\s]*$)")
_NAME_WORD = re.compile(r"[A-Z]+(?![a-z])[0-9]*|[A-Z]?[a-z0-9]+")
_VALUE = re.compile(r"[=>]?\s*(?:\"([^\"\n]{4,})\"|'([^'\n]{4,})'|[\"']?([^\s\"'<>,;&]{4,}))")
_PLAIN = re.compile(r"[A-Za-z_.~/=+-]*|[0-9_.~/=+-]*")
_NEAR = re.compile(r"[a-z0-9]+")

#: Words beside a candidate that speak for a secret, and those that speak against one.
FOR = frozenset("token key secret password passwd pwd pass auth bearer credential credentials api apikey access private client login signing".split())
AGAINST = frozenset("sha sha1 sha256 md5 checksum commit hash digest uuid guid version revision example sample dummy placeholder mail email order invoice isbn image png jpg etag build integrity".split())
TEST_PATHS = re.compile(r"test|example|sample|doc|fixture|mock", re.I)
CODE_PATHS = re.compile(r"\.(?:py|js|java|go|rb|env|ya?ml|json|toml|ini|conf|sh)$", re.I)

FEATURES = (
    "length", "digits", "upper", "lower", "signs", "changes", "letter_digit", "entropy", "repeated", "hex_only",
    "pairs", "covered", "longest_word", "signature", "for_before", "against_before", "for_after", "against_after",
    "assigned", "quoted", "test_path", "code_path", "at_sign", "dashes", "dots", "least_covered",
)

#: Characters in a row whose coverage by words counts for itself.
WINDOW = 24

#: Most documents that findings are planted in.
SAMPLE_ROWS = 6_000
VOCABULARY = "word_bpe_49k.json"


@lru_cache(maxsize=2)
def _dictionary(name: str = VOCABULARY) -> tuple[frozenset, dict]:
    """Words of four letters and more from a public vocabulary, and log odds of letter pairs."""
    import json

    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = {w.removesuffix("</w>") for w in vocabulary if w.endswith("</w>")}
    words = {w for w in words if len(w) >= 4 and w.isascii() and w.isalpha()}
    counts: dict[str, int] = {}
    for w in words:
        for a, b in zip(w, w[1:]):
            counts[a + b] = counts.get(a + b, 0) + 1
    total = sum(counts.values())
    return frozenset(words), {p: math.log(n * 676 / total) for p, n in counts.items()}


def _covered(value: str) -> tuple[float, int, float]:
    """How dictionary words cover a string, longest first from the left.

    The covered share of the whole, the longest word, and the least share of any ``WINDOW``
    characters in a row (of the whole, if it is shorter).
    """
    words, _ = _dictionary()
    low, at, covered, longest = value.lower(), 0, 0, 0
    inside = bytearray(len(low))
    while at < len(low):
        for size in range(min(14, len(low) - at), 3, -1):
            if low[at : at + size] in words:
                inside[at : at + size] = b"\1" * size
                covered, longest, at = covered + size, max(longest, size), at + size
                break
        else:
            at += 1
    width = min(WINDOW, len(low))
    least = held = sum(inside[:width])
    for gone, come in zip(inside, inside[width:]):
        held += come - gone
        least = min(least, held)
    return covered / max(1, len(low)), longest, least / max(1, width)


def describe(text: str, start: int, end: int, signature: bool, path: str | None) -> list[float]:
    """The forest's view of one candidate, in the order of ``FEATURES``."""
    value = text[start:end]
    size = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in value]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    switches = sum({a, b} in ({"d", "l"}, {"d", "u"}) for a, b in zip(kinds, kinds[1:]))
    seen: dict[str, int] = {}
    for c in value:
        seen[c] = seen.get(c, 0) + 1
    entropy = -sum(n / size * math.log2(n / size) for n in seen.values())
    repeated = sum(a == b for a, b in zip(value, value[1:])) / size
    _, pairs = _dictionary()
    low = value.lower()
    letters = [a + b for a, b in zip(low, low[1:]) if a.isalpha() and b.isalpha()]
    likely = sum(pairs.get(p, -3.0) for p in letters) / len(letters) if letters else -3.0
    covered, longest, least = _covered(value)
    before, after = text[max(0, start - 60) : start].lower(), text[end : end + 40].lower()
    # Names in camel case are words as well.
    ahead = [w.lower() for w in _NAME_WORD.findall(text[max(0, start - 60) : start])][-3:]
    behind = _NEAR.findall(after)[:3]
    return [
        float(size), kinds.count("d") / size, kinds.count("u") / size, kinds.count("l") / size, kinds.count("s") / size,
        changes / size, switches / size, entropy, repeated, float(bool(re.fullmatch(r"[0-9a-fA-F]+", value))),
        likely, covered, float(longest), float(signature),
        float(any(w in FOR for w in ahead)), float(any(w in AGAINST for w in ahead)),
        float(any(w in FOR for w in behind)), float(any(w in AGAINST for w in behind)),
        float(bool(re.search(r"[:=]\s*[\"']?$", before))), float(before[-1:] in "\"'" and before != ""),
        float(bool(path and TEST_PATHS.search(path))), float(bool(path and CODE_PATHS.search(path))),
        float("@" in text[max(0, start - 1) : end + 1]), float(value.count("-")), float(value.count(".")), least,
    ]


def _signed(text: str) -> Iterator[tuple[int, int, str]]:
    """Strings in the form of an issuer's keys, at borders or right behind another one."""
    for (kind, _), literals, form, bordered in zip(SIGNATURES, _LITERALS, _FORMS, _BORDERED):
        if any(literal in text for literal in literals):
            for m in bordered.finditer(text):
                while m:
                    yield m.start(), m.end(), kind
                    m = form.match(text, m.end())


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """Long runs that mix letters with digits, and the parts of them that do."""
    for m in _RUN.finditer(text):
        if _PLAIN.fullmatch(m.group()):
            continue
        places = [(m.start(), m.end())]
        if "/" in m.group() or "." in m.group():
            places += [p.span() for p in _PART.finditer(text, m.start(), m.end())]
        for start, end in places:
            value = text[start:end]
            if _PLAIN.fullmatch(value):
                continue
            start, end = start + len(value) - len(value.lstrip(".-/~+")), end - len(value) + len(value.rstrip(".-/~+"))
            if end - start >= 16:
                yield start, end


def _assigned(text: str) -> Iterator[tuple[int, int]]:
    """Values assigned to a name with a ``FOR`` word.

    Of assignments inside an unquoted value ('auth=token=...') the value of the last counts too.
    """
    inner, until = None, -1
    for m in _ASSIGN.finditer(text):
        near = text[max(0, m.start() - 60) : m.start()]
        name = _NAME.search(near.rstrip(" \t\"'])"))
        if not name or not any(w.lower() in FOR for w in _NAME_WORD.findall(name.group())):
            continue
        if m.end() < until:
            inner = (m.end(), until) if until - m.end() >= 4 else inner
            continue
        if inner:
            yield inner
        inner, value = None, _VALUE.match(text, m.end())
        if value:
            yield value.span(value.lastindex)
            until = value.end() if value.lastindex == 3 else until
    if inner:
        yield inner


def find(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all candidates of a text, each place once."""
    text = text or ""
    kinds = {(start, end): "generic" for places in (_runs(text), _assigned(text)) for start, end in places}
    kinds.update({(start, end): kind for start, end, kind in _signed(text)})
    return [(start, end, kind) for (start, end), kind in sorted(kinds.items())]


def candidates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, start, length, kind, features``: every candidate; positions in characters from 0."""
    where = F.col(f"`{path}`").cast("string") if path else F.lit(None).cast("string")
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), where.alias("path")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, sizes, kinds, views = [], [], [], [], []
            for doc_id, value, path in zip(*(c.to_pylist() for c in batch.columns)):
                for start, end, kind in find(value):
                    ids.append(doc_id), starts.append(start), sizes.append(end - start), kinds.append(kind)
                    views.append(describe(value, start, end, kind != "generic", path))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(kinds, pa.string()), pa.array(views, pa.list_(pa.float64()))],
                names=["doc_id", "start", "length", "kind", "features"],
            )

    return map_arrow(rows, run, "doc_id long, start long, length long, kind string, features array<double>")


def _random_text(rng: random.Random, alphabet: str, low: int, high: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))


def planted(rng: random.Random, words: list[str]) -> tuple[str, str, str, int]:
    """(before, value, after, label): a key (1) or a harmless look-alike (0) with its surroundings."""
    hexes, letters = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
    mixed = letters + letters.upper() + "0123456789"
    word = lambda: rng.choice(words) if words else "word"
    draw = rng.random()
    if draw < 0.08:  # a key inside a path or a dotted name
        value = rng.choice([
            lambda: "AKIA" + _random_text(rng, mixed[26:], 16, 16), lambda: "ghp_" + _random_text(rng, mixed, 36, 36),
            lambda: "sk_live_" + _random_text(rng, mixed, 24, 24), lambda: _random_text(rng, mixed, 24, 44),
        ])()
        place = rng.choice([f"https://{word()}.com/{word()}/", f"{word()}/{word()}/", f"{word()}.{word()}.", f"see refs/{word()}/"])
        return f"{word()} {place}", value, rng.choice([" ", "/" + word() + " ", "\n"]) + word(), 1
    if draw < 0.2:  # a short secret or a harmless short value, each assigned
        name = rng.choice(["password", "passwd", "pwd", "DB_PASSWORD", "secret", "clientSecret", "api_key", "login", "auth", "access_token"])
        joint, after = rng.choice([(' = "', '" '), ("=", " "), (": ", "\n"), (": '", "' "), ('": "', '", "')])
        if draw < 0.14:
            value = rng.choice([
                lambda: word().lower() + str(rng.randint(1, 9999)) + _random_text(rng, letters, 0, 4),
                lambda: _random_text(rng, mixed, 6, 15), lambda: _random_text(rng, mixed + "!#$%*?@", 8, 15),
                lambda: word().capitalize() + rng.choice("!@#$") + str(rng.randint(1, 9999)),
            ])()
            return f"{word()} {name}{joint}", value.rjust(6, "x"), after + word(), 1
        value = rng.choice([
            lambda: word().lower(), lambda: f"{word()}_{word()}".lower(), lambda: f"get_{word().lower()}()", lambda: "*" * rng.randint(6, 12),
            lambda: rng.choice(["None", "null", "true", "false", "required", "optional", "string", "${PASSWORD}", "<redacted>", "changeme"]),
            lambda: str(rng.randint(1000, 2100)),
        ])()
        return f"{word()} {name}{joint}", value, after + word(), 0
    if draw < 0.6:
        value = rng.choice([
            lambda: _random_text(rng, hexes, 32, 64), lambda: _random_text(rng, mixed, 20, 48),
            lambda: _random_text(rng, mixed + "+/", 27, 60) + "=", lambda: "AKIA" + _random_text(rng, mixed[26:], 16, 16),
            lambda: "ghp_" + _random_text(rng, mixed, 36, 36), lambda: "sk_live_" + _random_text(rng, mixed, 24, 24),
            lambda: _random_text(rng, hexes.upper(), 32, 40), lambda: _random_text(rng, mixed + "_-", 20, 40),
        ])()
        name = rng.choice(["token", "api_key", "secret", "password", "auth_token", "client_secret", "access key", "TOKEN", "Bearer"])
        joint = rng.choice([' = "', "=", ": ", ' = "', ": '", " "])
        return f"{word()} {name}{joint}", value, rng.choice(['" ', " ", "\n", "' "]) + word(), 1
    value, name = rng.choice([
        lambda: (_random_text(rng, hexes, 40, 40), rng.choice(["commit ", "revision ", "sha1: "])),
        lambda: (_random_text(rng, hexes, 64, 64), rng.choice(["sha256:", "checksum = ", "digest "])),
        lambda: (str(uuid.UUID(int=rng.getrandbits(128))), rng.choice(["uuid ", "id=", "request "])),
        lambda: (f"{word()}.{word()}{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com", rng.choice(["", "mail "])),
        lambda: (f"{word()}{word()}{rng.randint(0, 99)}".ljust(16, "a"), rng.choice(["", "see "])),
        lambda: (f"{word()}_{word()}_{word()}_v{rng.randint(1, 9)}".ljust(16, "_"), rng.choice(["", "file "])),
        lambda: (f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}.00.00Z", "at "),
        lambda: ("data/" + "/".join(word() for _ in range(3)) + f"{rng.randint(1, 9)}.png", rng.choice(["image ", ""])),
        lambda: (base64.b64encode(" ".join(word() for _ in range(4)).encode()).decode(), rng.choice(["image ", "build "])),
        lambda: ("-".join(word() for _ in range(3)) + f"-{rng.randint(1, 999)}".ljust(8, "0"), rng.choice(["order ", ""])),
    ])()
    return f"{word()} {name}", value, " " + word(), 0


#: Paths of planted findings by label: look-alikes stand in tests and documentation more often than keys do.
PATHS = (
    (None, None, "src/app.py", "tests/fixture.json", "docs/example.md", "tests/test_app.py"),
    (None, None, "src/app.py", "config/prod.env", "deploy/settings.yaml", "tests/fixture.json"),
)


def placed(rng: random.Random, text: str) -> tuple[str, int, int, int, str | None]:
    """``text`` with a planted finding at a random word border: text, start and end of the value, label, path."""
    words = re.findall(r"[A-Za-z]{2,12}", text)
    before, value, after, label = planted(rng, words)
    at = rng.randint(0, len(text))
    while 0 < at < len(text) and not text[at].isspace():
        at += 1
    ahead, behind = text[:at] + " " if at else "", " " + text[at:]
    start = len(ahead) + len(before)
    return ahead + before + value + after + behind, start, start + len(value), label, rng.choice(PATHS[label])


def planted_findings(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS, seed: str = "findings") -> DataFrame:
    """``features, label`` of findings planted in at most about ``rows`` documents, picked by a hash.

    Each of three findings a document is written at a random place of its whole text and described
    there.  Candidates that touch the planted value count; those of the text itself have no label.
    """
    total = docs.count()
    body = docs.select(F.col(f"`{id_column}`").cast("string").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    body = body.where(sampled(F.xxhash64("id", F.lit(seed)), rows, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views, labels = [], []
            for key, value in zip(*(c.to_pylist() for c in batch.columns)):
                rng = random.Random(hashlib.sha256(f"{seed}/{key}".encode()).digest())
                for _ in range(3):
                    whole, first, last, label, path = placed(rng, value)
                    for start, end, kind in find(whole):
                        if start < last and first < end:
                            views.append(describe(whole, start, end, kind != "generic", path))
                            labels.append(float(label and first <= start))
            yield pa.RecordBatch.from_arrays(
                [pa.array(views, pa.list_(pa.float64())), pa.array(labels, pa.float64())], names=["features", "label"]
            )

    return map_arrow(body, run, "features array<double>, label double")


def train(findings: DataFrame, trees: int = 24, depth: int = 8, seed: int = 11) -> RandomForestClassificationModel | None:
    """The forest of labelled findings (``features, label``); None if they lack a class."""
    ready = findings.select(array_to_vector("features").alias("features"), "label").coalesce(4).cache()
    try:
        if ready.select("label").distinct().count() < 2:
            return None
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=48, seed=seed, featureSubsetStrategy="sqrt")
        return forest.fit(ready)
    finally:
        ready.unpersist()


def scan(
    docs: DataFrame,
    forest: RandomForestClassificationModel | None,
    id_column: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """``doc_id, start, length, kind, score, secret`` of every candidate of every whole text.

    A null or empty text has none; repeated rows give theirs each time.  Without a forest the
    score is 1 for signatures and 0.5 for the rest, so nothing is taken for a false finding.
    """
    found = candidates(docs, id_column, text, path)
    if forest is None:
        score = F.when(F.col("kind") == "generic", 0.5).otherwise(1.0)
        scored = found.withColumn("score", score)
    else:
        ready = found.withColumn("_vector", array_to_vector("features"))
        forest = forest.copy().setFeaturesCol("_vector").setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
        scored = forest.transform(ready).withColumn("score", vector_to_array("_p")[1])
    return scored.select("doc_id", "start", "length", "kind", "score", (F.col("score") >= threshold).alias("secret"))


def trained_on(docs: DataFrame, **options) -> RandomForestClassificationModel | None:
    """A forest trained from findings planted in ``docs``."""
    return train(written(planted_findings(docs, **options), "secret-findings"))
