"""License scans: ordered signature rules, gated by keywords, with overlaps resolved.

A rule is a regular expression over the lower-cased text with a label, a priority and a
confidence.  The rules are the product of license families (a name in words and a label, some
with versions) and phrase forms.  A rule runs only on texts that hold the literals its pattern
cannot match without; they are derived from the pattern, so the gate never costs a detection.
Detections are taken by falling priority, then length; one that lies inside another that was
taken is dropped, so "gnu lesser general public license" is not also a general public license.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

try:
    from re import _constants as _op
    from re import _parser
except ImportError:  # Python 3.10
    import sre_constants as _op
    import sre_parse as _parser

from tideline.llm.common import map_arrow, utf8_column
from tideline.llm.text import word_spans

# Bytes of words once A-Z is lower-cased: digits, a-z and all of non-ASCII text.
INSIDE = np.zeros(256, bool)
INSIDE[0x30:0x3A] = INSIDE[0x61:0x7B] = INSIDE[0x80:] = True
LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 256))

#: Fixed phrases of the base detector and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

_GAP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_WORD_BEFORE = rb"(?<![0-9a-z\x80-\xff])"
_WORD_AFTER = rb"(?![0-9a-z\x80-\xff])"
# Between the words of a name: spaces, hyphens, line ends and comment marks.
_S = r"[\s\-_#*/;:.,()\"']+"
_THE = rf"(?:the{_S})?"

# label, name as a regular expression with " " for a gap, and versions the label may carry.
FAMILIES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("agpl", r"(?:gnu )?(?:affero general public license|agpl)", ("3",)),
    ("lgpl", r"(?:gnu )?(?:(?:lesser|library) general public license|lgpl)", ("2", "2.1", "3")),
    ("gpl", r"(?:gnu )?(?:general public license|gpl)", ("2", "3")),
    ("gfdl", r"(?:gnu )?(?:free documentation license|gfdl)", ("1.1", "1.2", "1.3")),
    ("apache", r"apache(?: software)?", ("1.1", "2")),
    ("mit", r"(?:mit|expat)", ()),
    ("bsd-2-clause", r"(?:bsd 2 clause|(?:2|two) clause bsd|simplified bsd|freebsd)", ()),
    ("bsd-3-clause", r"(?:bsd 3 clause|(?:3|three) clause bsd|new bsd|revised bsd|modified bsd)", ()),
    ("bsd-4-clause", r"(?:bsd 4 clause|(?:4|four) clause bsd|original bsd)", ()),
    ("bsd", r"bsd", ()),
    ("mpl", r"(?:mozilla public|mpl)", ("1.1", "2")),
    ("epl", r"(?:eclipse public|epl)", ("1", "2")),
    ("cddl", r"(?:common development and distribution|cddl)", ("1", "1.1")),
    ("eupl", r"(?:european union public|eupl)", ("1.1", "1.2")),
    ("ms-pl", r"(?:microsoft public|ms pl)", ()),
    ("ms-rl", r"(?:microsoft reciprocal|ms rl)", ()),
    ("isc", r"isc", ()),
    ("zlib", r"zlib(?: libpng)?", ()),
    ("bsl", r"(?:boost software|bsl)", ("1",)),
    ("artistic", r"(?:perl )?artistic", ("1", "2")),
    ("wtfpl", r"(?:do what the fuck you want to public|wtfpl)", ("2",)),
    ("unlicense", r"unlicen[sc]e", ()),
    ("ofl", r"(?:sil open font|open font|ofl)", ("1.1",)),
    ("python", r"(?:python software foundation|psf)", ("2",)),
    ("php", r"php", ("3",)),
    ("ruby", r"ruby", ()),
    ("odbl", r"(?:open database|odbl)", ("1",)),
    ("odc-by", r"(?:open data commons attribution|odc by)", ("1",)),
    ("pddl", r"(?:public domain dedication and|pddl)", ("1",)),
    ("cecill", r"cecill", ("2.1",)),
    ("cpl", r"common public", ("1",)),
    ("osl", r"(?:open software|osl)", ("3",)),
    ("afl", r"(?:academic free|afl)", ("3",)),
    ("qpl", r"(?:q public|qpl)", ("1",)),
    ("vim", r"vim", ()),
    ("postgresql", r"postgresql", ()),
    ("openssl", r"openssl", ()),
    ("x11", r"x11", ()),
    ("upl", r"(?:universal permissive|upl)", ("1",)),
    ("ncsa", r"(?:university of illinois(?: ncsa)?(?: open source)?|ncsa)", ()),
    ("mulan", r"mulan(?: permissive software)?", ("1", "2")),
    ("openrail", r"open ?rail(?: m)?", ()),
    ("llama", r"llama(?: \d)?(?: community)?", ()),
    ("elastic", r"elastic", ("2",)),
    ("sspl", r"(?:server side public|sspl)", ("1",)),
    ("busl", r"(?:business source|busl)", ("1.1",)),
    ("cc-by-nc-nd", r"(?:cc by nc nd|(?:creative commons )?attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?)", ("2", "3", "4")),
    ("cc-by-nc-sa", r"(?:cc by nc sa|(?:creative commons )?attribution non ?commercial share ?alike)", ("2", "3", "4")),
    ("cc-by-nc", r"(?:cc by nc|(?:creative commons )?attribution non ?commercial)", ("2", "3", "4")),
    ("cc-by-nd", r"(?:cc by nd|(?:creative commons )?attribution no ?deriv(?:ative)?s?(?: works)?)", ("2", "3", "4")),
    ("cc-by-sa", r"(?:cc by sa|(?:creative commons )?attribution share ?alike)", ("2", "3", "4")),
    ("cc-by", r"(?:cc by|creative commons attribution)", ("2", "3", "4")),
    ("cc0", r"(?:cc0|cc zero|creative commons zero)", ("1",)),
)

# name of a phrase form, its pattern around the license's name N, priority, confidence.
FORMS: tuple[tuple[str, str, int, float], ...] = (
    ("spdx", "spdx license identifier N", 60, 0.99),
    ("grant", "(?:licensed|released|distributed|published|available|made available|provided|redistribute (?:it|them|this)) under THE(?:terms (?:and conditions )?of THE)?N", 50, 0.95),
    ("subject", "(?:subject to|governed by|covered by|accordance with|compliance with) THE(?:terms (?:and conditions )?of THE)?N", 45, 0.9),
    ("field", "licen[sc]ed?(?: type| name| id)? ?[:=] ?[\"']? ?THEN", 40, 0.9),
    ("titled", "THEN", 30, 0.7),
)
# Signatures that name no license of a family: label, pattern, priority, confidence.
NOTICES: tuple[tuple[str, str, int, float], ...] = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 55, 0.95),
    ("isc", "permission to use copy modify and(?: or)? distribute this software for any purpose", 55, 0.9),
    ("bsd", "redistribution and use in source and binary forms with or without modification", 35, 0.85),
    ("unlicense", "this is free and unencumbered software released into the public domain", 55, 0.95),
    ("public-domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain", 30, 0.8),
    ("all-rights-reserved", "all rights reserved", 20, 0.6),
    ("proprietary", "(?:proprietary and confidential|confidential and proprietary)", 20, 0.6),
)


# Addresses of license texts, "/" and "." being gaps like all others: label, pattern, versions.
ADDRESSES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("cc-by-nc-nd", "creativecommons org licen[sc]es by nc nd", ("2", "3", "4")),
    ("cc-by-nc-sa", "creativecommons org licen[sc]es by nc sa", ("2", "3", "4")),
    ("cc-by-nc", "creativecommons org licen[sc]es by nc", ("2", "3", "4")),
    ("cc-by-nd", "creativecommons org licen[sc]es by nd", ("2", "3", "4")),
    ("cc-by-sa", "creativecommons org licen[sc]es by sa", ("2", "3", "4")),
    ("cc-by", "creativecommons org licen[sc]es by", ("2", "3", "4")),
    ("cc0", "creativecommons org publicdomain zero", ("1",)),
    ("apache", "apache org licen[sc]es licen[sc]e", ("1.1", "2")),
    ("mit", "(?:opensource org licen[sc]es?|spdx org licen[sc]es|choosealicense com licen[sc]es) mit", ()),
    ("apache", "(?:opensource org licen[sc]es?|spdx org licen[sc]es|choosealicense com licen[sc]es) apache", ("1.1", "2")),
    ("bsd-2-clause", "(?:opensource org licen[sc]es?|spdx org licen[sc]es|choosealicense com licen[sc]es) bsd 2 clause", ()),
    ("bsd-3-clause", "(?:opensource org licen[sc]es?|spdx org licen[sc]es|choosealicense com licen[sc]es) bsd 3 clause", ()),
    ("isc", "(?:opensource org licen[sc]es?|spdx org licen[sc]es|choosealicense com licen[sc]es) isc", ()),
    ("gpl", "(?:gnu org licen[sc]es(?: old licen[sc]es)?|opensource org licen[sc]es?|spdx org licen[sc]es|choosealicense com licen[sc]es) gpl", ("2", "3")),
    ("lgpl", "(?:gnu org licen[sc]es(?: old licen[sc]es)?|opensource org licen[sc]es?|spdx org licen[sc]es|choosealicense com licen[sc]es) lgpl", ("2", "2.1", "3")),
    ("agpl", "(?:gnu org licen[sc]es|opensource org licen[sc]es?|spdx org licen[sc]es|choosealicense com licen[sc]es) agpl", ("3",)),
    ("gfdl", "gnu org licen[sc]es fdl", ("1.1", "1.2", "1.3")),
    ("mpl", "mozilla org(?: en us)? mpl", ("1.1", "2")),
    ("epl", "eclipse org(?: org)? legal epl v?", ("1", "2")),
    ("bsl", "boost org licen[sc]e", ("1",)),
    ("ofl", "(?:scripts sil org ofl|openfontlicen[sc]e org)", ()),
    ("unlicense", "unlicen[sc]e org", ()),
    ("wtfpl", "wtfpl net", ()),
    ("odbl", "opendatacommons org licen[sc]es odbl", ("1",)),
    ("odc-by", "opendatacommons org licen[sc]es by", ("1",)),
    ("pddl", "opendatacommons org licen[sc]es pddl", ("1",)),
)
# What introduces several licenses at once; those that follow are told apart by their joints.
LISTS = (
    re.compile(rb"spdx[\s\-]+licen[sc]e[\s\-]+identifier[\s:=]+([0-9a-z.+\- \t()/]+)"),
    re.compile(rb"(?:dual|multi|triple)[\s\-]*licen[sc](?:ed|ing)[\s:,]+(?:under|with|as|by)?([0-9a-z.+\-\s()/,\"']{1,200})"),
)
_JOINT = re.compile(rb"(?<![0-9a-z])(?:or|and|with)(?![0-9a-z])|[()/,\"']")
#: A list counts as surely as an identifier does.
_LISTED = (61, 0.97)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    gate: tuple[tuple[tuple[bytes, ...], ...], ...]
    priority: int
    confidence: float


def _compiled(pattern: str) -> re.Pattern:
    """``pattern`` over bytes, with gaps for spaces, at word borders."""
    pattern = pattern.replace("THE", "(?:the )?").replace(" ?", "\0").replace(" )?", "\1").replace(" ", _S)
    pattern = pattern.replace("\0", r"[\s\-_]*").replace("\1", _S + ")?")
    return re.compile(_WORD_BEFORE + pattern.encode() + _WORD_AFTER)


# Ways to hold a clause: the text has all literals of at least one of them.
Clause = tuple[tuple[bytes, ...], ...]


def _clauses(parsed, before: bytes = b"") -> list[Clause]:
    """What every match of a parsed pattern, with the literal ``before`` it, holds: all the clauses."""
    out: list[Clause] = []
    run = bytearray(before)

    def close() -> None:
        if len(run) > 1:
            out.append(((bytes(run),),))
        run.clear()

    for op, value in parsed:
        if op is _op.LITERAL:
            run.append(value)
        elif op is _op.BRANCH:
            ways: list[tuple[bytes, ...]] = []
            for each in (_clauses(a, bytes(run)) for a in value[1]):
                sure = tuple(literal for clause in each if len(clause) == 1 for literal in clause[0])
                ways.extend([sure] if sure else each[0] if each else [()])
            close()
            if all(ways):  # an alternative without a literal asks for nothing
                out.append(tuple(sorted(set(ways))))
        else:
            close()
            if op is _op.SUBPATTERN:
                out.extend(_clauses(value[-1]))
            elif op in (_op.MAX_REPEAT, _op.MIN_REPEAT) and value[0] > 0:
                out.extend(_clauses(value[2]))
    close()
    return out


def _rule(label: str, pattern: str, priority: int, confidence: float) -> Rule:
    compiled = _compiled(pattern)
    gate = tuple(dict.fromkeys(_clauses(_parser.parse(compiled.pattern))))
    return Rule(label, compiled, gate, priority, confidence)


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules: every family in every form, plain and with each version, then the notices."""
    made = []
    for label, name, versions in FAMILIES:
        plain = name + r"(?: (?:public )?licen[sc]e)?"
        for form, pattern, priority, confidence in FORMS:
            # A bare name counts as a license only when it is called one.
            needs = name + r" (?:public )?licen[sc]e" if form == "titled" and "licen" not in name else plain
            if form == "titled" and label.startswith("cc"):
                needs = plain
            made.append(_rule(label, pattern.replace("N", needs), priority, confidence))
            for version in versions:
                number = re.escape(version).replace(r"\.", r"\.") + (r"(?:\.0)?" if "." not in version else "")
                numbered = needs + rf"(?: (?:international|version|v))?[\s,\-v]*{number}(?:\+| or later)?"
                tagged = f"{label}-{version}"
                made.append(_rule(tagged, pattern.replace("N", numbered), priority + 5, min(0.99, confidence + 0.04)))
    for label, pattern, versions in ADDRESSES:
        made.append(_rule(label, pattern, 52, 0.95))
        for version in versions:
            made.append(_rule(f"{label}-{version}", f"{pattern} {_number(version)}", 57, 0.98))
    for label, pattern, priority, confidence in NOTICES:
        made.append(_rule(label, pattern, priority, confidence))
    return tuple(made)


def _number(version: str) -> str:
    return re.escape(version).replace(r"\.", r"[._\-]") + (r"(?:[._\-]0)?" if "." not in version else "")


@lru_cache(maxsize=1)
def _names() -> tuple[tuple[re.Pattern, str], ...]:
    """A pattern for each license as it stands in a list, those with a version first."""
    made = []
    for label, name, versions in FAMILIES:
        for version in versions:
            ending = rf"(?: (?:public )?licen[sc]e)?(?: (?:version|v))?[\s,\-v]*{_number(version)}(?:\+| only| or later)?(?: licen[sc]e)?"
            made.append((_compiled(name + ending), f"{label}-{version}"))
        made.append((_compiled(name + r"(?: (?:public )?licen[sc]e)?"), label))
    return tuple(made)


def listed(low: bytes) -> list[tuple[int, int, int, int, str, float]]:
    """Detections of the single licenses of SPDX expressions and of dual licenses."""
    found = []
    if b"spdx" not in low and b"licens" not in low and b"licenc" not in low:
        return found
    for introduction in LISTS:
        for m in introduction.finditer(low):
            at = m.start(1)
            for joint in [*_JOINT.finditer(low, m.start(1), m.end(1)), None]:
                end = joint.start() if joint else m.end(1)
                part = low[at:end]
                lead = len(part) - len(part.lstrip())
                lead += 4 if part[lead : lead + 4] == b"the " else 0
                own = part[lead:].split(b". ")[0].rstrip(b" \t\r\n.")
                label = next((label for name, label in _names() if name.fullmatch(own)), None) if own else None
                if label:
                    found.append((_LISTED[0], len(own), at + lead, at + lead + len(own), label, _LISTED[1]))
                at = joint.end() if joint else end
    return found


@lru_cache(maxsize=1)
def _base_patterns() -> tuple[tuple[re.Pattern, str, bytes], ...]:
    return tuple(
        (
            re.compile(_WORD_BEFORE + _GAP.join(w.encode() for w in phrase.split()) + _WORD_AFTER),
            label,
            max((w.encode() for w in phrase.split()), key=len) if label != "cc-by-nc" else b"nc",
        )
        for phrase, label in BASE
    )


class _Gate:
    """Rules behind a clause of literals, and the gates behind that."""

    def __init__(self) -> None:
        self.rules: list[Rule] = []
        self.inner: dict[Clause, _Gate] = {}


@lru_cache(maxsize=1)
def _gates() -> _Gate:
    """The rules as a tree of their clauses, those of most rules first, so each is asked rarely."""
    shared = Counter(clause for rule in rules() for clause in rule.gate)
    root = _Gate()
    for rule in rules():
        at = root
        for clause in sorted(rule.gate, key=lambda c: (-shared[c], c)):
            at = at.inner.setdefault(clause, _Gate())
        at.rules.append(rule)
    return root


def admitted(low: bytes) -> list[Rule]:
    """The rules whose literals a lower-cased text holds; no other rule can match in it."""
    known: dict[Clause, bool] = {}
    out, open_ = [], [_gates()]
    while open_:
        gate = open_.pop()
        out.extend(gate.rules)
        for clause, inner in gate.inner.items():
            if clause not in known:
                known[clause] = any(all(literal in low for literal in way) for way in clause)
            if known[clause]:
                open_.append(inner)
    return out


def base_places(low: bytes) -> list[tuple[int, str]]:
    """(byte position, label) of every base phrase in a lower-cased text."""
    found = []
    for pattern, label, keyword in _base_patterns():
        if keyword in low:
            found.extend((m.start(), label) for m in pattern.finditer(low))
    return found


def detections(low: bytes, gated: bool = True) -> list[tuple[int, int, str, float]]:
    """(start, end, label, confidence) of what remains after overlaps are resolved."""
    found = []
    for rule in admitted(low) if gated else rules():
        for m in rule.pattern.finditer(low):
            found.append((rule.priority, m.end() - m.start(), m.start(), m.end(), rule.label, rule.confidence))
    found.extend(listed(low))
    found.sort(key=lambda d: (-d[0], -d[1], d[2], d[4]))
    kept: list[tuple[int, int, str, float]] = []
    # The kept spans that lie in no other, by start and so by end: the last that begins at or
    # before a place reaches furthest of all that do.
    starts, ends = [], []
    for _, _, start, end, label, confidence in found:
        at = bisect_right(starts, start)
        if at and ends[at - 1] >= end:
            continue
        kept.append((start, end, label, confidence))
        first = bisect_left(starts, start)
        after = bisect_right(ends, end)
        starts[first:after], ends[first:after] = [start], [end]
    return sorted(kept)


_SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<start:int,end:int,label:string,confidence:double>>"
)
_SPANS = pa.list_(
    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("confidence", pa.float64())])
)


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """License findings of every whole text: the ``keep`` columns and

    ``n_words, n_base, first_word, last_word, base_labels, labels, score`` and ``spans``, the
    byte ranges (in UTF-8) of the method's detections.  A null or empty text has no words, no
    places, null first and last words, empty label lists and score 0.  A ``keep`` column called like one of
    these results is left out.  The score is the chance
    that at least one finding is right if each is so with its confidence; a base place has 0.9.
    """
    results = {name.split()[0] for name in _SCHEMA.split(", ")}
    keep = tuple(c for c in keep if c.lower() not in results)
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_scanned"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + [_SCHEMA])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_column(batch.column(batch.num_columns - 1))
            rows = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                low = data[a:b].tobytes().translate(LOWER)
                rows.append(_scan_one(low))
            names = ["n_words", "n_base", "first_word", "last_word"]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
            columns += [pa.array([r[i] for r in rows], pa.string()) for i in (4, 5)]
            columns += [pa.array([r[6] for r in rows], pa.float64()), pa.array([r[7] for r in rows], _SPANS)]
            names += ["base_labels", "labels", "score", "spans"]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *names]
            )

    return map_arrow(kept, run, schema)


def _scan_one(low: bytes) -> tuple:
    raw = np.frombuffer(low, np.uint8)
    member = INSIDE[raw]
    heads = member.copy()
    heads[1:] &= ~member[:-1]
    places = base_places(low)
    kept = detections(low)
    base = sorted({label for _, label in places})
    first = last = None
    if places:
        before = np.cumsum(heads)  # words that begin up to each byte
        first, last = (int(before[p]) - int(heads[p]) for p in (min(places)[0], max(places)[0]))
    wrong = 1.0
    for _, _, _, confidence in kept:
        wrong *= 1.0 - confidence
    if places:
        wrong *= 0.1
    labels = sorted({*base, *(d[2] for d in kept)})
    spans = [{"start": a, "end": b, "label": c, "confidence": d} for a, b, c, d in kept]
    return int(np.count_nonzero(heads)), len(places), first, last, ",".join(base), ",".join(labels), 1.0 - wrong, spans
