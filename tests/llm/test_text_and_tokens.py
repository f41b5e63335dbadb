import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tideline.llm import tokens
from tideline.llm.common import pieces, utf8_column
from tideline.llm.queries import QUERIES
from tideline.llm.text import shingle_sets, word_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokens.model_path(MODEL))


def random_texts(seed, count, alphabet="ab cd\n\té漢  ", longest=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(count)] + [None, ""]


def test_words_and_shingles_match_a_plain_version():
    texts = random_texts(1, 400)
    data, offsets = utf8_column(pa.array(texts))
    starts, ends, rows = word_spans(data, offsets)
    found = [[] for _ in texts]
    for a, b, r in zip(starts, ends, rows):
        found[r].append(data[a:b].tobytes().decode())
    assert found == [WORD.findall(t or "") for t in texts]
    sets = shingle_sets(data, offsets)
    plain = []
    for t in texts:
        w = WORD.findall(t or "")
        plain.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i in range(0, len(texts), 7):
        for j in range(i, len(texts), 11):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


def test_pieces_cover_all_rows_in_order():
    offsets = np.array([0, 0, 5, 5, 100, 101, 101])
    assert [r for a, b in pieces(offsets, 10) for r in range(a, b)] == list(range(6))


def test_pretokens_sum_up_to_the_library_count(library):
    lookup = tokens.Lookup(MODEL, "test", len)
    alphabet = "ab \n\t\x00 ▁é漢 的　​.,<s></s>  "
    texts = random_texts(2, 4000, alphabet, 16)
    for some in (texts, [t for t in texts if "▁" not in (t or "")], texts[:1], [None], [""], []):
        counts = lookup.counts(*utf8_column(pa.array(some, pa.string())))
        assert counts.tolist() == [len(library.encode(t or "")) for t in some]


def test_ids_of_pretokens_join_to_the_library_ids(library):
    lookup = tokens.Lookup(MODEL, "test-ids", lambda ids: np.array(ids, "<u2").tobytes())
    texts = random_texts(3, 500, "The cat  sat\n on é漢 0x1F!", 50)
    found = lookup.ids(*utf8_column(pa.array(texts)))
    assert [f.tolist() for f in found] == [library.encode(t or "") for t in texts]


def test_a_full_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 8)
    monkeypatch.setattr(tokens, "CACHED_LENGTH", 3)
    monkeypatch.setattr(tokens, "CHUNK", 50)
    words = [" a", " bc", "\nd"]
    hashes = tokens.hash_words(words)
    order = np.argsort(hashes)
    table = hashes[order], [len(tokens.encode_pretokens(MODEL, [w.encode() for w in words])[k]) for k in order]
    texts = random_texts(4, 300, "abcdefgh  \n", 40)
    for known in (None, table):
        lookup = tokens.Lookup(MODEL, "tiny", len, known)
        counts = lookup.counts(*utf8_column(pa.array(texts)))
        assert counts.tolist() == [len(library.encode(t or "")) for t in texts]
        assert len(lookup.cache) <= 8 + 40


def test_counts_on_odd_rows(spark, library):
    long = "word and more \n" * 40_000
    rows = [(1, "a b", 9), (1, "a b", 9), (None, None, 0), (2, "", 1), (3, long, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    out = tokens.with_token_counts(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in out) == sorted(
        (r[0] or 0, len(library.encode(r[1] or ""))) for r in rows
    )
    assert tokens.with_token_counts(docs.where("doc_id = 77")).count() == 0


def test_query_counts_whole_texts(spark, small, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op1_token_counts"](spark, small).collect():
        n = len(library.encode(texts[r["doc_id"]]))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 4096)


def test_hash_of_bytes_is_stable():
    # The scratch tables of one run may be read by the tasks of another process.
    data, offsets = utf8_column(pa.array(["a b c d e f"]))
    digest = hashlib.sha256(shingle_sets(data, offsets)[0].tobytes()).hexdigest()
    data, offsets = utf8_column(pa.array(["x", "  a b\tc d e f "]))
    assert hashlib.sha256(shingle_sets(data, offsets)[1].tobytes()).hexdigest() == digest
