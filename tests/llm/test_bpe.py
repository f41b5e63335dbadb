import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tideline.llm import bpe
from tideline.llm.queries import QUERIES
from tideline.llm.tokens import model_path

NAME = "byte_bpe_50k.json"
ATOMS = [
    "a" * 50, "'s", "'re", "'ll", "'", " ", "  ", "\n", "\n\n", "\t", " foo", "bar", " the", "123", "4567", "!!!", "?!", "...",
    "日本語", "日", "é", "ñandú", " ", "\u0085", "　", "<|endoftext|>", "<|endof", "text|>", "|", "😀", "‍", "İ", "ß",
    "-----", "aaaaa", "abab", "x" * 33, " " * 40, "0" * 30, "\r\n", "\x00", "́",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(model_path(NAME))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def mixtures(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        if rng.random() < 0.3:  # few kinds, long runs
            some = rng.sample(ATOMS, rng.randint(1, 4))
            yield "".join(rng.choice(some) * rng.randint(1, 12) for _ in range(20))
        else:
            yield "".join(rng.choice(ATOMS) for _ in range(rng.randint(0, 60)))


def test_every_token_is_the_encoding_of_its_own_bytes(library):
    letters = {b: c for c, b in bpe.byte_letters().items()}
    table = bpe.codec(NAME).table
    for i, token in enumerate(table[:-1]):
        assert [t.id for t in library.model.tokenize("".join(letters[b] for b in token))] == [i]
    assert table[-1] == b"<|endoftext|>"


def test_both_libraries_agree_where_both_are_used(library):
    rng = random.Random(1)
    low = "".join(map(chr, range(0x250))) + "".join(chr(rng.randrange(0x250)) for _ in range(100_000))
    codec = bpe.codec(NAME)
    assert codec.fast.encode(low, allowed_special="all") == ids_of(library, low)


@pytest.mark.parametrize("leaf", [2, 7, 20, 64])
def test_halves_join_to_the_library_ids(library, leaf):
    codec = bpe.codec(NAME)
    for text in mixtures(leaf, 300):
        assert codec.encode(text, leaf).tolist() == ids_of(library, text), text


@pytest.mark.parametrize("unit", ["a", " ", "日", "ab", "1", "'s", "=", "\n ", "<|endoftext|>"])
def test_text_that_is_never_split(library, unit):
    text = "x" + unit * (30_001 // len(unit))
    assert bpe.codec(NAME).encode(text, 500).tolist() == ids_of(library, text)


def test_cuts_are_halves():
    assert bpe.halves(10, 10) == [(0, 10)]
    assert bpe.halves(11, 10) == [(0, 5), (5, 11)]
    assert bpe.halves(0, 10) == [(0, 0)]
    assert len(bpe.halves(1000, 10)) == 128


def test_decoding_any_ids_as_the_library_does(library):
    rng = random.Random(3)
    rows = [[rng.randrange(50_257) for _ in range(rng.randint(0, 9))] for _ in range(500)] + [[50_256], [], [127, 128]]
    offsets = np.cumsum([0, *map(len, rows)])
    found = bpe.codec(NAME).decode(np.array([i for r in rows for i in r]), offsets).to_pylist()
    assert found == [library.decode(r, skip_special_tokens=False) for r in rows]


def test_rows_in_spark(spark, library):
    texts = [None, "", " ", "short", "short", *mixtures(9, 60), "long " * 700, "a" * 3000, "漢" * 2500, "long " * 700]
    rows = [(k, t, k, k, "own", k) for k, t in enumerate(texts)] + [(None, "short", 1, 1, "own", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long, node long, ids string, found int").repartition(5)
    # Pieces of 40 characters: texts of 3000 meet over several levels.
    encoded = bpe.with_ids(docs, NAME, spread=40)
    assert sorted(encoded.columns) == sorted(docs.columns)
    back = bpe.with_text(encoded, NAME).collect()
    assert len(back) == len(rows)
    for r in back:
        assert r["ids"] == ids_of(library, r["text"])
        assert r["decoded"] == (r["text"] or "")
        assert r["doc_id"] is None or (r["text"], r["row"], r["found"]) == (texts[r["doc_id"]], r["doc_id"], r["doc_id"])


def test_other_names_and_no_rows(spark, library):
    docs = spark.createDataFrame([("x", "a b")], "key string, `my.text` string")
    row = bpe.with_ids(docs, NAME, text="my.text", ids="tokens").first()
    assert row["tokens"] == ids_of(library, "a b")
    none = bpe.with_text(bpe.with_ids(docs.limit(0), NAME, text="my.text"), NAME)
    assert none.columns == ["key", "my.text", "ids", "decoded"] and none.count() == 0
    assert bpe.with_text(spark.createDataFrame([(None,)], "ids array<int>"), NAME).first()["decoded"] == ""


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        bpe.Codec("word_bpe_49k.json")


def test_the_query_against_the_library(spark, small, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op11_bpe_round_trip"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(library, texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
