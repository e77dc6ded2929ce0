import hashlib
import random

import public_tokenizers
import pytest
from llm_rows import *  # noqa: F403
from tokenizers import Tokenizer

from gateflow.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_words_equal_the_library(library):
    own = bpe.WordBPE(PATH)
    r = random.Random(5)
    texts = ["", " ", "don't we'll 's 'S", "<|startoftext|>Hi <|endoftext|>x", "<|STARTOFTEXT|> y <|endoftext|",
             "aaaaaaaaaaaaaaaaaaaaaaa", "ΣΑΣ ΟΔΟΣ İ ẞ", "a\x1cb\x85c d e", "ＡＢ ½ Ⅷ ١٢", "éa ﬁ", "x" * 50_000]
    texts += ["".join(r.choice("abAB'st <>|.,!é12\n") for _ in range(r.randrange(80))) for _ in range(3000)]
    for a in range(0, len(texts), 100):
        part = texts[a:a + 100]
        ids, ends, decoded = own.encode(part)
        for k, e in enumerate(library.encode_batch(part, add_special_tokens=False)):
            assert ids[ends[k]:ends[k + 1]].tolist() == e.ids, part[k]
            assert decoded[k] == library.decode(e.ids, skip_special_tokens=False) == own.decode(e.ids)


def test_long_words(library, monkeypatch):
    own = bpe.WordBPE(PATH)
    r = random.Random(9)
    texts = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=n)) for n in (199, 200, 201, 3000, 500_000)]
    texts += ["a" * 70_001, "ab" * 5000, "thethe" * 3000 + " " + "é" * 4000, "the " * 50 + "x" * 300 + "!" * 5000]
    for t in texts:
        assert own.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids
    monkeypatch.setattr(bpe, "LONG_WORD", 0)       # all words by the rounds of long ones
    own = bpe.WordBPE(PATH)
    mixed = ["".join(r.choice("abeht st!é1 ") for _ in range(r.randrange(90))) for _ in range(500)]
    ids, ends, _ = own.encode(mixed)
    for k, e in enumerate(library.encode_batch(mixed, add_special_tokens=False)):
        assert ids[ends[k]:ends[k + 1]].tolist() == e.ids


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 5)
    own = bpe.WordBPE(PATH)
    for text in ["one two three four five six", "seven two eight nine", "one two three ten"]:
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op1_bpe(spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id] == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_odd_rows(docs, library):
    df = docs([*ODD, "twice", "twice"], [*range(len(ODD)), None, None])
    rows = bpe.encode(df, PATH).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = "twice" if r.doc_id is None else ODD[r.doc_id] or ""
        assert r.ids == library.encode(text, add_special_tokens=False).ids
    back = {r.doc_id: r.decoded for r in bpe.decode(bpe.encode(df, PATH), PATH).collect()}
    assert back == {r.doc_id: r.decoded for r in rows}
    assert bpe.digests(bpe.encode(docs([]), PATH)).count() == 0
