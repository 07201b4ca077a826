import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from loanscope.llm import bytepairs, queries
from loanscope.llm.bytepairs import BytePairs, Decoder

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def coder():
    return BytePairs.load(queries.RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.rank, special_tokens={}
    )


def expected(library, text):
    return np.array(library.encode_ordinary(text), "<u4").tobytes()


def test_same_ids_as_the_library(coder, library):
    draw = random.Random(5)
    texts = ["", "a", "a" * 3000, "ab" * 400, "<|endoftext|>", " \x1c\x85 x　\n\n y", "'ll's don't"]
    texts += ["".join(draw.choice("abcdeé ß'1२՘࢏\n\t") for _ in range(draw.randint(0, 300))) for _ in range(400)]
    texts += ["".join(draw.choice(["ing", "the", "er", "x", "ß"]) for _ in range(draw.randint(1, 700))) for _ in range(60)]
    assert list(coder.encode(texts)) == [expected(library, t) for t in texts]


def test_every_character_falls_into_the_librarys_class(coder, library):
    codes = [c for c in range(0x40000) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{chr(c)}1{chr(c)}" for c in codes)
    assert list(coder.encode([text])) == [expected(library, text)]
    assert all(unicodedata.category(chr(c)) for c in coder.splitter.stand_ins)


def test_long_texts_in_stretches(coder, library, monkeypatch):
    monkeypatch.setattr(bytepairs, "STRETCH", 50)
    monkeypatch.setattr(bytepairs, "MATCHES", 7)
    monkeypatch.setattr(bytepairs, "REMEMBERED", 20)
    monkeypatch.setattr(bytepairs, "LONG", 9)
    texts = ["many words in a row that are cut " * 9, "short", "unbroken" * 40]
    ids = list(coder.encode(texts))
    assert ids == [expected(library, t) for t in texts]
    assert [Decoder.load(queries.RANKS).decode(i).decode() for i in ids] == texts


def test_edge_rows(spark, edge_docs, no_docs, library):
    made = bytepairs.encode(edge_docs, queries.RANKS)
    rows = bytepairs.decode(made, queries.RANKS).collect()
    asked = edge_docs.select("doc_id", "text").collect()
    assert [(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in rows] == [
        (r.doc_id, expected(library, r.text or ""), (r.text or "").encode()) for r in asked
    ]
    assert bytepairs.encode(no_docs, queries.RANKS).collect() == []
    nothing = spark.sql("SELECT 1 AS doc_id, CAST(NULL AS BINARY) AS ids")
    assert bytepairs.decode(nothing, queries.RANKS).collect() == [(1, None, None)]


def test_query_over_all_documents(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = set()
    for row in docs:
        ids = expected(library, row.text or "")
        shas = [hashlib.sha256(x).hexdigest() for x in (ids, (row.text or "").encode())]
        want.add((row.doc_id, len(ids) // 4, *shas))
    found = queries.op12_byte_pairs(spark, SF).collect()
    assert len(found) == len(docs) and {tuple(r) for r in found} == want
