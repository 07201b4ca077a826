import random

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import pairs
from tokenizers import Tokenizer

from loanscope.llm import counting, queries
from loanscope.llm.queries import TOKENIZER
from loanscope.llm.tokens import Encoder
from loanscope.llm.workspace import shared_folder


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def test_fast_road_gives_the_ids_of_the_library(library):
    draw = random.Random(1)
    letters = [chr(i) for i in range(0x250)] + ["<|endoftext|>", "'s", "'ll", "  ", "\n"] * 20 + list("abc123 .,_") * 20
    letters += ["あ", "\U0001f600", "́", " ", "…", "—"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(5000)]
    texts += [f"a{chr(c)}b {chr(c)} 1{chr(c)}\n{chr(c)}" for c in range(0x250)] + ["", " ", "a" * 5000]
    found = Encoder.load(TOKENIZER).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_other_tokenizers_go_to_their_libraries():
    import public_tokenizers
    import sentencepiece

    text = "Some <|endoftext|> text, and Ünïcode"
    path = public_tokenizers.path("word_bpe_49k.json")
    (ids,) = Encoder.load(path).encode([text])
    assert ids.tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    path = public_tokenizers.path("piece_bpe_32k.model")
    (ids,) = Encoder.load(path).encode([text])
    assert ids.tolist() == sentencepiece.SentencePieceProcessor(model_file=path).encode(text)


def test_counts_of_edge_cases(edge_docs, no_docs, library):
    found = counting.count_tokens(edge_docs, TOKENIZER, limit=100).collect()
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    expected = [(d, len((t or "").encode()), count(t), count(t) > 100) for d, t in pairs(edge_docs)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert counting.count_tokens(no_docs, TOKENIZER).collect() == []


def test_cache_grows_by_distinct_misses_only(spark, tmp_path):
    cache = str(tmp_path / "cache")
    first = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "doc_id long, text string")
    counting.count_tokens(first, TOKENIZER, cache)
    assert spark.read.parquet(cache).count() == 2
    # A count in the cache is believed, so a changed one shows that it was read.
    changed = spark.read.parquet(cache).withColumn("n_tokens", F.col("n_tokens") + 100).collect()
    schema = counting.CACHE_SCHEMA
    other = str(tmp_path / "other")
    spark.createDataFrame(changed, spark.read.parquet(cache).schema).select(
        *[c.split(" ")[0] for c in schema.split(", ")]
    ).write.parquet(other)
    second = first.union(spark.createDataFrame([(4, "d e")], first.schema))
    found = {r.doc_id: r.n_tokens for r in counting.count_tokens(second, TOKENIZER, other).collect()}
    assert found[1] == found[2] > 100 and found[4] < 10
    assert spark.read.parquet(other).count() == 3


def test_query_encodes_nothing_a_second_time(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    first = queries.op1_token_counts(spark, sf).collect()
    cache = f"{shared_folder(spark)}/token-counts"
    held = spark.read.parquet(cache).count()
    # Without the tokenizer's file nothing could be encoded.
    version = counting.version_digest(TOKENIZER)
    monkeypatch.setattr(counting, "version_digest", lambda path: version)
    monkeypatch.setattr(queries, "TOKENIZER", "/nowhere.json")
    assert sorted(queries.op1_token_counts(spark, sf).collect()) == sorted(first)
    assert spark.read.parquet(cache).count() == held
    monkeypatch.setattr(counting, "version_digest", lambda path: "another")
    with pytest.raises(Exception, match="nowhere"):
        queries.op1_token_counts(spark, sf)
