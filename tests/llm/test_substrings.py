import hashlib
import random
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tests.llm.conftest import pairs

from loanscope.llm import substrings
from loanscope.llm.suffixes import suffix_array


def brute(docs, length):
    first = {}
    for d, t in docs:
        body = (t or "").encode()
        for i in range(len(body) - length + 1 if d is not None else 0):
            s = body[i : i + length]
            first[s] = min(d, first.get(s, d))
    rows = []
    for d, t in docs:
        body = (t or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1 if d is not None else 0):
            if first[body[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(body, gone, strict=True) if not y)
        spans = sum(1 for i in range(len(body)) if gone[i] and (not i or not gone[i - 1]))
        rows.append((d, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=str)


def found(table, length):
    return sorted((tuple(r)[:5] for r in substrings.without_repeats(table, length).collect()), key=str)


def test_suffix_array():
    draw = random.Random(1)
    for k in range(3000):
        text = bytes(draw.choice(b"ab" if k % 2 else b"abcd\x00\xff") for _ in range(draw.randint(0, 40)))
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
    for text in (b"a" * 3000, b"ab" * 2000, bytes(range(256)) * 4, b"banana" * 300):
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_edge_cases(edge_docs, no_docs):
    assert found(edge_docs, 50) == brute(pairs(edge_docs), 50)
    assert substrings.without_repeats(no_docs).collect() == []


def test_random_texts(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 500)
    monkeypatch.setattr(substrings, "SPAN", 64)
    draw = random.Random(5)
    for length, letters in ((10, "ab"), (30, "a"), (8, "abé")):
        docs = [(draw.randint(0, 60), "".join(draw.choice(letters) for _ in range(draw.randint(0, 90)))) for _ in range(80)]
        docs += [(None, "ab" * 40), (3, None), (5, ""), (7, "ab" * 20), (7, "ab" * 20)]
        table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
        assert found(table, length) == brute(docs, length)


def test_real_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(4)
    assert found(table, 50) == brute(pairs(table), 50)


def test_removed_runs(spark):
    shared = "".join(chr(97 + i % 26) + chr(65 + i // 26) for i in range(60))
    docs = spark.createDataFrame([(1, shared), (2, "start " + shared[:70] + " middle " + shared[50:] + "!")], "doc_id long, text string")
    rows = {r.doc_id: r for r in substrings.without_repeats(docs).collect()}
    assert rows[2].removed == [6, 76, 84, 154] and rows[1].removed == []


def test_passages_repeated_in_a_document_that_an_earlier_one_holds_in_part(spark):
    draw = random.Random(9)
    docs = []
    for n in range(30):
        passage = "".join(draw.choice("abcdefgh ") for _ in range(200))
        docs.append((2 * n, "start" + passage[: draw.randint(60, 190)] + "end"))
        docs.append((2 * n + 1, "".join(f"{k}:{passage};" for k in range(5))))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found(table, 50) == brute(docs, 50)


def test_fragments_of_more_than_255_strings(spark):
    draw = random.Random(12)
    letters = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passages = [letters(900) for _ in range(10)]
    docs = []
    for n in range(60):
        passage, at = draw.choice(passages), draw.randint(0, 300)
        docs.append((n, letters(50) + passage[at : at + draw.randint(500, 900)] + letters(50)))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for length in (276, 400):
        assert found(table, length) == brute(docs, length)


def test_a_passage_with_other_surroundings_in_every_document(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CONTENTS", 8)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 4000)
    draw = random.Random(14)
    letters = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passage, largest, table_of = letters(300), [], substrings.Workspace.table

    def spied(self, name, rows):
        made = table_of(self, name, rows)
        if name == "sent":
            sizes = made.filter("bucket >= 0").groupBy("bucket").agg(F.sum(F.octet_length("bytes")).alias("n"))
            largest.append(sizes.agg(F.max("n")).first()[0])
        return made

    monkeypatch.setattr(substrings.Workspace, "table", spied)
    for n in (150, 300, 600):
        docs = [(draw.randint(0, n), letters(draw.randint(0, 60)) + passage + letters(draw.randint(0, 60))) for _ in range(n)]
        docs += [(n + 1, passage + "x" + passage), (n + 2, passage[:120] + letters(20) + passage[100:])]
        assert found(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), 50) == brute(docs, 50)
    assert largest[2] < 1.5 * largest[0]


def test_more_real_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8)
    docs = sorted(pairs(table))
    texts = [np.frombuffer(t.encode(), np.uint8) for _, t in docs]
    letter = np.random.Generator(np.random.PCG64(2)).integers(0, 1 << 64, 256, np.uint64)
    hashes = []
    for t in texts:  # of all strings of 50 bytes
        h = np.zeros(max(len(t) - 49, 0), np.uint64)
        for i in range(50):
            h = h * np.uint64(0x9E3779B97F4A7C15) + letter[t[i : i + len(h)]]
        hashes.append(h)
    whose = np.repeat(np.arange(len(docs)), [len(h) for h in hashes])
    _, at, of = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)  # at the first place
    later = np.split(whose[at][of] < whose, np.cumsum([len(h) for h in hashes])[:-1])
    gone = {}
    for (d, _), t, own in zip(docs, texts, later, strict=True):
        cover = np.zeros(len(t) + 1, np.int64)
        np.add.at(cover, np.flatnonzero(own), 1)
        np.add.at(cover, np.flatnonzero(own) + 50, -1)
        gone[d] = int((cover.cumsum() > 0).sum())
    assert {r.doc_id: r.n_removed for r in substrings.without_repeats(table, 50).collect()} == gone


def test_rows_sent_do_not_follow_the_documents(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 8000)
    draw = random.Random(15)
    letters = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passages, most, table_of = [letters(120) for _ in range(60)], [], substrings.Workspace.table

    def spied(self, name, rows):
        made = table_of(self, name, rows)
        if name == "sent":
            most.append(max(r["count"] for r in made.filter("bucket >= 0").groupBy("bucket").count().collect()))
        return made

    monkeypatch.setattr(substrings.Workspace, "table", spied)
    docs = [(n, "".join(letters(9) + draw.choice(passages)[draw.randint(0, 30) :] for _ in range(6))) for n in range(300)]
    assert found(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), 50) == brute(docs, 50)
    assert most[0] <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_answers_to_many_parts_of_the_documents():
    draw = random.Random(16)
    texts = ["".join(draw.choice("abcdefgh ") for _ in range(400)) for _ in range(40)]
    columns = [pa.array(range(20_000), pa.int64())] * 2 + [pa.array([texts[n % 40] for n in range(20_000)])]
    batch = pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "text"])
    named = pa.Table.from_batches(substrings._name(50, 1)([batch]))
    began = time.process_time()
    answers = substrings._resolve(20_000)(named.filter(pa.compute.equal(named["bucket"], -1)))
    assert time.process_time() - began < 8
    assert answers.num_rows > 10_000


def test_equal_rests_of_fragments_are_sorted_once(spark, monkeypatch):
    draw = random.Random(17)
    passage, made, table_of = "".join(draw.choice("abcdefgh ") for _ in range(52)), [], substrings.Workspace.table

    def spied(self, name, rows):
        table = table_of(self, name, rows)
        if name == "sent":
            made.append(table.filter("bucket >= 0").toArrow())
        return table

    monkeypatch.setattr(substrings.Workspace, "table", spied)
    sizes = []
    monkeypatch.setattr(substrings, "suffix_array", lambda text: sizes.append(len(text)) or suffix_array(text))
    totals = []
    for n in (10, 40):
        docs = [(k, chr(0x30 + k) * 40 + passage + chr(0x30 + k) * 40) for k in range(n)]
        assert found(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), 50) == brute(docs, 50)
        sizes.clear()
        assert substrings._sort(50)(made[-1]).num_rows >= n - 1
        totals.append(sum(sizes))
    assert totals[0] == totals[1] > 0
