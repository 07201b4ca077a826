import random

import numpy as np
from tests.llm.conftest import pairs

from loanscope.llm import decontamination as d


def align(item, passage):
    """Smith-Waterman, cell by cell."""
    table = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            table[i][j] = max(
                0, table[i - 1][j - 1] + (d.MATCH if a == b else d.CHANGE), table[i - 1][j] + d.GAP, table[i][j - 1] + d.GAP
            )
            best = max(best, table[i][j])
    return best


def test_alignment():
    draw = np.random.Generator(np.random.PCG64(4))
    for _ in range(300):
        item, passage = draw.integers(0, 5, draw.integers(1, 12)), draw.integers(0, 5, draw.integers(1, 30))
        score, end = d.alignment(item, passage)
        assert score == align(item.tolist(), passage.tolist())
        if score:
            assert align(item.tolist(), passage[:end].tolist()) == score


def words(draw, n, kind="w"):
    return [f"{kind}{draw.randint(0, 3000)}" for _ in range(n)]


def test_copies_edited_copies_and_clean_documents(spark):
    draw = random.Random(6)
    items = [(i, words(draw, draw.randint(15, 50))) for i in range(40)]
    docs, expected = [], set()
    for n in range(300):
        text = words(draw, draw.randint(0, 400))
        if n % 3 == 0:
            i, item = draw.choice(items)
            copy = list(item)
            for _ in range(len(copy) // 7):  # edits: changed, dropped and added words
                at = draw.randrange(len(copy))
                copy[at : at + 1] = draw.choice([["edit"], [], [copy[at], "more"]])
            at = draw.randint(0, len(text))
            text[at:at] = [w.upper() + "," for w in copy]
            expected.add((n, i))
        docs.append((n, " ".join(text)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w) + ".") for i, w in items], "item_id long, text string")
    found = d.contaminated(table, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected)
    kept = {r.doc_id for r in d.without_benchmark(table, bench).collect()}
    assert kept == set(range(300)) - {n for n, _ in expected}
    whole = spark.createDataFrame([(1, "before " + " ".join(items[0][1]) + " after")], "doc_id long, text string")
    assert [tuple(r) for r in d.contaminated(whole, bench).collect()] == [(1, 0, 1.0, 1, len(items[0][1]))]


def test_an_item_that_leaked_everywhere_is_found(spark):
    draw = random.Random(8)
    item = words(draw, 30)
    docs = [(n, " ".join(words(draw, 20) + (item if n % 2 else []))) for n in range(200)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = d.contaminated(table, bench).collect()
    assert {r.doc_id for r in found} == set(range(1, 200, 2))


def test_single_copies_with_many_changed_words_are_found(spark):
    draw = random.Random(10)
    items = [(i, words(draw, draw.randint(15, 60))) for i in range(60)]
    docs = [(-1 - i, " ".join(words(draw, 20) + w + words(draw, 20))) for i, w in items[:30]]  # plain copies
    expected = {(-1 - i, i): 1.0 for i in range(30)}
    for n in range(240):
        i, item = items[n % 60]
        if n < 180:
            share = (0.2, 0.25, 0.3)[n // 60]
            copy = [f"changed{k}" if draw.random() < share else w for k, w in enumerate(item)]
        else:  # no two neighbours stay neighbours
            copy = [x for w in item for x in (w, "more")][:-1]
        score = align(item, copy) / (d.MATCH * len(item))
        if score >= d.LEAST_SCORE:
            docs.append((n, " ".join(words(draw, draw.randint(0, 9000)) + copy + words(draw, 30))))
            expected[n, i] = score
    assert len(expected) > 200
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = d.contaminated(table, bench).collect()
    scores = {(r.doc_id, r.item_id): r.score for r in found}
    assert scores.keys() == expected.keys() and all(scores[k] >= expected[k] for k in expected)


def test_every_alignment_that_scores_enough_is_found(spark):
    draw = random.Random(7)
    letters = "abcdefghi"
    items = [(i, [draw.choice(letters) for _ in range(draw.randint(3, 12))]) for i in range(25)]
    docs = [(n, [draw.choice(letters) for _ in range(draw.randint(0, 60))]) for n in range(60)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    table = spark.createDataFrame([(n, " ".join(w)) for n, w in docs], "doc_id long, text string")
    scores = {(n, i): align(w, t) / (d.MATCH * len(w)) for n, t in docs for i, w in items}
    for least in (0.3, 0.5, 0.8):
        found = d.contaminated(table, bench, least=least).collect()
        expected = {k: v for k, v in scores.items() if v >= least}
        assert {(r.doc_id, r.item_id): r.score for r in found} == expected and expected
        for r in found[:50]:
            copy = dict(docs)[r.doc_id][r.first_word : r.last_word + 1]
            assert align(dict(items)[r.item_id], copy) / (d.MATCH * len(dict(items)[r.item_id])) == r.score


def test_an_alignment_holds_so_many_n_grams():
    draw = np.random.Generator(np.random.PCG64(7))
    tight = 0
    for _ in range(3000):
        item = draw.permutation(40)[: draw.integers(3, 14)].astype(np.uint64)
        copy = []
        for w in item:
            copy += [[w], [w], [w, 99], [], [98], [97, w, 96]][draw.integers(0, 6)]
        share = align(item.tolist(), copy) / (d.MATCH * len(item))
        for least in (0.3, 0.5, 0.8):
            if share >= least:
                key, place = d.grams(np.array(copy, np.uint64))
                held = np.isin(key, d.grams(item)[0])
                # As many different n-grams of the item, and as many words of the copy that begin one.
                n = min(len(set(key[held].tolist())), len(set(place[held].tolist())))
                assert n >= d.grams_held(len(item), least)
                tight += n == d.grams_held(len(item), least)
    assert tight


def test_bitmaps_that_say_yes_to_everything(spark, monkeypatch):
    monkeypatch.setattr(d, "SIEVE", 6)  # errors of the bitmap cost time and nothing else
    draw = random.Random(3)
    items = [(i, words(draw, 20)) for i in range(5)]
    docs = [(n, " ".join(words(draw, 30) + dict(items)[n % 5] * (n % 2))) for n in range(20)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(n, n % 5) for n in range(1, 20, 2)}


def test_edge_cases(spark, edge_docs, no_docs):
    bench = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, "two words", 1), (None, "lorem1 ipsum2 dolor3 sit4", 1), (4, "another text of nine", 1), (4, "another text of nine", 2)],
        "item_id long, text string, hits int",
    )
    assert [(r.doc_id, r.item_id) for r in d.contaminated(edge_docs, bench).collect()] == [(9, 4)]
    left = d.without_benchmark(edge_docs, bench)
    assert left.columns == edge_docs.columns and left.count() == edge_docs.count() - 1
    assert d.contaminated(no_docs, bench).collect() == [] and d.without_benchmark(no_docs, bench).collect() == []
    assert d.contaminated(edge_docs, bench.limit(0)).collect() == []
    same = bench.limit(0).unionByName(spark.createDataFrame([(7, "another text of ten", 1), (7, "another text of nine", 1)], bench.schema))
    assert [tuple(r)[:3] for r in d.contaminated(edge_docs, same).collect()] == [(9, 7, 1.0)]


def test_real_leaks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    plain = lambda t: d.benchmark_words(t).tobytes()
    items = {r.item_id: plain(r.text) for r in bench.collect()}
    whole = {(k, i) for k, t in pairs(docs) for i, w in items.items() if w in plain(t)}
    found = d.contaminated(docs, bench).collect()
    assert whole <= {(r.doc_id, r.item_id) for r in found}
    assert all(r.score > 0.8 for r in found if (r.doc_id, r.item_id) in whole)
