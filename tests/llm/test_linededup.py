import random
import time
from collections import defaultdict

from tests.llm.conftest import CLASHING, pairs

from loanscope.llm import linededup


def brute(docs, run):
    """Texts left, by the definition: every run of enough words that also stands earlier."""
    lines = {d: [tuple(x.split()) for x in t.split("\n")] for d, t in docs if d is not None and t is not None}
    places = defaultdict(list)
    for d, own in lines.items():
        for i in range(len(own)):
            words = 0
            for j in range(i, len(own)):
                words += len(own[j])
                if words >= run:
                    places[tuple(own[i : j + 1])].append((d, i, j + 1))
                    break
    gone = {d: set() for d in lines}
    for same in places.values():
        for d, i, j in same:
            for e, start, stop in same:
                if (e, start) < (d, i):
                    more = 0
                    while lines[d][j + more : j + more + 1] == lines[e][stop + more : stop + more + 1] != []:
                        more += 1
                    gone[d] |= set(range(i, j + more))
    left = []
    for d, t in docs:
        kept = t if d is None or t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d])
        left.append((d, kept, 0 if t is None else t.count("\n") + 1, len(gone.get(d, ())) if t is not None else 0))
    return sorted(left, key=str)


def found(table, run):
    rows = linededup.without_repeats(table, run).select("doc_id", "text", "lines", "lines_removed").collect()
    return sorted(map(tuple, rows), key=str)


def test_edge_cases(edge_docs, no_docs):
    one_text = edge_docs.filter("doc_id IS NULL OR doc_id <> 9")
    assert found(one_text, 50) == brute(pairs(one_text), 50)
    made = linededup.without_repeats(edge_docs)
    assert made.columns == [*edge_docs.columns, "lines", "lines_removed"]
    assert sorted(r.size for r in made.select(*CLASHING).collect()) == sorted(r.size for r in edge_docs.collect())
    assert linededup.without_repeats(edge_docs, counts=False).columns == edge_docs.columns
    assert linededup.without_repeats(edge_docs, emptied=False).filter("text = ''").select("doc_id").collect()[0][0] == 3
    assert linededup.without_repeats(no_docs).collect() == []


def test_random_texts(spark):
    draw = random.Random(3)
    for _ in range(3):
        docs = [
            (i, "\n".join(" ".join([draw.choice("abc")] * draw.randint(0, 3)) for _ in range(draw.randint(0, 12))))
            for i in range(50)
        ]
        assert found(spark.createDataFrame(docs, "doc_id long, text string"), 4) == brute(docs, 4)


def test_real_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expected = brute(pairs(table), linededup.RUN_WORDS)
    assert found(table, linededup.RUN_WORDS) == expected
    assert sum(r[3] > 0 for r in expected) > 50


def test_longest_earlier_run_counts(spark):
    line = " ".join(f"w{i}" for i in range(60))
    tail = "one two\nthree\n\nfour five six"
    docs = [(1, f"{line}\nother"), (2, f"{line}\n{tail}"), (3, f"{line}\n{tail}\nnew")]
    made = found(spark.createDataFrame(docs, "doc_id long, text string"), 50)
    assert made == brute(docs, 50)
    assert [r[3] for r in made] == [0, 1, 5] and made[2][1] == "new"


def test_texts_with_long_runs_of_empty_lines(spark):
    words = " ".join(f"w{i}" for i in range(60))
    began = time.monotonic()
    assert len(list(linededup.windows("\n" * 300_000 + words, 50))) == 300_001
    assert len(list(linededup.windows(words + "\n" * 300_000, 50))) == 300_001
    assert time.monotonic() - began < 20
    texts = ["\n" * 40 + words + "\n" * 30, "x\n" + "\n" * 20 + words + "\n" * 50 + words, "\n".join(words.split()) * 2]
    docs = list(enumerate(texts * 2))
    assert found(spark.createDataFrame(docs, "doc_id long, text string"), 50) == brute(docs, 50)


def test_shared_windows_share_fingerprints():
    left = list(linededup.windows("x y\n" + "a b c\nd e\nf g h\n" + "q", 8))
    right = list(linededup.windows("k\nl m n o\n" + "a b c\nd e\nf g h\n" + "r s", 8))
    prints = lambda rows: {w[4:]: w[2] for w in rows}
    shared = prints(left).keys() & prints(right).keys()
    assert shared and all(prints(left)[c] == prints(right)[c] for c in shared)
