import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from loanscope.llm import phrases


def brute(rows, least, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    made = []
    for lang, f in counts.items():
        good = {p: n for p, n in f.items() if n >= least and len(p) > 1}
        rated = []
        for p, a in good.items():
            longer = (q for q in good if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * good[q] >= 80 * a for q in longer):
                continue
            cuts = [(2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rated.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rated)[:top], 1):
            made.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(made)


def corpus(draw, n):
    words = ["the", "The", "of", "new", "york", "NEW", "é", "ß", "日本", "x\x01", "rare"] + [f"w{i}" for i in range(30)]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "; the new "]
    rows = []
    for _ in range(n):
        text = "".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randint(0, 60)))
        rows.append((text, draw.choice(["en", "en", "de", None, "und", ""])))
    return rows


def found(spark, rows, **settings):
    frame = spark.createDataFrame(rows, "text string, lang string").selectExpr("*", "1 AS n", "'x' AS phrase", "2 AS rank")
    return sorted(tuple(r) for r in phrases.collocations(frame, **settings).collect())


@pytest.mark.parametrize("memory", [20, 300, phrases.MEMORY])
def test_groups_of_any_size(spark, monkeypatch, memory):
    monkeypatch.setattr(phrases, "FEWEST_CLASSES", 6)
    rows = corpus(random.Random(memory), 150)
    assert found(spark, rows, least=5, memory=memory) == brute(rows, 5)


def test_texts_in_parts_and_small_buffers(monkeypatch):
    monkeypatch.setattr(phrases, "SPAN", 16)
    import pyarrow as pa

    rows = corpus(random.Random(9), 40) + [("a b c d e f g h i j k l m n o p " * 5, "en")]
    batch = pa.RecordBatch.from_pydict({"lang": [r[1] or "und" for r in rows], "text": [r[0] for r in rows]})
    sieve = np.full(1 << (phrases.SIEVE - 6), np.iinfo(np.uint64).max)
    suffixes = phrases.Suffixes(phrases.Partition(sieve, 6))
    counts = defaultdict(Counter)
    for lang, some in suffixes.of(batch):
        words = suffixes.vocabularies[lang].words
        for row in some.tolist():
            counts[lang][tuple(words[i].decode() for i in row if i)] += 1
    want = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words) - 1):
                want[lang or "und"][tuple(words[i : i + 4])] += 1
    assert counts == want


def test_edge_rows(spark, edge_docs):
    assert found(spark, []) == []
    rows = [(None, None), ("", "en"), (" \n\t", "en"), ("one", "en")]
    assert found(spark, rows, least=1) == []
    rows += [("a b a b a b", "en")] * 20 + [("c " * 5000 + "d", None), ("long" * 5000 + " word", "de")]
    assert found(spark, rows) == brute(rows, 30)
    assert found(spark, rows, least=1, top=3) == brute(rows, 1, 3)


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**17
    row = spark.sql(f"SELECT CAST({big} AS LONG) AS a, CAST({big + 7} AS LONG) AS l, CAST({9 * 10**18} AS LONG) AS r")
    from pyspark.sql import functions as F

    exact = phrases._exact
    made = row.select(
        (F.lit(2_000_000).cast("decimal(10,0)") * exact(F.col("a"))).alias("scaled"),
        (exact(F.col("l")) + exact(F.col("r"))).alias("both"),
    ).select(F.expr("scaled div both")).first()[0]
    assert made == 2_000_000 * big // (big + 7 + 9 * 10**18)
