import random

import numpy as np
from tests.llm.conftest import pairs

from loanscope.llm import neardup
from loanscope.llm.components import contracted
from loanscope.llm.shingles import SPAN, common_shingles, shingle_set, wide_hashes
from loanscope.llm.workspace import Workspace


def sets(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(docs, size, percent):
    rows = [(d, sets(t, size)) for d, t in docs]
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(rows):
        for b, t in rows[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [(d, len(s), None if d is None else find(d), d is None or find(d) == d) for d, s in rows]


def same(found, expected):
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_edge_cases(edge_docs, no_docs):
    docs = [(d, t) for d, t in pairs(edge_docs) if d != 9]
    same(neardup.near_duplicates(edge_docs.filter("doc_id IS NULL OR doc_id <> 9"), 3, 85).collect(), brute(docs, 3, 85))
    # One id with two texts is one document; each row has its own set.
    nine = [r for r in neardup.near_duplicates(edge_docs, 3, 85).collect() if r.doc_id == 9]
    assert {r.component_id for r in nine} == {9} and len({r.n_shingles for r in nine}) == 2
    assert neardup.near_duplicates(no_docs).collect() == []


def test_groups_of_edited_copies(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)  # so that arenas take several blocks
    draw = random.Random(5)
    docs = []
    for _ in range(6):
        base = [f"w{draw.randint(0, 2000)}" for _ in range(80)]
        for _ in range(60):
            copy = list(base)
            for _ in range(draw.randint(0, 6)):
                copy[draw.randrange(80)] = f"x{draw.randint(0, 9999)}"
            docs.append((draw.randint(0, 10**9), " ".join(copy)))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    same(neardup.near_duplicates(table, 3, 85).collect(), brute(docs, 3, 85))
    same(neardup.near_duplicates(table).collect(), brute(docs, 5, 80))


def test_texts_go_only_where_a_partner_is_likely(spark, monkeypatch):
    blocks, met = neardup._blocks, []

    def spied(work, members):
        assert set(members.columns) == {"arena", "rep", "root", "length"}
        made = blocks(work, members)
        assert set(made.columns) == {"arena", "i", "j", "rep", "root", "rest"}
        met.append(made.select("i").distinct().count())
        return made

    monkeypatch.setattr(neardup, "_blocks", spied)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 1500)
    draw = random.Random(8)
    docs = []
    for group in range(4):
        base = [f"w{draw.randint(0, 900)}" for _ in range(60)]
        for _ in range(40):
            copy = list(base)
            for _ in range(draw.randint(1, 5)):
                copy[draw.randrange(60)] = f"x{draw.randint(0, 9999)}"
            docs.append((len(docs), " ".join(copy)))
    same(neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85).collect(), brute(docs, 3, 85))
    assert met and met[0] > 1


def test_chains_of_links(spark):
    words = [f"w{i}" for i in range(400)]
    docs = [(100 - i, " ".join(words[3 * i : 3 * i + 100])) for i in range(60)]
    same(neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85).collect(), brute(docs, 3, 85))


def test_components_of_a_long_path(spark):
    links = spark.range(300).selectExpr("id AS a", "id + 1 AS b").unionByName(spark.createDataFrame([(1000, 1001), (5, 5)], "a long, b long"))
    with Workspace(spark, "test") as work:
        roots = {r.node: r.root for r in contracted(work, links, "t").collect()}
        assert len({roots[i] for i in range(301)}) == 1 and roots[1000] == roots[1001] != roots[0]
        assert contracted(work, links.limit(0), "none") is None


def test_bands_and_posterior():
    rows, bands = neardup.bands_for(0.85)
    assert (1 - 0.85**rows) ** bands <= neardup.MISS and rows * bands <= neardup.HASHES
    fewest = neardup.fewest_matches(0.85)
    assert fewest == sorted(fewest) and fewest[-1] < 0.85 * neardup.HASHES
    draw = np.random.Generator(np.random.PCG64(1))
    agree = []
    for _ in range(200):
        common, own = draw.integers(0, 1 << 63, 85, dtype=np.uint64), draw.integers(0, 1 << 63, 15, dtype=np.uint64)
        both = lambda halves: np.column_stack([halves, halves])
        agree.append((neardup.signature(both(common)) == neardup.signature(both(np.concatenate([common, own])))).mean())
    assert abs(np.mean(agree) - 0.85) < 0.01


def test_words_with_a_regular_pattern_stay_apart(spark):
    thue = [bin(i).count("1") % 2 for i in range(4096)]
    pair = ["".join("ab"[bit ^ flip] for bit in thue[:1024]) for flip in (0, 1)]
    assert not common_shingles(shingle_set(pair[0], 3), shingle_set(pair[1], 3))
    docs = [(1, pair[0]), (2, pair[1]), (3, pair[0].upper()), (4, "".join("ab"[b] for b in thue)), (5, "".join("ba"[b] for b in thue))]
    same(neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85).collect(), brute(docs, 3, 85))


def test_sets_whose_hashes_agree_in_one_half():
    left = np.array([[1, 1], [1, 2], [2, 5]], np.uint64)
    right = np.array([[1, 2], [2, 5], [2, 6], [3, 1]], np.uint64)
    assert common_shingles(left, right) == common_shingles(right, left) == 2
    assert common_shingles(left[:0], right) == 0


def test_words_are_split_at_ascii_space_only_and_long_texts_in_stretches():
    text = ("a b C\x0bd\x1ce " + "x" * 50 + "\n") * 9000 + "y" * (SPAN + 10) + " Z"
    assert len(text.encode()) > 2 * SPAN
    words = text.encode().lower().split()
    hashes = wide_hashes(text)[:, 0]
    assert len(hashes) == len(words)
    assert len(set(zip(words, hashes.tolist(), strict=True))) == len(set(words)) == len(set(hashes.tolist()))
    assert len(shingle_set(text, 3)) == len(sets(text, 3))
