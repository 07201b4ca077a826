import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from loanscope.llm import queries, trie
from loanscope.llm.workspace import Workspace

SF = "/root/testdata/sf0.001"


def brute(rows, family=20, heads=4, shared=True):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    paths = dict(own)
    if shared:
        for c in own:
            h = zlib.crc32(str(c).encode()) % heads
            paths[c] = own.get(c - int(np.fmod(c, family)), [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in sorted(paths.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * words
    return sorted(
        (
            convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), children[node], leaves[node],
            saved[node],
            hashlib.sha256(",".join(str(c) for c in convs if len(paths[c]) == len(node)).encode()).hexdigest(),
        )
        for node, convs in list(members.items())
    )


def found(spark, frame, component=trie.COMPONENT, shared=True):
    with Workspace(spark, "test") as work:
        turns = trie.positioned(work, frame)
        turns = trie.with_shared_heads(work, turns, 20, 4) if shared else trie.as_paths(turns)
        return sorted(tuple(r) for r in trie.prefix_trie(turns, component).collect())


def conversations(draw, n, longest, alphabet):
    rows = []
    for c in range(n):
        for t in range(draw.randint(1, longest)):
            rows.append((c * 3, t, draw.choice(["user", "assistant"]), draw.choice(alphabet)))
    return rows


@pytest.mark.parametrize("component", [4, 40, trie.COMPONENT])
def test_random_conversations(spark, component):
    draw = random.Random(component)
    rows = conversations(draw, 60, 6, ["a b", "c", "", "d e f"])
    rows += [(c, t, "user", "same thing") for c in range(1000, 1030) for t in range(4)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(spark, frame, component) == brute(rows)


def test_edge_rows(spark):
    rows = [
        (None, 1, "user", "x"), (0, None, None, None), (0, 1, "user", "b"), (0, 1, "user", "a"), (0, 1, "user", "a"),
        (1, 0, "user", "x y"), (40, 5, "user", "one"), (41, None, "user", "t"), (43, 1, "user", "\t \n"),
        (-5, 1, "user", "n"), (61, 0, "user", "no base"), (62, 0, "user", "no base"), (63, 0, "é", "ü ñ"),
    ]
    rows += [(c, t, "user", f"{t}") for c in range(100, 110) for t in range(5)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    odd = frame.selectExpr("*", "'x' AS depth", "1 AS total", "2 AS k1", "3 AS part")
    assert found(spark, odd) == brute(rows)
    assert found(spark, frame.limit(0)) == []


def test_long_conversations_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    monkeypatch.setattr(trie, "FRAGMENT", 3)
    rows = [(c, t, "user", "a" if t < 23 + c else str(c)) for c in range(6) for t in range(30)]
    rows += [(c, t, "user", "a") for c in range(6, 20) for t in range(9)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(spark, frame, 8, shared=False) == brute(rows, shared=False)


def test_forests_of_any_shape():
    draw = random.Random(3)
    n = 4000
    for parents in (range(-1, n - 1), [-1] + [0] * (n - 1), [-1, *(draw.randrange(i) for i in range(1, n))]):
        parent = np.array(list(parents))
        weight = np.ones(n, np.int64)
        sums = np.arange(n)
        for i in range(n - 1, 0, -1):
            weight[parent[i]] += weight[i]
            sums[parent[i]] += sums[i]
        forest = trie.Forest(np.zeros(n, np.int64), parent, weight, np.arange(n)[:, None])
        assert (forest.decompose()[:, 0] == sums).all()


def test_query_over_all_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(tuple(r) for r in queries.op13_prefix_trie(spark, SF).collect()) == brute(rows)
