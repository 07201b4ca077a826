import zlib
from collections import Counter

from tests.llm.conftest import pairs

from loanscope.llm import sharding

MASK = (1 << 64) - 1


def jump(key, shards):
    """Jump consistent hash, one key at a time."""
    here, there = -1, 0
    while there < shards:
        here = there
        key = (key * 2862933555777941757 + 1) & MASK
        there = int((here + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return here


def mix(key):
    z = (key + 0x9E3779B97F4A7C15) & MASK
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & MASK
    return z ^ (z >> 31)


def expected(docs, shards):
    rows = []
    for doc_id, text in docs:
        body = (text or "").encode()
        hashed = mix((-1 if doc_id is None else doc_id) & MASK)
        rows.append((jump(hashed, shards), hashed >> 1, (doc_id is not None, doc_id or 0), len(body) + 16, zlib.crc32(body), doc_id, jump(hashed, shards + 1)))
    slots = Counter()
    for shard, _, _, size, crc, doc_id, grown in sorted(rows):
        yield doc_id, size, crc, "key", shard, slots[shard], grown
        slots[shard] += 1


def test_edge_cases_and_blocks(edge_docs, no_docs):
    for bits in (0, 8):
        found = sharding.shard(edge_docs, 3, block_bits=bits).collect()
        assert sorted(map(tuple, found), key=str) == sorted(expected(pairs(edge_docs), 3), key=str)
    assert sharding.shard(no_docs, 3).collect() == []


def test_many_rows_move_into_the_new_shard_only(spark):
    docs = spark.range(20_000).selectExpr("id * 7 AS doc_id", "'x' AS text")
    rows = sharding.shard(docs, 40).collect()
    assert sorted(map(tuple, rows)) == sorted(expected([(i * 7, "x") for i in range(20_000)], 40))
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert all(r.grown_shard == 40 for r in moved)
    assert abs(len(moved) - 20_000 / 41) < 5 * (20_000 / 41) ** 0.5


def test_many_copies_of_a_row(spark):
    rows = sharding.shard(spark.range(25_000).selectExpr("3L AS doc_id", "'x' AS text"), 2).collect()
    assert sorted(r.slot for r in rows) == list(range(25_000))
