import math
import random

import numpy as np
import pytest

from loanscope.llm import topk


def brute(rows, k=10, every=100):
    usable = {
        (i, tuple(math.floor(1024 * x) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    found = []
    for qid, q in usable:
        if qid % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in usable if i != qid and len(v) == len(q)]
        found += [(qid, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def test_edge_cases(spark):
    draw = random.Random(2)
    vector = lambda n: [draw.randint(-40, 40) / 32 for _ in range(n)]
    rows = [(i, vector(5)) for i in range(400)]
    rows += [(500 + i, [1.0, 0.0, -1.0, 0.5, 0.25]) for i in range(60)] + [rows[0], rows[100]]
    rows += [(700, None), (701, [1.0, None, 1.0, 1.0, 1.0]), (702, [float("nan")] * 5), (800, [float("inf")] * 5)]
    rows += [(900, vector(3)), (901, vector(3)), (1000, []), (None, vector(5)), (-100, vector(5)), (100, vector(5))]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, block string, dim int")
    for block_rows in (16_384, 100):
        found = topk.top_k(table, block_rows=block_rows).collect()
        assert sorted(map(tuple, found)) == brute(rows)
    assert topk.top_k(table.limit(0)).collect() == []
    assert topk.top_k(table.filter("vec_id = 900")).collect() == []


def test_large_components_take_part(spark):
    draw = random.Random(4)
    large = [70000.0, 1e6, -1e6, 65536.0, 2e6, -2.5, 0.0, 1.0]
    rows = [(i, [draw.choice(large), draw.choice([0.5, -1.0, 2e4]), 0.25]) for i in range(300)]
    rows += [(400, [70000.0, 1.0, 0.0]), (401, [70000.0, 1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block_rows in (16_384, 64):
        assert sorted(map(tuple, topk.top_k(table, block_rows=block_rows).collect())) == brute(rows)
    # Integers beyond 64 bits, whose scores fit where the other factor is zero.
    rows = [(i, [0.0, draw.randint(-9, 9) * 1.0]) for i in range(150)] + [(200 + i, [1e40 * i, 3.0]) for i in range(5)]
    rows = [r for r in rows if r[0] != 200]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(table).collect())) == brute(rows)
    # Scores that do not fit end the query, but only among the best.
    for sign in (1.0, -1.0):
        few = [(0, [1e12, 1.0]), (1, [sign * 1e12, 1.0]), (2, [1.0, 1.0])]
        table = spark.createDataFrame(few, "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="leaves 64 bits: query 0, row 1"):
            topk.top_k(table).collect()
    assert [r.vec_id for r in topk.top_k(table, k=1).collect()] == [2]
    odd = spark.createDataFrame([(0, [1e306]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="range of doubles"):
        topk.top_k(odd).collect()


def test_sum_and_selection_on_bitmaps():
    draw = np.random.Generator(np.random.PCG64(3))
    values = draw.integers(-500, 500, (300, 7))
    low, slices, digits = topk.index_block(values)
    factors = draw.integers(-300, 300, 7)
    total = topk.bit_sliced_sum(slices, factors)
    sums = sum((row.astype(object) << i) for i, row in enumerate(np.unpackbits(total.view(np.uint8), axis=1, bitorder="little")[:, :300].astype(np.int64)))
    shifted = np.where(factors < 0, (1 << digits) - 1 - (values - low), values - low)
    assert (sums == (shifted * np.abs(factors)).sum(axis=1)).all()
    rows = topk.top_rows(total, topk.bitmaps(np.ones((1, 300), np.uint8))[0], 17)
    assert set(rows) == set(np.lexsort((np.arange(300), -(values @ factors)))[:17])
