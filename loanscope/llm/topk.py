"""Exact top-k inner products over a bit-sliced index.

Vectors become integers. The index holds, for a block of rows and each attribute, one
bitmap per binary digit of the attribute. A query adds the slices of all attributes,
weighted by its own digits, with carry-save adders on whole bitmaps; the sum is again a
list of slices. The top rows are then read off from the most significant slice downward
(O'Neil and Quass, 1997). Rows that are still level after the last slice are the
boundary; they are told apart by id, and the score of every selected row is computed
from its integers.

Negative factors need no signed arithmetic. An attribute is stored from the lowest value
of its block upward in so many digits that the complement of all digits counts down from
the highest; a negative factor takes the complements.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanscope.llm.workspace import Workspace

#: Rows of an index block.
BLOCK_ROWS = 16_384
#: Queries that meet a block in one group.
STRIPE_QUERIES = 256
#: Rows with integers below this share index blocks; larger ones have blocks of their own, by
#: size, so that a few large values do not widen the index of all others.
USUAL = 1 << 26
#: Below this differences of integers fit in 64 bits.
WIDE = 1 << 62
#: Blocks of larger integers hold so many times fewer rows.
WIDE_SHARE = 8


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """Ids with floor(scale * x) of each component, as whole doubles, which hold any of them.

    ``size`` classes the rows by their largest integer: 0 below ``USUAL``, 1 below ``WIDE``,
    then one class for each 128 binary digits. Rows that cannot take part are left out.
    """
    value = F.col(vector)
    finite = lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x)
    usable = value.isNotNull() & F.col(key).isNotNull() & F.forall(value, finite)
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    too_large = F.concat(F.lit("component beyond the range of doubles when scaled, id "), F.col(key).cast("string"))
    whole = lambda y: (  # noqa: E731  doubles from 2^53 on are whole
        F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double"))
        .when(F.abs(y) < F.lit(float("inf")), y).otherwise(F.raise_error(too_large).cast("double"))
    )
    ints = F.transform(value, lambda x: whole(scaled(x)))
    rows = vectors.filter(usable).select(F.col(key).cast("long").alias("vec_id"), ints.alias("ints"), F.size(value).alias("dim"))
    most = F.coalesce(F.array_max(F.transform("ints", F.abs)), F.lit(0.0))
    beyond = F.floor(F.log2(F.greatest(most, F.lit(1.0))) / 128).cast("int") + 2
    size = F.when(most < float(USUAL), 0).when(most < float(WIDE), 1).otherwise(beyond)
    return rows.withColumn("size", size)


def integers(whole: np.ndarray, size: int) -> np.ndarray:
    """Whole doubles as 64-bit integers, or as Python's where those are too small."""
    if size < 2:
        return whole.astype(np.int64)
    made = np.empty(whole.shape, object)
    made.ravel()[:] = [int(v) for v in whole.ravel().tolist()]
    return made


def inner(ints: np.ndarray, factors: np.ndarray) -> list[int]:
    """Exact inner products of rows of integers with factors."""
    if ints.dtype != object and factors.dtype != object:
        most = np.abs(ints).max(initial=0)
        if float(most) * float(np.abs(factors).astype(float).sum()) < 2.0**62:
            return (ints @ factors).tolist()
    return [sum(a * b for a, b in zip(row, factors.tolist(), strict=True)) for row in ints.tolist()]


# -- index ---------------------------------------------------------------------


def bitmaps(rows: np.ndarray) -> np.ndarray:
    """Bits (m x n) as m bitmaps of 64-bit words."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 64) * 64), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def index_block(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Lowest values, slices (dim x digits x words, lowest digit first) and digits."""
    low = ints.min(axis=0)
    above = (ints - low).T  # dim x rows
    digits = max(1, int(above.max()).bit_length())
    size = -(-digits // 8)
    slices = []
    for values in above:
        data = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size] if size <= 8 else np.frombuffer(
            b"".join(int(v).to_bytes(size, "little") for v in values), np.uint8
        ).reshape(-1, size)
        slices.append(bitmaps(np.unpackbits(data, axis=1, bitorder="little")[:, :digits].T))
    return low, np.array(slices), digits


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("vec_id", kind="stable")
    dim, size = int(rows["dim"].iloc[0]), int(rows["size"].iloc[0])
    whole = np.array(rows["ints"].to_list(), np.float64).reshape(len(rows), dim)
    slices, digits = np.zeros((0, 1, 0), np.uint64), 1
    if dim:
        _, slices, digits = index_block(integers(whole, size))
    return pd.DataFrame(
        {
            "dim": [dim],
            "size": [size],
            "block": [int(rows["block"].iloc[0])],
            "n": [len(rows)],
            "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()],
            "ints": [(whole if size else whole.astype(np.int32)).tobytes()],
            "digits": [digits],
            "slices": [slices.tobytes()],
        }
    )


INDEX = "dim int, size int, block long, n long, ids binary, ints binary, digits int, slices binary"


# -- search --------------------------------------------------------------------


def bit_sliced_sum(slices: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Slices (lowest first) of the sum over attributes of |factor| times stored value.

    ``slices`` is dim x digits x words; the complement serves a negative factor.
    """
    dim, digits, words = slices.shape
    size = np.abs(factors)
    levels: list[list[np.ndarray]] = []
    for bit in range(int(size.max(initial=0)).bit_length()):
        used = np.flatnonzero((size >> bit) & 1)
        chosen = slices[used]
        chosen[factors[used] < 0] ^= np.uint64(0xFFFFFFFFFFFFFFFF)
        for digit in range(digits):
            while len(levels) <= bit + digit:
                levels.append([])
            levels[bit + digit].append(chosen[:, digit])
    total = []
    level = 0
    while level < len(levels):
        rows = np.concatenate(levels[level]) if levels[level] else np.zeros((0, words), np.uint64)
        while len(rows) > 1:  # three slices of one weight become one, and one of twice the weight
            if len(rows) == 2:
                rows = np.concatenate([rows, np.zeros((1, words), np.uint64)])
            m = len(rows) // 3
            a, b, c = rows[:m], rows[m : 2 * m], rows[2 * m : 3 * m]
            half = a ^ b
            if level + 1 == len(levels):
                levels.append([])
            levels[level + 1].append((a & b) | (half & c))
            rows = np.concatenate([half ^ c, rows[3 * m :]])
        total.append(rows[0] if len(rows) else np.zeros(words, np.uint64))
        level += 1
    return np.array(total) if total else np.zeros((0, words), np.uint64)


def top_rows(total: np.ndarray, candidates: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest sums among the candidates (a bitmap); ties to lower positions."""
    sure, level = np.zeros_like(candidates), candidates.copy()
    missing = k
    for digit in total[::-1]:
        ones = level & digit
        n = int(np.bitwise_count(ones).sum())
        if n > missing:
            level = ones
        else:
            sure |= ones
            missing -= n
            level &= ~digit
            if not missing:
                break
    positions = lambda bitmap: np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
    return np.concatenate([positions(sure), positions(level)[:missing]])


FOUND = "query long, query_id long, vec_id long, beyond int, score long"
_LIMIT = 1 << 63


def _search(k: int):
    def search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, list] = {c.split(" ")[0]: [] for c in FOUND.split(", ")}
        for block in index.itertuples(index=False):
            n, dim = block.n, block.dim
            ids = np.frombuffer(block.ids, np.int64)
            whole = np.frombuffer(block.ints, np.float64 if block.size else np.int32).reshape(n, dim)
            ints = integers(whole, block.size)
            words = -(-n // 64)
            slices = np.frombuffer(block.slices, np.uint64).reshape(dim, block.digits if dim else 0, words)
            everyone = bitmaps(np.ones((1, n), np.uint8))[0]
            for query in queries.itertuples(index=False):
                factors = integers(np.asarray(query.ints, np.float64), query.query_size)
                candidates = everyone.copy()
                for own in np.flatnonzero(ids == query.query_id):
                    candidates[own // 64] &= ~(np.uint64(1) << np.uint64(own % 64))
                total = bit_sliced_sum(slices, factors) if dim else np.zeros((0, words), np.uint64)
                rows = top_rows(total, candidates, k)
                scores = inner(ints[rows], factors)
                found["query"] += [query.query] * len(rows)
                found["query_id"] += [query.query_id] * len(rows)
                found["vec_id"] += ids[rows].tolist()
                found["beyond"] += [(s >= _LIMIT) - (s < -_LIMIT) for s in scores]
                found["score"] += [s if -_LIMIT <= s < _LIMIT else 0 for s in scores]
        return pd.DataFrame(found)

    return search


def top_k(
    vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024,
    key: str = "vec_id", vector: str = "embedding", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k rows of highest inner product for each row whose id is divisible by ``every``.

    Returns query_id, rank (from 1), vec_id and score; ties go to the smaller id. Components
    count as floor(scale * x). Rows without id, without vector, or with a null, NaN or infinite
    component take no part; all others do, whatever their size. A score among the k best that
    does not fit in 64 bits is an error. A row is never its own answer, nor are rows with its id.
    Repeated rows count once; different vectors under one id count as rows of their own. Vectors
    meet those of their own length only. With fewer than k candidates all are returned; an empty
    table gives no row. Other columns are not read.
    """
    spark = vectors.sparkSession
    with Workspace(spark, "topk") as work:
        rows = quantised(vectors, key, vector, scale).distinct()
        rows = work.table("rows", rows)
        usual = F.count_if(F.col("size") == 0).alias("usual")
        count = rows.agg(usual, F.count("*").alias("all")).first()
        share = block_rows // WIDE_SHARE or 1
        blocks = max(1, math.ceil(count.usual / block_rows), math.ceil((count.all - count.usual) / share))
        blocked = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "ints"), F.lit(blocks)))
        index = work.table("index", blocked.groupBy("dim", "size", "block").applyInPandas(_build, INDEX))

        asked = rows.filter(F.col("vec_id") % every == 0)
        asked = asked.select(
            F.xxhash64("vec_id", "ints").alias("query"), F.col("vec_id").alias("query_id"), "ints", "dim",
            F.col("size").alias("query_size"),
        )
        stripes = max(1, math.ceil(asked.count() / STRIPE_QUERIES))
        stripe = F.pmod(F.xxhash64("query"), F.lit(stripes)).alias("stripe")
        # The stated query set meets the rows in blocks: stripes of queries, blocks of rows.
        every_of = lambda n: F.explode(F.expr(f"sequence(0L, {n - 1}L)"))
        asked = asked.select("*", stripe, every_of(blocks).alias("block"))
        spread = index.select("*", every_of(stripes).alias("stripe"))
        keys = ["dim", "block", "stripe"]
        found = spread.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_search(k), FOUND)
        best = Window.partitionBy("query_id", "query").orderBy(F.desc("beyond"), F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        problem = F.concat(
            F.lit("a score leaves 64 bits: query "), F.col("query_id").cast("string"), F.lit(", row "), F.col("vec_id").cast("string")
        )
        score = F.when(F.col("beyond") == 0, F.col("score")).otherwise(F.raise_error(problem).cast("long"))
        return work.keep("best", ranked.select("query_id", "rank", "vec_id", score.alias("score")))
