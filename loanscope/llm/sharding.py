"""Shards by jump consistent hashing (Lamping and Veach, 2014).

A row's shard follows from its stable key and the number of shards alone, without
a ring or a table. Appending a shard moves one row in about ``n + 1`` and moves it
into the new shard only.

Slots number the rows of a shard without gaps. A shard may hold far more rows than
a task should sort, so its rows are cut into blocks of the hash range: block sizes
give offsets, and rows are numbered inside their block. The number of blocks does
not change the slots.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanscope.llm.workspace import Workspace

#: Blocks of the hash range in each shard, as a power of two.
BLOCK_BITS = 8
#: Copies of a row that get their slots at once.
RUN = 10_000
#: Bytes that a row takes besides its text.
ROW_BYTES = 16


def mixed(keys: np.ndarray) -> np.ndarray:
    """A 64-bit mix of integer keys (the finaliser of SplitMix64)."""
    z = keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def jump(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of many 64-bit hashes at once."""
    state = hashes.copy()
    shard = np.zeros(len(state), np.int64)
    target = np.zeros(len(state), np.int64)
    open_ = np.arange(len(state))
    while len(open_):
        shard[open_] = target[open_]
        state[open_] = state[open_] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((state[open_] >> np.uint64(33)).astype(np.float64) + 1.0)
        target[open_] = ((shard[open_] + 1).astype(np.float64) * step).astype(np.int64)
        open_ = open_[target[open_] < shards]
    return shard


def placed(key, shards: int):
    """Column of ``place`` (63 bits), ``shard`` and ``grown`` (with one shard more)."""

    @F.pandas_udf("place long, shard int, grown int")
    def places(keys: pd.Series) -> pd.DataFrame:
        hashes = mixed(keys.to_numpy())
        return pd.DataFrame(
            {
                "place": (hashes >> np.uint64(1)).astype(np.int64),
                "shard": jump(hashes, shards).astype(np.int32),
                "grown": jump(hashes, shards + 1).astype(np.int32),
            }
        )

    return places(key)


def shard(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """One row per input row: key, size, CRC of the text, law, shard, slot, grown_shard.

    The law is ``key``. A null key hashes like -1. A null text has size 16 and the
    CRC of no bytes, as an empty text has. Rows with one key always share a shard;
    repeated rows get a slot each, next to one another. Slots follow the hash of the
    key, then key, size and CRC. Other columns are not read. An empty table gives no row.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.octet_length(body) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    with Workspace(spark, "shard") as work:
        # Repeated rows become one row with a count before anything is shuffled.
        groups = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
        place = placed(F.coalesce("doc_id", F.lit(-1)), shards).alias("p")
        groups = groups.select("*", place).select(
            "doc_id", "size", "text_crc32", "copies", "p.*",
            F.shiftright("p.place", 63 - block_bits).cast("int").alias("block"),
        )
        groups = work.table("groups", groups)
        before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            groups.groupBy("shard", "block")
            .agg(F.sum("copies").alias("n"))
            .select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("block_start"))
        )
        inside = Window.partitionBy("shard", "block").orderBy("place", "doc_id", "size", "text_crc32")
        earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
        numbered = (
            # At most shards * 2^block_bits rows of three numbers, whatever the input.
            groups.join(F.broadcast(offsets), ["shard", "block"])
            .withColumn("first", F.col("block_start") + F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
        )
        # Copies get their slots in runs, so that no array grows with their number.
        runs = numbered.withColumn(
            "run", F.explode(F.expr(f"sequence(first, first + copies - 1, {RUN}L)"))
        )
        slots = F.expr(f"explode(sequence(run, least(run + {RUN}L, first + copies) - 1))")
        return work.keep(
            "shards",
            runs.select(
                "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                slots.alias("slot"), F.col("grown").alias("grown_shard"),
            ),
        )
