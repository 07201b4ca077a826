"""Benchmark passages in documents: rare n-gram seeds, a join, then Smith-Waterman alignment.

1. The n-grams of an item are ordered pairs of its words with at most one word between. Two
   words that an alignment pairs one after another are such a pair on both sides unless at
   least two edits lie between them. An alignment that scores enough cannot pay for that
   everywhere, so it holds at least so many of the item's n-grams. As many of the most common
   ones as leave half of that number are no seeds; at least half are then seeds wherever an
   item was copied.
2. Documents are read once to count the n-grams of the benchmark, and once for the seeds; each
   time a bitmap of fixed size passes over words of no interest. Seeds found are joined to
   items; stretches that an alignment can cover with enough seeds of an item are passages.
3. Passages are aligned with their items: local alignment of words, which edits, insertions
   and omissions cost little. The score is the share of a perfect copy's.

No copy that scores enough is left out, however it was edited. Benchmark and seeds stay tables;
what goes to every task is the bitmap.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscope.llm.shingles import NOT_ALPHANUMERIC, mixed, word_hashes
from loanscope.llm.workspace import Workspace

#: Words of the shortest item that takes part.
LEAST_WORDS = 3
#: Share of a perfect copy's score from which a document counts as contaminated.
LEAST_SCORE = 0.5
#: Alignment: an equal word, a changed word, a word too many or missing.
MATCH, CHANGE, GAP = 2, -1, -1
#: Bits of the bitmap of n-grams, as a power of two.
SIEVE = 22
#: N-grams counted before a task sends them.
COUNTED = 1 << 20

#: Punctuation and spaces beyond ASCII.
_MARKS = re.compile(r"[\u00a0-\u00bf\u2000-\u206f\u3000-\u303f]")
_BASE = np.uint64(0x9E3779B97F4A7C15)

HIT = "item_id long, score double, first_word int, last_word int"


def benchmark_words(text: str | None) -> np.ndarray:
    """Word hashes: letters and digits in lower case, punctuation ignored."""
    return word_hashes(_MARKS.sub(" ", (text or "").lower()), NOT_ALPHANUMERIC)


def reach(n: int, least: float) -> int:
    """Words of a document that an alignment with an item of n words covers at most."""
    return n + max(0, int(MATCH * n * (1 - least) / -GAP + 1e-9))


def grams_held(n: int, least: float) -> int:
    """N-grams of an item of n words that an alignment which scores enough holds at least.

    m paired words score 2 m. Between two that are not an n-gram on both sides lie two words or
    more on one of them, which cost 2. With x n-grams the score is at most 2 m - 2 (m - 1 - x).
    """
    return math.ceil(least * n - 1e-9) - 1


def seeds_held(n: int, least: float) -> int:
    """Seeds of an item that an alignment which scores enough holds at least."""
    return max(1, math.ceil(grams_held(n, least) / 2))


def grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the ordered pairs of words with at most one word between, and their first words."""
    keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for step in (1, 2):
        if len(words) > step:
            keys.append(mixed(words[:-step] * _BASE + words[step:]))
            places.append(np.arange(len(words) - step))
    return np.concatenate(keys), np.concatenate(places)


def seeds_of_short(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of single words, for items so short that one paired word may score enough."""
    return mixed(words ^ _BASE), np.arange(len(words))


def _sieve(keys: DataFrame) -> np.ndarray:
    """Bitmap of the keys' low bits."""
    bucket = F.col("gram").bitwiseAND(F.lit((1 << SIEVE) - 1))
    mask = F.expr("bit_or(shiftleft(1L, CAST(bucket & 63 AS INT)))").alias("mask")
    marks = keys.select(bucket.alias("bucket")).groupBy(F.shiftright("bucket", 6).alias("at")).agg(mask).toPandas()
    sieve = np.zeros(1 << (SIEVE - 6), np.uint64)
    sieve[marks["at"].to_numpy(np.int64)] = marks["mask"].to_numpy(np.int64).view(np.uint64)
    return sieve


def _sifted(sieve: np.ndarray, words: np.ndarray, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a document that may be in the bitmap, and their places."""
    keys, places = grams(words)
    if short:
        single, at = seeds_of_short(words)
        keys, places = np.concatenate([keys, single]), np.concatenate([places, at])
    bucket = (keys & np.uint64(64 * len(sieve) - 1)).astype(np.int64)
    likely = np.flatnonzero((sieve[bucket >> 6] >> (bucket & 63).astype(np.uint64)) & np.uint64(1))
    return keys[likely], places[likely]


def _counted(sieve: np.ndarray, short: bool):
    """Number of documents with each n-gram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["gram", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.append(np.unique(_sifted(sieve, benchmark_words(text), short)[0]))
                size += len(held[-1])
                if size > COUNTED:
                    yield summed()
                    held, size = [], 0
        yield summed()

    return count


def _found(sieve: np.ndarray, short: bool):
    """Places of the seeds in each document."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
            for text in batch.column("text").to_pylist():
                key, place = _sifted(sieve, benchmark_words(text), short)
                keys.append(key)
                places.append(place)
                sizes.append(len(key))
            rows = np.repeat(np.arange(len(sizes)), sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("content").take(pa.array(rows)),
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.concatenate(places).astype(np.int32)),
                ],
                names=["content", "gram", "place"],
            )

    return find


#: Columns of an item's n-grams: its reach, the n-grams that an alignment holds, and of them seeds.
_ITEM_GRAMS = "item long, reach long, needed long, seeds long, gram long"


def _item_grams(least: float):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in _ITEM_GRAMS.split(", ")]
        for batch in batches:
            rows, keys = [], [np.zeros(0, np.uint64)]
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = benchmark_words(text)
                n = len(words)
                if n >= LEAST_WORDS:
                    needed = grams_held(n, least)
                    rows.append((item, reach(n, least), needed, seeds_held(n, least)))
                    keys.append(grams(words)[0] if needed > 0 else seeds_of_short(words)[0])
            sizes = [len(k) for k in keys[1:]]
            columns = [np.repeat(np.array([r[i] for r in rows], np.int64), sizes) for i in range(4)]
            columns.append(np.concatenate(keys).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return split


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of documents with enough seeds: content, item, first word, word hashes.

    Takes for each document the items and, by item, the stretches: number b starts at b times the
    item's reach and is twice as long, so each alignment lies within one. Those that overlap
    are put together.
    """
    for batch in batches:
        made: dict[str, list] = {"content": [], "item": [], "low": [], "passage": []}
        columns = (batch.column(c).to_pylist() for c in ("content", "text", "found"))
        for content, text, found in zip(*columns, strict=True):
            words = benchmark_words(text)
            for near in found:
                far, stretches = near["reach"], np.sort(np.array(near["stretches"], np.int64))
                for group in np.split(stretches, np.flatnonzero(np.diff(stretches) > 1) + 1):
                    low = max(0, int(group[0])) * far
                    made["content"].append(content)
                    made["item"].append(near["item"])
                    made["low"].append(low)
                    made["passage"].append(words[low : (int(group[-1]) + 2) * far].tobytes())
        types = {"content": pa.binary(), "item": pa.int64(), "low": pa.int32(), "passage": pa.binary()}
        yield pa.RecordBatch.from_arrays([pa.array(made[n], t) for n, t in types.items()], names=list(types))


def alignment(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score and the passage word where it ends."""
    across = np.arange(len(passage) + 1) * -GAP
    row = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        fresh = np.maximum(row + GAP, 0)
        np.maximum(fresh[1:], row[:-1] + np.where(passage == word, MATCH, CHANGE), out=fresh[1:])
        row = np.maximum.accumulate(fresh + across) - across
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def copy_in(item: np.ndarray, passage: np.ndarray, least: float) -> tuple[float, int, int] | None:
    """Score, first and last word of the best copy in a passage, if it scores enough."""
    enough = least * MATCH * len(item) - 1e-9
    # No alignment can score more than the words of the item in its stretch, less the others.
    gain = np.append(0, np.where(np.isin(passage, item), MATCH, max(CHANGE, GAP)).cumsum())
    if (gain - np.minimum.accumulate(gain)).max() < enough:
        return None
    if np.isin(item, passage).mean() < least - 1e-9:  # nor than the words of it that are there
        return None
    score, end = alignment(item, passage)
    if score < enough:
        return None
    start = end - alignment(item[::-1], passage[:end][::-1])[1]
    return score / (MATCH * len(item)), start, end - 1


def _aligned(least: float):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, copies = [], []
            words: dict[int, np.ndarray] = {}
            columns = (batch.column(c).to_pylist() for c in ("item", "item_text", "low", "passage"))
            for row, (item, text, low, passage) in enumerate(zip(*columns, strict=True)):
                if item not in words:
                    words[item] = benchmark_words(text)
                found = copy_in(words[item], np.frombuffer(passage, np.uint64), least)
                if found:
                    rows.append(row)
                    copies.append((found[0], low + found[1], low + found[2]))
            score, first, last = zip(*copies, strict=True) if copies else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(pa.array(rows, pa.int64())) for c in ("content", "item", "item_id")),
                    pa.array(score, pa.float64()), pa.array(first, pa.int32()), pa.array(last, pa.int32()),
                ],
                names=["content", "item", "item_id", "score", "first_word", "last_word"],
            )

    return align


def content_of(text: Column) -> Column:
    """What tells texts apart: the digest of their bytes; a null text is empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def hits(
    docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE, text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The benchmark items that texts hold: content, item_id, score, first_word, last_word.

    ``content`` is that of :func:`content_of`; documents with one text share its rows. The score
    goes from ``least`` to 1, and the copy's words are counted from 0 over words of letters
    and digits. Case and punctuation do not matter. An item hits a text once, at its best copy,
    the first of equal ones. Items of fewer than three words or without text take no part;
    items repeated by id and text count once. A null or empty text has no hits, and neither
    have empty tables. Other columns play no part.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(content_of(F.col(text)).alias("content"), body.alias("text"))
    with Workspace(docs.sparkSession, "benchmark") as work:
        items = benchmark.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text")).distinct()
        items = work.table("items", items.withColumn("item", F.monotonically_increasing_id()))
        split = work.table("grams", items.select("item", "text").mapInArrow(_item_grams(least), _ITEM_GRAMS))
        short = not split.filter("needed < 1").isEmpty()

        # Rarity over documents: the most common n-grams are no seeds, as many as an item can spare.
        seen = source.select("text").mapInArrow(_counted(_sieve(split), short), "gram long, n long")
        seen = seen.groupBy("gram").agg(F.sum("n").alias("n"))
        ranked = split.join(seen, "gram", "left").withColumn(
            "place", F.expr("row_number() OVER (PARTITION BY item ORDER BY n DESC NULLS LAST, gram)")
        )
        seeds = ranked.filter("place > needed - seeds").select("item", "reach", "seeds", "gram").distinct()
        seeds = work.table("seeds", seeds)

        # Words that begin a seed, counted in stretches that overlap by half.
        places = source.mapInArrow(_found(_sieve(seeds), short), "content binary, gram long, place int")
        block = F.floor(F.col("place") / F.col("reach"))
        near = places.join(seeds, "gram").select(
            "content", "item", "reach", "seeds", F.explode(F.array(block - 1, block)).alias("stretch")
        )
        near = near.groupBy("content", "item", "reach", "seeds", "stretch").agg(F.count("*").alias("n"))
        near = near.filter("n >= seeds").groupBy("content", "item", "reach").agg(F.collect_list("stretch").alias("stretches"))
        near = near.groupBy("content").agg(F.collect_list(F.struct("item", "reach", "stretches")).alias("found"))
        near = work.table("near", near)

        # Hinted, so that the plan does not depend on how many documents are near an item.
        held = source.join(near.hint("merge"), "content").dropDuplicates(["content"])
        passages = held.mapInArrow(_passages, "content binary, item long, low int, passage binary")
        passages = work.table("passages", passages)
        asked = passages.join(items.withColumnRenamed("text", "item_text"), "item")
        copies = asked.mapInArrow(_aligned(least), f"content binary, item long, {HIT}")
        best = F.max_by(F.struct("item_id", "score", "first_word", "last_word"), F.struct("score", -F.col("first_word")))
        # Items of one id with different texts count as that id, at the best copy of any.
        copies = copies.groupBy("content", "item_id").agg(best.alias("hit"))
        return work.keep("hits", copies.select("content", "hit.*"))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id and a hit of :func:`hits` for every row of the documents and item that it holds."""
    found = hits(docs, benchmark, text=text, **options)
    ids = docs.select(F.col(key).cast("long").alias("doc_id"), content_of(F.col(text)).alias("content"))
    return ids.join(found.hint("merge"), "content").drop("content")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, that hold no copy of an item."""
    found = hits(docs, benchmark, text=text, **options).select(F.col("content").alias("__benchmark_content")).distinct()
    return docs.join(found, content_of(F.col(text)) == F.col("__benchmark_content"), "left_anti")
