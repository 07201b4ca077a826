"""Removal of repeated runs of lines, found by winnowing over line hashes.

A window starts at a line and takes as many lines as it needs for ``run_words`` words. The
smallest line hash of a window is its fingerprint (the last one of equal hashes), so two
places that share a window share a fingerprint, whatever stands around them. Only windows
whose fingerprint occurs at another place go on; most lines are dropped there. Positions of
the same window are joined to the first one, in order of document and line.

Matches extend both ways. To the left, and to the right as long as the next window matches at
any earlier place, the neighbouring windows do it. What may follow is a tail shorter than a
window that a run shares with some earlier place: the run with the first, the first two and
more of the lines before the next window's end is a candidate like a window and is joined the
same way. There are at most two candidates for a line, and all places of a run have the same.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanscope.llm.workspace import Workspace

#: Words of the shortest run that is sure to be found.
RUN_WORDS = 50
#: Rows that go on at once.
ROWS = 1 << 14

#: Columns of the join, named so as not to meet those of a table.
_ID, _VERSION, _GONE = "__line_dedup_id", "__line_dedup_version", "__line_dedup_gone"

WINDOWS = (
    "doc_id long, version long, start int, stop int, fingerprint long, place int, c1 long, c2 long"
)
_NAMES = [c.split(" ")[0] for c in WINDOWS.split(", ")]
_TYPES = [*(pa.int64(),) * 2, *(pa.int32(),) * 2, pa.int64(), pa.int32(), pa.int64(), pa.int64()]

#: Runs of lines are known by a polynomial of the lines' 128-bit digests modulo this prime.
_PRIME = (1 << 127) - 1
_BASE = 0x5DEECE66D1B54A32D192ED03A0761D65
_LOW = (1 << 64) - 1


def windows(text: str, run_words: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Start, stop, fingerprint and its line, and digest of each candidate run of lines.

    Candidates are the windows and, for each, the longer runs that end before the next
    window does. Lines are equal if their words are; white space around and between words
    is ignored. Takes time in proportion to the lines, also where many are empty.
    """
    lines = [line.split() for line in text.split("\n")]
    n = len(lines)
    before = np.cumsum([0, *map(len, lines)])  # words before each line
    if before[-1] < run_words:
        return
    digests = [xxhash.xxh3_128_intdigest(" ".join(words)) for words in lines]
    hashes = [(d >> 64) - (1 << 63) for d in digests]
    sums = list(accumulate(digests, lambda total, d: (total * _BASE + d) % _PRIME, initial=0))
    stops = np.searchsorted(before, before[:-1] + run_words).tolist()
    powers, least, added = [1], deque(), 0
    for start, stop in enumerate(stops):
        if stop > n:
            break
        while added < stop:  # lines of the window, each with a smaller hash than those before it
            while least and hashes[least[-1]] >= hashes[added]:
                least.pop()
            least.append(added)
            added += 1
        if least[0] < start:
            least.popleft()
        place = least[0]
        last = max(stop, min(stops[start + 1] - 1, n)) if start + 1 < n else stop
        for end in range(stop, last + 1):
            while len(powers) <= end - start:
                powers.append(powers[-1] * _BASE % _PRIME)
            content = (sums[end] - sums[start] * powers[end - start]) % _PRIME
            yield start, end, hashes[place], place, content >> 64, (content & _LOW) - (1 << 63)


def _find(run_words: int):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES
        )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for given in batches:
            columns = (given.column(c).to_pylist() for c in ("doc_id", "version", "text"))
            for doc_id, version, text in zip(*columns, strict=True):
                for window in windows(text, run_words):
                    rows.append((doc_id, version, *window))
                    if len(rows) >= ROWS:
                        yield batch(rows)
                        rows = []
        yield batch(rows)

    return find


def removed_lines(work: Workspace, rows: DataFrame, run_words: int) -> DataFrame:
    """Columns doc_id, version and gone, the runs of lines to remove as an array of disjoint
    start and stop in order; rows hold doc_id, version, text."""
    found = work.table("windows", rows.filter("doc_id IS NOT NULL").mapInArrow(_find(run_words), WINDOWS))
    # Two places differ in document or line.
    ends = (f(c).alias(f"{n}_{c}") for c in ("doc_id", "place") for n, f in (("min", F.min), ("max", F.max)))
    shared = (
        found.groupBy("fingerprint").agg(*ends)
        .filter("min_doc_id < max_doc_id OR min_place < max_place")
        .select("fingerprint")
    )
    met = work.table("met", found.join(shared, "fingerprint", "left_semi").drop("fingerprint", "place"))
    position = F.struct("doc_id", "start")
    firsts = met.groupBy("c1", "c2").agg(F.min(position).alias("first"), F.max(position).alias("last"))
    firsts = firsts.filter("first < last").drop("last")
    later = met.join(firsts, ["c1", "c2"]).filter(position > F.col("first"))
    # Runs that overlap or touch become one.
    own = Window.partitionBy("doc_id", "version").orderBy("start", "stop")
    reached = F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1))
    later = later.withColumn("begins", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    later = later.withColumn("run", F.sum("begins").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    runs = later.groupBy("doc_id", "version", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    gone = F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("gone")
    return runs.groupBy("doc_id", "version").agg(gone)


def without_repeats(
    docs: DataFrame, run_words: int = RUN_WORDS, key: str = "doc_id", text: str = "text",
    counts: bool = True, emptied: bool = True,
) -> DataFrame:
    """All columns of the input with repeated lines taken out of the text, and counts.

    A line is removed if it lies in a run of whole lines that has at least ``run_words`` words
    and also stands earlier: in a smaller doc_id, or further up in the same text. Places are
    judged on the input, not on what is left. New columns: ``lines`` (0 for a null
    text, else line feeds + 1), ``lines_removed``. A null text stays null; a text that loses
    all lines becomes empty. Rows without id stay as they are and are no earlier place.
    Repeated rows are one place and are treated alike. Rows of one id with different texts
    count as places of one document, of which the same line number is not earlier. Columns
    of the input named like the new ones are replaced. An empty table gives no row. Without
    ``counts`` there are no new columns; without ``emptied`` documents that lost all are left out.
    """
    spark = docs.sparkSession
    version = F.xxhash64(F.col(text))
    with Workspace(spark, "lines") as work:
        rows = docs.select(
            F.col(key).cast("long").alias("doc_id"), version.alias("version"), F.col(text).alias("text")
        )
        spans = removed_lines(work, rows.filter("text IS NOT NULL"), run_words)
        gone = spans.select(F.col("doc_id").alias(_ID), F.col("version").alias(_VERSION), F.col("gone").alias(_GONE))
        gone = work.keep("gone", gone)
    # Hinted, so that the plan does not depend on how much a table repeats.
    joined = docs.join(
        gone.hint("merge"), (F.col(key) == F.col(_ID)) & (version == F.col(_VERSION)), "left"
    )
    lines = F.split(F.col(text), "\n", -1)
    removed = F.aggregate(_GONE, F.lit(0), lambda n, run: n + run["stop"] - run["start"])
    if not emptied:
        joined = joined.filter(F.col(_GONE).isNull() | (F.size(lines) > removed))
    # What stands between the runs.
    starts = F.concat(F.array(F.lit(0)), F.transform(_GONE, lambda run: run["stop"]))
    stops = F.concat(F.transform(_GONE, lambda run: run["start"]), F.array(F.size(lines)))
    left = F.transform(
        F.arrays_zip(starts.alias("start"), stops.alias("stop")),
        lambda gap: F.slice(lines, gap["start"] + 1, gap["stop"] - gap["start"]),
    )
    kept = F.array_join(F.flatten(left), "\n")
    made = {text: F.when(F.col(_GONE).isNull(), F.col(text)).otherwise(kept)}
    if counts:
        made["lines"] = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines))
        made["lines_removed"] = F.coalesce(removed, F.lit(0))
    return joined.withColumns(made).drop(_ID, _VERSION, _GONE)
