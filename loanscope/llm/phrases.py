"""Phrases that occur more often than their parts suggest, by vertically partitioned suffixes.

Counts of phrases are read from suffix trees that go as deep as the longest phrase. The trees
are never built as a whole: prefixes are sorted into groups that fit in memory, and each group
builds its own subtrees.

* Words are counted first. A phrase that is frequent enough has only words that are, so a
  suffix ends at a word that is not. A bitmap of fixed size tells them apart; where it errs, a
  suffix is longer than it must be and the count decides.
* A prefix is one word unless that is too frequent for a group; then it is two words, or three,
  or all. Prefixes are weighed by classes of their hash, of which there is a fixed number, and
  classes are put together to groups by weight.
* A task cuts its texts into suffixes, adds up equal ones, and sends them in blocks to their
  groups. A group sorts its suffixes, so that every node of its subtrees is a run of them, and
  adds up each run. Prefixes shorter than the one that a suffix was sent by lie in several
  groups, whose counts are added.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanscope.llm.shingles import mixed
from loanscope.llm.workspace import Workspace

MOST_WORDS = 4
#: Suffixes of a group.
MEMORY = 1 << 20
#: Classes of prefixes, as a power of two: from a few to a table of 8 MB.
FEWEST_CLASSES, MOST_CLASSES = 12, 20
#: Bits of the bitmap of frequent words, as a power of two.
SIEVE = 22
#: Bytes of text that are cut into words at once.
SPAN = 1 << 22
#: Suffixes, and words, that a task holds before it sends them.
BUFFER, VOCABULARY = 1 << 21, 1 << 19
#: Seed of Spark's xxhash64.
SEED = 42

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Letters to lower case, ends of pieces to a line feed, white space inside them to a space.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\v\f\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_GAP = re.compile(rb"[ \n]")


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """Plain text by language in parts of bounded size, each text ended by a line feed.

    A longer text comes in several parts, cut behind a space or line feed, one after another.
    """
    langs, texts = batch.column("lang"), batch.column("text")
    for lang in langs.unique().to_pylist():
        held, size = [], 0
        for text in texts.filter(pc.equal(langs, lang)).to_pylist():
            data = text.encode().translate(_PLAIN) + b"\n"
            if size + len(data) > SPAN and held:
                yield lang, b"".join(held)
                held, size = [], 0
            while len(data) > SPAN:
                gap = _GAP.search(data, SPAN - 1)
                cut = gap.end() if gap else len(data)
                yield lang, data[:cut]
                data = data[cut:]
            held.append(data)
            size += len(data)
        if size:
            yield lang, b"".join(held)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, data in _parts(batch):
            counts.setdefault(lang, Counter()).update(data.split())
            if sum(map(len, counts.values())) > VOCABULARY:
                yield _counted(counts)
                counts = {}
        yield _counted(counts)


def _counted(counts: dict[str, Counter]) -> pa.RecordBatch:
    rows = [(lang, word, n) for lang, words in counts.items() for word, n in words.items()]
    lang, word, n = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())], names=["lang", "word", "n"]
    )


@dataclass
class Partition:
    """How suffixes are sent: which words are frequent, and the group of each prefix class.

    ``groups[k]`` has the group of every class of prefixes of k + 1 words, or -1 for classes that
    are too heavy, whose prefixes go on. Whole suffixes share the last ``rest`` groups.
    """

    sieve: np.ndarray
    bits: int
    groups: list[np.ndarray] = field(default_factory=list)
    rest: int = 1

    def classes(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    @property
    def first_rest(self) -> int:
        return max((int(g.max()) for g in self.groups), default=-1) + 1

    def add_level(self, weights: np.ndarray, memory: int) -> bool:
        """Groups for the classes of the next longer prefixes; whether some are too heavy."""
        heavy = weights > memory
        order = np.argsort(-weights, kind="stable")
        order = order[~heavy[order] & (weights[order] > 0)]
        group = np.zeros(len(weights), np.int32)  # a class without weight is never asked for
        group[order] = (np.cumsum(weights[order]) - weights[order]) // memory
        group += self.first_rest
        group[heavy] = -1
        self.groups.append(group)
        self.rest = max(1, -int(-weights[heavy].sum() // memory))
        return bool(heavy.any())


class Vocabulary:
    """Numbers, hashes and frequency of the words of one language that a task has met."""

    def __init__(self, lang: str, sieve: np.ndarray):
        self.salt, self.sieve = lang.encode() + b"\n", sieve
        self.number = {b"": -1, b"\n": 0}
        self.words = [b""]
        self.hashes, self.frequent = np.zeros(1, np.uint64), np.zeros(1, bool)

    def numbers(self, data: bytes) -> np.ndarray:
        """Numbers of the words of plain text, 0 for ends of pieces and for rare words."""
        said = data.replace(b"\n", b" \n ").split(b" ")
        fresh = list(set(said) - self.number.keys())
        if fresh:
            self.number.update(zip(fresh, range(len(self.words), len(self.words) + len(fresh)), strict=True))
            self.words += fresh
            hashes = np.fromiter((xxhash.xxh64_intdigest(self.salt + w, SEED) for w in fresh), np.uint64, len(fresh))
            bucket = (hashes & np.uint64((1 << SIEVE) - 1)).astype(np.int64)
            frequent = (self.sieve[bucket >> 6] >> (bucket & 63).astype(np.uint64)) & np.uint64(1)
            self.hashes = np.concatenate([self.hashes, hashes])
            self.frequent = np.concatenate([self.frequent, frequent.astype(bool)])
        found = np.fromiter(map(self.number.__getitem__, said), np.int32, len(said))
        found = found[found >= 0]
        return np.where(self.frequent[found], found, 0).astype(np.int32)


class Suffixes:
    """Cuts the texts of a task into suffixes of at most ``MOST_WORDS`` frequent words."""

    def __init__(self, partition: Partition):
        self.partition = partition
        self.vocabularies: dict[str, Vocabulary] = {}

    def of(self, batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
        """Suffixes of two words or more, as rows of word numbers with 0 after the end.

        The last words of a part wait for the next one, which may go on with the same piece.
        """
        tail, last = np.zeros(0, np.int32), None
        for lang, data in _parts(batch):
            if lang not in self.vocabularies:
                self.vocabularies[lang] = Vocabulary(lang, self.partition.sieve)
            if lang != last:
                tail, last = np.zeros(0, np.int32), lang
            words = np.concatenate([tail, self.vocabularies[lang].numbers(data)])
            ended = data.endswith(b"\n")
            ahead = MOST_WORDS - 1
            padded = np.concatenate([words, np.zeros(ahead, np.int32)]) if ended else words
            tail = words[:0] if ended else words[max(0, len(words) - ahead) :]
            n = len(padded) - ahead
            if n <= 0:
                continue
            some = np.lib.stride_tricks.sliding_window_view(padded, MOST_WORDS)
            some = some[(some[:, 0] > 0) & (some[:, 1] > 0)]  # a copy
            for k in range(2, MOST_WORDS):
                some[:, k][some[:, k - 1] == 0] = 0
            yield lang, some

    def prefixes(self, lang: str, some: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, rows, classes of their prefixes of k words) for the rows whose prefix is that long
        or longer, as far as the partition has groups, and one length beyond."""
        hashes = self.vocabularies[lang].hashes
        rows, total = np.arange(len(some)), hashes[some[:, 0]]
        for k in range(1, MOST_WORDS + 1):
            kind = self.partition.classes(total)
            yield k, rows, kind
            if k > len(self.partition.groups) or k == MOST_WORDS:
                return
            longer = (self.partition.groups[k - 1][kind] < 0) & (some[rows, k] > 0)
            rows, total = rows[longer], total[longer]
            total = mixed(total * _BASE + hashes[some[rows, k]])


def _runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts rows of numbers, and where runs of equal ones begin in it."""
    keys, used = [], 64
    for column in rows.T:
        bits = int(column.max()).bit_length()
        if used + bits > 63:
            keys.append(column.astype(np.int64))
            used = bits
        else:
            keys[-1] = keys[-1] << bits | column
            used += bits
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.ones(len(rows), bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    return order, np.flatnonzero(new)


def _weigh(partition: Partition, level: int):
    """Rows of each class of prefixes of ``level`` words that must be that long."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes, weights = Suffixes(partition), np.zeros(1 << partition.bits, np.int64)
        for batch in batches:
            for lang, some in suffixes.of(batch):
                for k, _, kind in suffixes.prefixes(lang, some):
                    if k == level:
                        weights += np.bincount(kind, minlength=len(weights))
            if sum(len(v.words) for v in suffixes.vocabularies.values()) > VOCABULARY:
                suffixes.vocabularies.clear()
        held = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(weights[held])], names=["class", "n"])

    return weigh


_SENT = "group int, lang string, n int, words binary, suffixes binary, counts binary, lengths binary"


def _send(partition: Partition):
    """Blocks of suffixes by group: the block's words, rows of their numbers, counts, and the
    length of the prefix by which each was sent."""

    def placed(suffixes: Suffixes, lang: str, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        group, length = np.empty(len(some), np.int32), np.empty(len(some), np.int8)
        for k, rows, kind in suffixes.prefixes(lang, some):
            known = partition.groups[k - 1][kind] if k <= len(partition.groups) else np.full(len(rows), -1)
            group[rows] = np.where(known < 0, partition.first_rest + kind % partition.rest, known)
            length[rows] = np.where(known < 0, MOST_WORDS, k)
        return group, length

    def blocks(vocabulary: Vocabulary, lang: str, held: list) -> Iterator[dict]:
        some, group, length = (np.concatenate(x) for x in zip(*held, strict=True))
        order, new = _runs(np.column_stack([group, some]))
        counts = np.diff([*new, len(order)])
        order = order[new]
        some, group, length = some[order], group[order], length[order]
        cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        local = np.zeros(len(vocabulary.words), np.int64)
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(group)], strict=True):
            rows = some[a:b]
            if rows.size * 16 > len(local):
                used = np.zeros(len(local), bool)
                used[rows] = True
                used[0] = True
                used = np.flatnonzero(used)
            else:
                used = np.union1d(rows, [0])
            local[used] = np.arange(len(used))
            kind = "<u2" if len(used) <= 1 << 16 else "<u4"
            yield {
                "group": int(group[a]), "lang": lang, "n": b - a,
                "words": b"\n".join([vocabulary.words[i] for i in used[1:].tolist()]),
                "suffixes": local[rows].astype(kind).tobytes(),
                "counts": counts[a:b].astype("<i8").tobytes(), "lengths": length[a:b].tobytes(),
            }

    def made(rows: list[dict]) -> pa.RecordBatch:
        schema = pa.schema([
            ("group", pa.int32()), ("lang", pa.string()), ("n", pa.int32()),
            *((c, pa.binary()) for c in ("words", "suffixes", "counts", "lengths")),
        ])
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes, held = Suffixes(partition), {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                rows, size = [], 0
                for block in blocks(suffixes.vocabularies[lang], lang, parts):
                    rows.append(block)
                    size += len(block["suffixes"])
                    if size > SPAN:
                        yield made(rows)
                        rows, size = [], 0
                yield made(rows)
            held.clear()

        for batch in batches:
            for lang, some in suffixes.of(batch):
                if len(some):
                    held.setdefault(lang, []).append((some, *placed(suffixes, lang, some)))
                if sum(len(part[0]) for parts in held.values() for part in parts) > BUFFER:
                    yield from flushed()
            if sum(len(v.words) for v in suffixes.vocabularies.values()) > VOCABULARY:
                yield from flushed()
                suffixes.vocabularies.clear()
        yield from flushed()

    return send


def _subtrees(blocks: list[dict], least: int) -> Iterator[tuple[bytes, int, int]]:
    """Phrases of two words or more in one group: (phrase, words, occurrences in this group).

    Suffixes are sorted by words, so that a node of the subtrees is a run of suffixes and its
    count the total over the run. Nodes are left out if the group has them whole and too rare.
    """
    number: dict[bytes, int] = {}
    parts = []
    for block in blocks:
        words = block["words"].split(b"\n")
        own = np.zeros(len(words) + 1, np.int64)
        own[1:] = [number.setdefault(w, len(number) + 1) for w in words]
        kind = "<u2" if len(own) <= 1 << 16 else "<u4"
        parts.append(own[np.frombuffer(block["suffixes"], kind)].reshape(-1, MOST_WORDS))
    rows = np.concatenate(parts)
    counts = np.concatenate([np.frombuffer(b["counts"], "<i8") for b in blocks])
    lengths = np.concatenate([np.frombuffer(b["lengths"], np.int8) for b in blocks])
    order, _ = _runs(rows)
    rows, counts, lengths = rows[order], counts[order], lengths[order]
    words = [b"", *number]
    new = np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]])
    for k in range(1, MOST_WORDS):
        new[1:] |= rows[1:, k] != rows[:-1, k]
        start = np.flatnonzero(new)
        total = np.add.reduceat(counts, start)
        told = (rows[start, k] > 0) & ((total >= least) | (lengths[start] > k + 1))
        for row, n in zip(rows[start[told], : k + 1].tolist(), total[told].tolist(), strict=True):
            yield b" ".join([words[i] for i in row]), k + 1, n


def _count_groups(least: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(lang: str, held: list[dict]) -> pa.RecordBatch:
            rows = list(_subtrees(held, least))
            phrase, size, n = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(rows), pa.string()), pa.array(phrase, pa.string()), pa.array(size, pa.int32()), pa.array(n, pa.int64())],
                names=["lang", "phrase", "words", "n"],
            )

        last, held = None, []
        for batch in batches:
            for block in batch.to_pylist():
                at = (block["group"], block["lang"])
                if at != last and held:
                    yield counted(last[1], held)
                    held = []
                last = at
                held.append(block)
        if held:
            yield counted(last[1], held)

    return count


def _exact(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def phrase_counts(work: Workspace, docs: DataFrame, least: int, memory: int = MEMORY) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``MOST_WORDS`` words with ``least`` occurrences or more (lang, phrase,
    words, n), and the number of word occurrences of each language (lang, n)."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = rows.mapInArrow(_count_words, "lang string, word string, n long")
    words = work.table("words", words.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    totals = work.table("totals", words.groupBy("lang").agg(F.sum("n").alias("n")))
    common = words.filter(F.col("n") >= least)

    size = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(max(FEWEST_CLASSES, (4 * size // memory).bit_length()), MOST_CLASSES)
    hashed = common.withColumn("hash", F.xxhash64(F.concat("lang", F.lit("\n"), "word")))
    bucket = F.col("hash").bitwiseAND(F.lit((1 << SIEVE) - 1))
    sieve = np.zeros(1 << (SIEVE - 6), np.uint64)
    mask = F.expr("bit_or(shiftleft(1L, CAST(bucket & 63 AS INT)))").alias("mask")
    marks = hashed.select(bucket.alias("bucket")).groupBy(F.shiftright("bucket", 6).alias("at")).agg(mask).toPandas()
    sieve[marks["at"].to_numpy(np.int64)] = marks["mask"].to_numpy(np.int64).view(np.uint64)

    def weights(found: DataFrame) -> np.ndarray:
        column = np.zeros(1 << bits, np.int64)
        told = found.groupBy("class").agg(F.sum("n").alias("n")).toPandas()
        column[told["class"].to_numpy(np.int64)] = told["n"].to_numpy(np.int64)
        return column

    partition = Partition(sieve, bits)
    heavy = partition.add_level(weights(hashed.select(F.shiftrightunsigned("hash", 64 - bits).alias("class"), "n")), memory)
    while heavy and len(partition.groups) < MOST_WORDS - 1:
        level = len(partition.groups) + 1
        heavy = partition.add_level(weights(rows.mapInArrow(_weigh(partition, level), "class long, n long")), memory)

    sent = rows.mapInArrow(_send(partition), _SENT)
    groups = sent.repartition("group").sortWithinPartitions("group", "lang")
    counted = groups.mapInArrow(_count_groups(least), "lang string, phrase string, words int, n long")
    counted = counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    single = common.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n")
    return work.table("phrases", single.unionByName(counted)), totals


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2000, scale: int = 2_000_000, covered: int = 80, memory: int = MEMORY
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A to Z) and cut into pieces at ``.,;:!?`` and line ends, pieces into
    words at spaces and tabs. Candidates have 2 to 4 words and ``least`` occurrences or more.
    The score is floor(scale * a / (l + r)) at the cut where that is least, of equal ones the
    first. A candidate goes if a longer one contains it and has ``covered`` percent of its
    occurrences. Ranks are by score, then occurrences, then phrase in byte order.

    A null text is empty, a null lang is ``und``. Repeated rows count as often as they stand;
    other columns are not read. An empty table gives no row.
    """
    with Workspace(docs.sparkSession, "phrases") as work:
        phrases, totals = phrase_counts(work, docs, least, memory)
        candidates = phrases.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
        said = F.split("phrase", " ")
        part = lambda start, length: F.array_join(F.slice(said, start, length), " ")
        cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
        cuts = cuts.select(
            "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"),
            part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"),
        )
        counts = lambda name, n: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
        cuts = cuts.join(counts("first", "l"), ["lang", "first"]).join(counts("rest", "r"), ["lang", "rest"])
        both = (_exact(F.col("l")) + _exact(F.col("r"))).alias("both")
        cuts = cuts.select("*", both, (F.lit(scale).cast("decimal(10,0)") * _exact(F.col("a"))).alias("scaled"))
        cuts = cuts.withColumn("score", F.expr("scaled div both"))
        best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))

        inner = F.flatten(F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: part(at, size)),
        ))
        longer = candidates.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), "a")
        longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("within"))
        hundred = lambda c, x: F.lit(x).cast("decimal(3,0)") * _exact(F.coalesce(F.col(c), F.lit(0)))
        kept = best.select("lang", "phrase", "cut.*").join(longer, ["lang", "phrase"], "left")
        kept = kept.filter(F.col("within").isNull() | (hundred("within", 100) < hundred("a", covered)))
        window = "row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)"
        ranked = kept.withColumn("rank", F.expr(window)).filter(F.col("rank") <= top)
        made = ranked.join(totals, "lang")
        return work.keep("result", made.select(
            "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
        ))
