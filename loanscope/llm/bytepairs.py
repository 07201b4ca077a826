"""Byte-level BPE by the ranks of a vocabulary file, and back to bytes.

A text is cut into matches of the splitting pattern. The bytes of a match are the leaves
of a segment tree: a leaf holds the rank of the pair that begins there together with its
place, an inner node the least of its two children, so the root names the leftmost pair
of least rank. A merge joins that pair and changes at most three leaves (the pair, the
part that went, and the neighbour before it), each in as many steps as the tree is high.

Short matches are merged many at a time, one tree in each row of an array; long ones one
after another. A worker remembers the ids of short matches that it has met, in bounded
number.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import public_tokenizers

#: Key of a pair that no token joins.
NONE = np.iinfo(np.int64).max
_PLACE = (1 << 32) - 1
#: Matches of more bytes have a tree of their own and are not remembered.
LONG = 256
#: Matches that a worker remembers.
REMEMBERED = 1 << 18
#: Characters of text that are cut at once, and matches of a longer text taken at once.
STRETCH = 1 << 20
MATCHES = 1 << 17
#: Leaves of the trees that are merged at once.
LEAVES = 1 << 19

#: Rows that go to the next step at once.
ROWS = 512

ENCODED = "doc_id long, ids binary"
DECODED = ENCODED + ", decoded binary"


class Splitter:
    """Cuts texts as the tokenizer library does.

    The two regular-expression engines may know different versions of Unicode. Where they
    disagree on the class of a character, a stand-in of the library's class is matched.
    """

    def __init__(self, pattern: str):
        self.source = pattern
        self.pattern = regex.compile(pattern)
        #: Versions differ only beyond the old alphabets.
        self.beyond = re.compile(r"[^\x00-ɏ]").search

    @functools.cached_property
    def stand_ins(self) -> dict[int, str]:
        mine = {k: regex.compile(p) for k, p in (("é", r"\p{L}"), ("1", r"\p{N}"), (" ", r"\s"))}
        codes = np.array([*range(0x250, 0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xE1000)])
        theirs = self._library_classes(codes)
        found = {}
        for code, kind in zip(codes.tolist(), theirs, strict=True):
            own = next((k for k, p in mine.items() if p.match(chr(code))), "%")
            if own != kind:
                found[code] = kind
        return found

    def _library_classes(self, codes: np.ndarray) -> list[str]:
        """A character of the same class for each code, as the library sees them.

        A letter, digit or other sign followed by the character is one match if both are of
        one class, and two matches if not; a vocabulary with that pair shows which.
        """
        import tiktoken

        kinds = np.full(len(codes), " ")
        units = [chr(c).encode() for c in codes.tolist()]
        place = np.concatenate([[0], np.cumsum([len(u) + 2 for u in units])[:-1]])
        for kind, first in (("é", b"a"), ("1", b"1"), ("%", b"%")):
            ranks = {bytes([b]): b for b in range(256)} | {first + bytes([b]): b + 256 for b in range(256)}
            library = tiktoken.Encoding(
                "classes", pat_str=self.source, mergeable_ranks=ranks, special_tokens={}
            )
            ids = library.encode_to_numpy(b"".join(first + u + b"\n" for u in units).decode())
            ends = np.cumsum(np.where(ids >= 256, 2, 1))
            kinds[np.isin(place, ends[ids >= 256] - 2)] = kind
        return kinds.tolist()

    def matches(self, text: str) -> Iterator[list[str]]:
        """The matches of the pattern in order, in lists of bounded length."""
        if self.beyond(text) and any(ord(c) in self.stand_ins for c in set(text)):
            found = self.pattern.finditer(text.translate(self.stand_ins))
            pieces = (text[m.start() : m.end()] for m in found)
        elif len(text) <= STRETCH:
            yield self.pattern.findall(text)
            return
        else:
            pieces = (m.group() for m in self.pattern.finditer(text))
        while some := list(islice(pieces, MATCHES)):
            yield some


class BytePairs:
    """Ids of texts by the ranks in a file of base64 tokens and ranks."""

    def __init__(self, path: str, pattern: str):
        self.rank = _read_ranks(path)
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = {
            self.rank[token[:cut]] << 32 | self.rank[token[cut:]]: rank
            for token, rank in self.rank.items()
            for cut in range(1, len(token))
            if token[:cut] in self.rank and token[cut:] in self.rank
        }
        self.pairs = np.array(sorted(pairs), np.int64)
        self.joined = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)
        self.splitter = Splitter(pattern)
        self.known: dict[str, bytes] = {}

    @staticmethod
    @functools.lru_cache(maxsize=2)  # a Python worker serves many tasks
    def load(path: str, pattern: str) -> BytePairs:
        return BytePairs(path, pattern)

    @functools.cached_property
    def _pair_of(self) -> dict[int, int]:
        return dict(zip(self.pairs.tolist(), self.joined.tolist(), strict=True))

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        waiting: list[list[str]] = []
        size = 0
        for text in texts:
            if len(text) > STRETCH:
                yield from self._ids(waiting)
                waiting, size = [], 0
                yield b"".join(ids for some in self.splitter.matches(text) for ids in self._ids([some]))
                continue
            waiting.append([piece for some in self.splitter.matches(text) for piece in some])
            size += len(text)
            if size > STRETCH:
                yield from self._ids(waiting)
                waiting, size = [], 0
        yield from self._ids(waiting)

    def _ids(self, lists: list[list[str]]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        fresh = list(set().union(*lists) - self.known.keys())
        body = [piece.encode() for piece in fresh]
        self.known.update(zip(fresh, self.merged(body), strict=True))
        made = [b"".join(map(self.known.__getitem__, pieces)) for pieces in lists]
        for piece, data in zip(fresh, body, strict=True):
            if len(data) > LONG:
                del self.known[piece]
        return made

    def merged(self, pieces: Sequence[bytes]) -> list[bytes]:
        """The ids of each match; one that is a token as it stands keeps that token's id."""
        made: list[bytes] = [b""] * len(pieces)
        heights: dict[int, list[int]] = {}
        for at, piece in enumerate(pieces):
            whole = self.rank.get(piece)
            if whole is not None:
                made[at] = whole.to_bytes(4, "little")
            elif len(piece) > LONG:
                made[at] = self._merge_long(piece)
            elif piece:
                heights.setdefault((len(piece) - 2).bit_length(), []).append(at)
        for height, places in heights.items():
            step = max(1, LEAVES >> height)
            for low in range(0, len(places), step):
                some = places[low : low + step]
                for at, ids in zip(some, self._merge_many([pieces[i] for i in some], 1 << height), strict=True):
                    made[at] = ids
        return made

    def _ranks(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Leaf keys of pairs: rank above, place below; a part of -1 makes no pair."""
        key = left << 32 | right & _PLACE
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        good = (self.pairs[at] == key) & (left >= 0) & (right >= 0)
        return np.where(good, self.joined[at] << 32 | place, NONE)

    def _merge_many(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Merges matches of at most ``width`` + 1 bytes, one tree of ``width`` leaves a row."""
        n = np.array([len(p) for p in pieces])
        shape = (len(pieces), width + 2)
        ids = np.full(shape, -1, np.int64)
        ids[np.arange(width + 2) < n[:, None]] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.broadcast_to(np.arange(1, width + 3), shape).copy()
        before = np.broadcast_to(np.arange(-1, width + 1), shape).copy()
        tree = np.full((len(pieces), 2 * width), NONE)
        tree[:, width:] = self._ranks(ids[:, :width], ids[:, 1 : width + 1], np.arange(width))
        high = width
        while high > 1:
            tree[:, high // 2 : high] = np.minimum(tree[:, high : 2 * high : 2], tree[:, high + 1 : 2 * high : 2])
            high //= 2
        row = np.flatnonzero(tree[:, 1] != NONE)
        while len(row):
            least = tree[row, 1]
            i, token = least & _PLACE, least >> 32
            j = after[row, i]
            k = after[row, j]
            p = before[row, i]
            ids[row, i], ids[row, j] = token, -1
            after[row, i], before[row, k] = k, i
            first = np.where(p >= 0, ids[row, np.maximum(p, 0)], -1)
            rows = np.concatenate([row, row, row])
            leaf = np.concatenate([np.maximum(p, 0), i, j])
            key = np.concatenate(
                [self._ranks(first, token, p), self._ranks(token, ids[row, k], i), np.full(len(row), NONE)]
            )
            real = (leaf < width) & np.concatenate([p >= 0, np.ones(2 * len(row), bool)])
            rows, node = rows[real], leaf[real] + width
            tree[rows, node] = key[real]
            for _ in range(width.bit_length() - 1):
                node >>= 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            row = row[tree[row, 1] != NONE]
        kept = ids >= 0
        flat = ids[kept].astype("<u4").tobytes()
        ends = np.concatenate([[0], np.cumsum(kept.sum(axis=1))]) * 4
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _merge_long(self, piece: bytes) -> bytes:
        """Merges one match with a tree of its own."""
        n, rank = len(piece), self._pair_of
        width = 1 << (n - 2).bit_length()
        start = self.byte[np.frombuffer(piece, np.uint8)]
        leaves = np.full(2 * width, NONE)
        leaves[width : width + n - 1] = self._ranks(start[:-1], start[1:], np.arange(n - 1))
        high = width
        while high > 1:
            leaves[high // 2 : high] = np.minimum(leaves[high : 2 * high : 2], leaves[high + 1 : 2 * high : 2])
            high //= 2
        ids, tree = array("q", start.tobytes() + b"\xff" * 8), array("q", leaves.tobytes())
        after = array("q", range(1, n + 2))
        before = array("q", range(-1, n))
        none = int(NONE)

        def put(leaf: int, left: int, right: int) -> None:
            token = rank.get(left << 32 | right) if left >= 0 and right >= 0 else None
            node = leaf + width
            tree[node] = none if token is None else token << 32 | leaf
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    return
                tree[node] = least
                node >>= 1

        while tree[1] != none:
            token, i = tree[1] >> 32, tree[1] & _PLACE
            j = after[i]
            k = after[j]
            ids[i], ids[j] = token, -1
            after[i], before[k] = k, i
            if j < width:
                put(j, -1, -1)
            put(i, token, ids[k])
            if i:
                put(before[i], ids[before[i]], token)
        merged = np.frombuffer(ids, np.int64)
        return merged[merged >= 0].astype("<u4").tobytes()


def _read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        lines = [line.split() for line in file if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class Decoder:
    """The bytes of ids."""

    def __init__(self, path: str):
        self.token = {rank: token for token, rank in _read_ranks(path).items()}

    @staticmethod
    @functools.lru_cache(maxsize=2)
    def load(path: str) -> Decoder:
        return Decoder(path)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for; an id without a token is an error."""
        numbers = np.frombuffer(ids, "<u4")
        blocks = range(0, len(numbers), STRETCH)
        return b"".join(b"".join(map(self.token.__getitem__, numbers[b : b + STRETCH].tolist())) for b in blocks)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            yield batch.slice(low, ROWS)


def encode(
    docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text",
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """One row per input row: doc_id, ids (binary, little-endian unsigned 32-bit integers).

    Special tokens take no part: their strings are ordinary text. A null text is empty and
    has no ids; an empty table gives no row. Repeated rows give repeated rows, null ids stay
    null, other columns are not read. Each row is encoded where it lies, without an exchange.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = BytePairs.load(ranks, pattern)
        for batch in _slices(batches):
            ids = coder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"]
            )

    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return rows.mapInArrow(encoded, ENCODED)


def decode(coded: DataFrame, ranks: str) -> DataFrame:
    """doc_id, ids and decoded (binary), the bytes that the ids stand for, for each input row.

    Null ids give null; an id that the file does not have is an error.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder.load(ranks)
        for batch in _slices(batches):
            said = [None if v is None else decoder.decode(v) for v in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(said, pa.binary())],
                names=["doc_id", "ids", "decoded"],
            )

    return coded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(decoded, DECODED)
