"""Removal of byte strings that also start in an earlier document, by suffix arrays.

Every byte string of the given length has an anchor: the smallest hash of the short grams
in it (the first of equal ones). Equal strings have equal anchors at the same place, so
only documents that share an anchor can share a string. Neighbouring strings with one
anchor form a fragment.

1. Each task names its fragments by anchor and content, once per distinct fragment; other
   documents of the task with the same fragment are answered on the spot.
2. Anchors are dealt into buckets. There a fragment with the same content in an earlier
   document is known to be repeated as a whole. Of an anchor with several contents, the
   earliest document of each content is asked for the bytes. An anchor with very many contents
   (as at the edge of a passage that stands in many documents) is not kept together: its
   strings go to buckets by their own hash, each once for the documents of a task.
3. The fragments sent are put together, anchor by anchor, as far as another one of the anchor
   agrees around it. What is left equal of several is taken once, for the earliest of their
   documents, and the suffixes are sorted by linear grouping (suffixes.py). Suffixes next to each
   other that agree in the whole length are one string; a document later than the earliest one
   with that string loses it.
4. Documents get their repeated strings back and drop the bytes that these cover.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.llm.shingles import mixed, powers
from loanscope.llm.suffixes import suffix_array
from loanscope.llm.workspace import Workspace

#: Bytes of a string.
LENGTH = 50
#: Bytes of the grams of which one is the anchor. Shorter ones agree by chance more often,
#: longer ones give more anchors.
GRAM = 20
#: Text bytes whose anchors meet in one bucket.
BUCKET_BYTES = 16 << 20
#: Contents of an anchor that meet as fragments; of anchors with more the strings meet one by one.
CONTENTS = 1 << 16
#: Text bytes that are hashed at once, and bytes from which a suffix array is made.
SPAN, SORTED = 1 << 20, 1 << 13
#: Fragments whose surroundings are compared at once.
COMPARED = 1 << 16
#: Low bits of a key that hold a place.
_PLACE = np.uint64((1 << 24) - 1)
_RULE = np.random.Generator(np.random.PCG64(4242))
_BYTE = _RULE.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all grams of a size, from those of half the size."""
    level, width, factor = _BYTE[data], 1, 0x9E3779B97F4A7C15
    total, done = None, 0
    while True:
        if size & width:
            if total is None:
                total = level
            else:
                n = len(level) - done
                total = total[:n] * np.uint64(factor) + level[done:]
            done += width
        if 2 * width > size:
            return mixed(total)
        level = level[:-width] * np.uint64(factor) + level[width:]
        factor = factor * factor % (1 << 64)
        width *= 2


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` neighbouring values."""
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Fragments:
    """Fragments of a stretch of bytes: first string, number of strings, anchor, content."""

    start: np.ndarray
    count: np.ndarray
    lead: np.ndarray  # bytes from the first string to the anchor
    anchor: np.ndarray
    content: np.ndarray


def fragments(data: np.ndarray, ends: np.ndarray, length: int) -> Fragments:
    """Fragments of documents put together; ``ends`` are the places where they end."""
    n = len(data) - length + 1
    gram = min(GRAM, length)
    if n < 1:
        none = np.zeros(0, np.int64)
        return Fragments(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    hashes = gram_hashes(data, gram)
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    owner = (window_minima(keys, length - gram + 1) & _PLACE).astype(np.int64)
    # Strings that would reach into the next document have no owner.
    inside = np.ones(n, bool)
    for end in ends:
        inside[max(0, end - length + 1) : end] = False
    owner[~inside] = -1
    edge = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
    start, stop = edge[:-1], edge[1:]
    real = owner[start] >= 0
    start, stop = start[real], stop[real]
    lead = owner[start] - start
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    content = (sums[stop + length - 1] - sums[start]) * down[start]
    content = mixed(content + mixed((lead * 64 + stop - start).astype(np.uint64)))
    return Fragments(start, stop - start, lead, hashes[owner[start]], content)


def stretches(texts: list[bytes], length: int) -> Iterator[tuple[list[tuple[int, int, int]], np.ndarray]]:
    """Bytes to work on at once: (document, its offset, length) of each part, and the bytes.

    Short documents are put together; long ones are cut, each part with the bytes that its
    last strings need.
    """
    parts: list[tuple[int, int, int]] = []
    pieces: list[bytes] = []
    size = 0
    for number, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), SPAN):
            piece = text[at : at + SPAN + length - 1]
            if size + len(piece) > SPAN and parts:
                yield parts, np.frombuffer(b"".join(pieces), np.uint8)
                parts, pieces, size = [], [], 0
            parts.append((number, at, len(piece)))
            pieces.append(piece)
            size += len(piece)
    if parts:
        yield parts, np.frombuffer(b"".join(pieces), np.uint8)


@dataclass
class Named:
    """Fragments of a batch of documents, in order of document and place."""

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    lead: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def named(texts: list[bytes], length: int) -> Named:
    columns: list[tuple] = []
    for parts, data in stretches(texts, length):
        sizes = np.array([p[2] for p in parts])
        ends = sizes.cumsum()
        found = fragments(data, ends, length)
        part = np.searchsorted(ends, found.start, side="right")
        shift = np.array([p[1] for p in parts]) - (ends - sizes)
        doc = np.array([p[0] for p in parts])
        columns.append(
            (doc[part], found.start + shift[part], found.count, found.lead, found.anchor, found.content)
        )
    if not columns:
        none = np.zeros(0, np.int64)
        columns = [(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))]
    return Named(*(np.concatenate(c) for c in zip(*columns, strict=True)))


def _batches(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[list, list[bytes]]]:
    """Rows of bounded total size: columns by name, and the texts as bytes."""
    for batch in batches:
        columns = [batch.column(n) for n in names]
        texts = batch.column("text").cast(pa.binary())
        rows, size, first = [], 0, 0
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            rows.append(text)
            size += len(text)
            if size > 6 * SPAN:
                yield [c.slice(first, len(rows)) for c in columns], rows
                rows, size, first = [], 0, i + 1
        if rows:
            yield [c.slice(first, len(rows)) for c in columns], rows


def _column(values: np.ndarray, ends: np.ndarray, width: int = 0) -> pa.Array:
    """A binary column of which each row has the values up to its end."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * (width or values.itemsize)
    if offsets[-1] > 0x7FFFFFFF:
        raise ValueError("more than 2 GB of values in a batch")
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(ends), buffers)


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    """The values of all rows of a binary column."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _ends(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal neighbours end."""
    return np.flatnonzero(np.append(keys[1:] != keys[:-1], True)) + 1 if len(keys) else np.zeros(0, np.int64)


# -- step 1: names ------------------------------------------------------------------

#: Of documents only the low bits of the version go along. Answers hold for all versions of a document, so
#: they may as well meet.
_TAG = (1 << 16) - 1
_NAMES = pa.schema(
    [
        ("bucket", pa.int32()),  # -1: answers, for the documents themselves
        ("doc_id", pa.binary()), ("tag", pa.binary()),
        ("owned", pa.binary()),  # per document, its number of fragments here
        ("anchor", pa.binary()), ("content", pa.binary()),
    ]
)
NAMES = "bucket int, doc_id binary, tag binary, owned binary, anchor binary, content binary"


def _name(length: int, buckets: int):
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids, versions), texts in _batches(batches, ["doc_id", "version"]):
            by_id = np.argsort(ids.to_numpy(), kind="stable")
            ids, tags = ids.to_numpy()[by_id], (versions.to_numpy()[by_id] & _TAG).astype(np.uint16)
            found = named([texts[i] for i in by_id.tolist()], length)
            if not len(found.doc):
                continue
            # Distinct contents, each once for a document and with its smallest document first.
            order = np.argsort(found.content)
            ends = _ends(found.content[order])
            rank = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            pairs = np.sort(rank << 32 | found.doc[order])
            pairs = pairs[_ends(pairs) - 1]
            rank, doc = pairs >> 32, pairs & 0xFFFFFFFF
            own = order[ends - 1]  # equal contents have equal anchors
            content, anchor = found.content[own], found.anchor[own]
            leader = doc[np.searchsorted(rank, np.arange(len(ends)))]
            bucket = ((anchor >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)[rank]
            bucket[ids[doc] > ids[leader][rank]] = -1
            order = np.argsort((bucket + 1) << 32 | doc, kind="stable")
            bucket, doc, rank = bucket[order], doc[order], rank[order]
            owners = _ends(bucket * len(ids) + doc)
            used, rows = doc[owners - 1], _ends(bucket)
            docs = np.searchsorted(owners, rows, side="right")
            low = anchor[rank].view(np.uint8).reshape(-1, 8)[:, :5]  # of a bucket, 40 bits tell
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[rows - 1], pa.int32()), _column(ids[used], docs), _column(tags[used], docs),
                    _column(np.diff(owners, prepend=0).astype(np.uint32), docs),
                    _column(low, rows, 5), _column(content[rank], rows),
                ],
                schema=_NAMES,
            )

    return name


# -- step 2: buckets ----------------------------------------------------------------

#: What a bucket answers to a document about a content: that it is ``KNOWN`` to be repeated as a whole, or
#: ``ASKED`` for, to be sent to the anchor's bucket, or ``SPREAD``, to be sent string by string to the buckets
#: of the strings, because the anchor has too many contents.
KNOWN, ASKED, SPREAD = 1, 2, 3
#: Answers of a bucket to part of the documents, packed; ``owned`` counts contents per document.
PACKED = "part int, doc_id binary, tag binary, owned binary, kind binary, content binary"
ANSWERS = "doc_id long, tag int, kind binary, content binary"


def _unpacked(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Document ids, tags, and the owner, anchor and content of each fragment."""
    owned = _joined(table, "owned", np.uint32)
    low = _joined(table, "anchor", np.uint8).reshape(-1, 5)
    anchor = np.zeros((len(low), 8), np.uint8)
    anchor[:, :5] = low
    return (
        _joined(table, "doc_id", np.int64), _joined(table, "tag", np.uint16), np.repeat(np.arange(len(owned)), owned),
        anchor.view(np.uint64).ravel(), _joined(table, "content", np.uint64),
    )


def _packed(ids, tags, owner, content, kind, parts: int) -> pa.Table:
    """Answers from kinds (0 for none) of fragments; owners are documents."""
    part_of = (mixed(ids.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    at = np.flatnonzero(kind)
    key = part_of[owner[at]] << 32 | owner[at]
    order = np.argsort(key)
    key, at = key[order], at[order]
    owners, rows = _ends(key), _ends(key >> 32)
    used = key[owners - 1] & 0xFFFFFFFF
    docs = np.searchsorted(owners, rows, side="right")
    return pa.table(
        {
            "part": pa.array(key[rows - 1] >> 32, pa.int32()), "doc_id": _column(ids[used], docs), "tag": _column(tags[used], docs),
            "owned": _column(np.diff(owners, prepend=0).astype(np.uint32), docs),
            "kind": _column(kind[at], rows), "content": _column(content[at], rows),
        }
    )


def _merge(table: pa.Table) -> pa.Table:
    """One row per document from the packed answers to a part of the documents."""
    ids, tags = _joined(table, "doc_id", np.int64), _joined(table, "tag", np.uint16).astype(np.int32)
    order = np.lexsort((tags, ids))
    ids, tags = ids[order], tags[order]
    fresh = np.concatenate([[True], (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])])
    number = np.empty(len(order), np.int64)  # of the document of each packed entry
    number[order] = np.cumsum(fresh) - 1
    owner = np.repeat(number, _joined(table, "owned", np.uint32))
    by_owner = np.argsort(owner, kind="stable")
    ends = np.bincount(owner, minlength=int(fresh.sum())).cumsum()
    return pa.table(
        {
            "doc_id": pa.array(ids[fresh]), "tag": pa.array(tags[fresh]),
            "kind": _column(_joined(table, "kind", np.uint8)[by_owner], ends),
            "content": _column(_joined(table, "content", np.uint64)[by_owner], ends),
        }
    )


def _resolve(parts: int):
    def resolve(table: pa.Table) -> pa.Table:
        ids, tags, owner, anchor, content = _unpacked(table)
        kind = np.full(len(owner), KNOWN, np.uint8)
        if table.column("bucket")[0].as_py() < 0:  # answered in step 1
            return _packed(ids, tags, owner, content, kind, parts)
        # Contents with their first and last documents, then anchors with their contents.
        order = np.argsort(content)
        doc, ends = ids[owner[order]], _ends(content[order])
        first = np.concatenate([[0], ends[:-1]])
        leader, last = np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)
        of_content = anchor[order[first]]
        by_anchor = np.argsort(of_content)
        ends_ = _ends(of_content[by_anchor])
        first_, contents = np.concatenate([[0], ends_[:-1]]), np.diff(ends_, prepend=0)
        low, high = np.minimum.reduceat(leader[by_anchor], first_), np.maximum.reduceat(last[by_anchor], first_)
        told = np.where(contents > CONTENTS, SPREAD, ASKED) * ((contents > 1) & (low < high))
        asked = np.empty(len(ends), np.uint8)
        asked[by_anchor] = np.repeat(told, contents)
        many = np.diff(ends, prepend=0)
        kind[order] = np.where(doc > np.repeat(leader, many), KNOWN, np.repeat(asked, many))
        return _packed(ids, tags, owner, content, kind, parts)

    return resolve


# -- step 3: fragments and suffix arrays ----------------------------------------------

#: What documents of a batch send to a bucket. ``owned`` counts the contents of each document (``docs``, ``versions``).
#: A content is sent once with all its places in the document: ``places`` counts them, ``start`` has them.
#: Bucket -1 is for what a document (``doc_id``, ``version``) knows already, runs of bytes in ``start``.
_SENT = pa.schema(
    [
        ("bucket", pa.int32()), ("doc_id", pa.int64()), ("version", pa.int64()), ("start", pa.binary()),
        ("docs", pa.binary()), ("versions", pa.binary()), ("owned", pa.binary()), ("places", pa.binary()),
        ("lead", pa.binary()), ("count", pa.binary()), ("anchor", pa.binary()), ("bytes", pa.binary()),
    ]
)
SENT = ", ".join(f"{f.name} {({'int32': 'int', 'int64': 'long'}.get(str(f.type), 'binary'))}" for f in _SENT)
RUNS = "doc_id long, version long, runs binary"


def joined_runs(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Overlapping or touching intervals merged, as rows of start and stop."""
    if not len(start):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    fresh = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1]]))
    return np.stack([start[fresh], stop[np.concatenate([fresh[1:] - 1, [len(stop) - 1]])]], axis=1)


def _runs_of(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The owners of intervals, and for each its intervals merged."""
    shift = owner.astype(np.int64) << 33  # no text is as long
    runs = joined_runs(shift + start, shift + stop)
    whose = runs[:, 0] >> 33
    ends = _ends(whose)
    return whose[ends - 1], _column((runs & ((1 << 33) - 1)).astype(np.uint32), ends, 8)


def _strings(
    texts: list[bytes], ids: np.ndarray, found: Named, spread: np.ndarray, length: int
) -> tuple[list[tuple[int, int]], list[tuple[int, bytes, int, int, list[int]]]]:
    """The strings of the fragments that are spread, for documents of a batch.

    First, as document and start, the strings that an earlier document of the batch has too;
    second, the others as document, string, lead, anchor and starts. So of a string that very many
    documents have, a batch sends on only that of its first document.
    """
    holders: dict[bytes, dict[int, list]] = {}
    columns = (c[spread].tolist() for c in (found.doc, found.start, found.lead, found.anchor, found.count))
    for i, start, lead, anchor, count in zip(*columns, strict=True):
        for nth in range(count):
            string = texts[i][start + nth : start + nth + length]
            place = holders.setdefault(string, {}).setdefault(i, [lead - nth, anchor, []])
            place[2].append(start + nth)
    gone: list[tuple[int, int]] = []
    sent: list[tuple[int, bytes, int, int, list[int]]] = []
    for string, places in holders.items():
        first = min(ids[i] for i in places)
        for i, (lead, anchor, starts) in places.items():
            if ids[i] > first:
                gone += [(i, s) for s in starts]
            else:
                sent.append((i, string, lead, anchor, starts))
    return gone, sent


def _told(found: Named, kinds: list[bytes], contents: list[bytes]) -> np.ndarray:
    """For each fragment, what its document was told about its content; 0 if nothing."""
    told = np.frombuffer(b"".join(contents), np.uint64)
    kind = np.zeros(len(found.doc), np.uint8)
    if not len(told) or not len(kind):
        return kind
    values, code = np.unique(told, return_inverse=True)
    key = np.repeat(np.arange(len(kinds)), [len(k) for k in kinds]) * len(values) + code
    order = np.argsort(key)
    key, kind_of = key[order], np.frombuffer(b"".join(kinds), np.uint8)[order]
    code = np.minimum(np.searchsorted(values, found.content), len(values) - 1)
    at = np.flatnonzero(values[code] == found.content)
    wanted = found.doc[at] * len(values) + code[at]
    place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
    kind[at] = np.where(key[place] == wanted, kind_of[place], 0)
    return kind


def _sent(bucket, doc, ids, versions, places, start, lead, count, anchor, pieces: list[bytes]) -> pa.RecordBatch:
    """Rows for the buckets from contents in order of bucket and document."""
    owners, rows = _ends(bucket * len(ids) + doc), _ends(bucket)
    used, docs = doc[owners - 1], np.searchsorted(owners, rows, side="right")
    upto = lambda sizes: np.cumsum(sizes)[rows - 1]
    small = lambda values: _column(values.astype(np.uint32), rows)
    none = pa.nulls(len(rows), pa.int64())
    data = np.frombuffer(b"".join(pieces), np.uint8)
    columns = [
        pa.array(bucket[rows - 1], pa.int32()), none, none, _column(start.astype(np.uint32), upto(places)),
        _column(ids[used], docs), _column(versions[used], docs), _column(np.diff(owners, prepend=0).astype(np.uint32), docs),
        small(places), small(lead), small(count), _column(anchor, rows), _column(data, upto([len(p) for p in pieces])),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_SENT)


def _send(length: int, buckets: int):
    """What documents know already and what they are asked."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids, versions, kinds, contents), texts in _batches(batches, ["doc_id", "version", "kind", "answer"]):
            ids, versions = ids.to_numpy(), versions.to_numpy()
            found = named(texts, length)
            told = _told(found, kinds.to_pylist(), contents.to_pylist())
            gone, strings = _strings(texts, ids, found, np.flatnonzero(told == SPREAD), length)
            known, also = np.flatnonzero(told == KNOWN), np.array(gone, np.int64).reshape(-1, 2)
            whose, runs = _runs_of(
                np.concatenate([found.doc[known], also[:, 0]]), np.concatenate([found.start[known], also[:, 1]]),
                np.concatenate([(found.start + found.count)[known] + length - 1, also[:, 1] + length]),
            )
            nulls = [pa.nulls(len(whose), pa.binary())] * (len(_SENT) - 4)
            columns = [pa.array(np.full(len(whose), -1), pa.int32()), pa.array(ids[whose]), pa.array(versions[whose]), runs, *nulls]
            yield pa.RecordBatch.from_arrays(columns, schema=_SENT)

            asked = np.flatnonzero(told == ASKED)
            if len(asked):
                bucket = ((found.anchor[asked] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((found.content[asked], bucket * len(ids) + found.doc[asked]))
                asked, bucket = asked[order], bucket[order]
                differ = (found.doc[asked][1:] != found.doc[asked][:-1]) | (found.content[asked][1:] != found.content[asked][:-1])
                once = np.flatnonzero(np.concatenate([[True], differ]))
                places, at = np.diff(np.append(once, len(asked))), asked[once]
                doc, start, count = found.doc[at], found.start[at], found.count[at]
                spans = zip(doc.tolist(), start.tolist(), (start + count + length - 1).tolist(), strict=True)
                yield _sent(
                    bucket[once], doc, ids, versions, places, found.start[asked], found.lead[at], count,
                    found.anchor[at], [texts[i][low:high] for i, low, high in spans],
                )
            if strings:
                bucket = np.array([xxhash.xxh3_64_intdigest(x[1]) % buckets for x in strings], np.int64)
                doc = np.array([x[0] for x in strings], np.int64)
                order = np.argsort(bucket * len(ids) + doc, kind="stable")
                strings = [strings[k] for k in order.tolist()]
                yield _sent(
                    bucket[order], doc[order], ids, versions, np.array([len(x[4]) for x in strings], np.int64),
                    np.array([p for x in strings for p in x[4]], np.int64), np.array([x[2] for x in strings], np.int64),
                    np.ones(len(strings), np.int64), np.array([x[3] for x in strings], np.uint64), [x[1] for x in strings],
                )

    return send


def earliest(pieces: list[bytes], counts: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For each string of the pieces, in order, the smallest document that has it.

    A piece holds ``counts`` strings and belongs to a document. All pieces go into one suffix
    array; whatever follows a piece does not matter, as strings end within it.
    """
    text = b"".join(pieces)
    sizes = counts + length - 1
    begin = np.concatenate([[0], sizes.cumsum()[:-1]])
    piece = np.repeat(np.arange(len(pieces)), counts)
    nth = np.arange(len(piece)) - np.repeat(counts.cumsum() - counts, counts)
    place = begin[piece] + nth  # of each string
    string_at = np.full(len(text), -1)
    string_at[place] = np.arange(len(place))
    order = string_at[np.array(suffix_array(text), np.int64)]
    order = order[order >= 0]
    rows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), length)[place[order]]
    fresh = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    least = np.minimum.reduceat(docs[piece[order]], np.flatnonzero(fresh))
    result = np.empty(len(place), docs.dtype)
    result[order] = least[np.cumsum(fresh) - 1]
    return result


def _furthest(group: np.ndarray, strings: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How far each string agrees with that one of the others of its group which it agrees with longest.

    ``strings`` are rows of one width, of which ``sizes`` bytes count and the others are 0.
    """
    n, width = strings.shape
    # In order of group, bytes and size, as numbers with the highest byte first.
    rows = np.empty((n, width + 8), np.uint8)
    rows[:, :4] = group.astype(">u4").view(np.uint8).reshape(n, 4)
    rows[:, 4:-4] = strings
    rows[:, -4:] = (sizes + 1).astype(">u4").view(np.uint8).reshape(n, 4)
    order = np.argsort(rows.view(f"S{width + 8}").ravel())
    strings, sizes, group = strings[order], sizes[order], group[order]
    differ = np.ones((n - 1, width + 1), bool)
    np.not_equal(strings[1:], strings[:-1], out=differ[:, :-1])
    common = np.minimum(differ.argmax(axis=1), np.minimum(sizes[1:], sizes[:-1]))
    common[group[1:] != group[:-1]] = 0
    furthest = np.empty(n, np.int64)
    furthest[order] = np.maximum(np.concatenate([[0], common]), np.concatenate([common, [0]]))
    return furthest


def _rows(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray, step: int) -> np.ndarray:
    """Bytes from places on, to the right or (``step`` -1) to the left, as rows filled up with 0."""
    nth = np.arange(int(sizes.max(initial=0)))
    inside = nth < sizes[:, None]
    return np.where(inside, data[np.where(inside, begin[:, None] + step * nth, 0)], np.uint8(0))


def shareable(
    data: np.ndarray, group: np.ndarray, begin: np.ndarray, lead: np.ndarray, count: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last string of each piece that another piece of its anchor may share.

    Pieces begin at places of ``data``; those of an anchor have one ``group``. Equal strings agree
    from the anchor in both directions, so no string is shared that reaches beyond the longest
    agreement to the left or to the right.
    """
    sizes = count + length - 1 - lead
    after = _furthest(group, _rows(data, begin + lead, sizes, 1), sizes)
    before = _furthest(group, _rows(data, begin + lead - 1, lead, -1), lead)
    return np.maximum(0, lead - before), np.minimum(count, lead + after - length + 1)


def _sort(length: int):
    def sort(table: pa.Table) -> pa.Table:
        joined = lambda name, kind: _joined(table, name, kind)
        ids, versions, owned = joined("docs", np.int64), joined("versions", np.int64), joined("owned", np.uint32)
        row = np.repeat(np.arange(len(ids)), owned)  # the document of each piece
        count, start = joined("count", np.uint32).astype(np.int64), joined("start", np.uint32).astype(np.int64)
        places = joined("places", np.uint32).astype(np.int64)
        first = places.cumsum() - places  # in start, of each piece's places
        lead, anchor = joined("lead", np.uint32).astype(np.int64), joined("anchor", np.uint64)
        data = joined("bytes", np.uint8)
        begin = (count + length - 1).cumsum() - (count + length - 1)
        order = np.argsort(anchor, kind="stable")
        edges = [0, *_ends(anchor[order]).tolist()]
        found: list[tuple[np.ndarray, ...]] = [(row[:0], start[:0], start[:0])]

        def settle(pieces: dict[bytes, int], of: list[int], owners: list[int], shifts: list[int]) -> None:
            """The strings of the pieces so far, in one suffix array. Equal pieces are in it once."""
            of, owner, shift = np.array(of), np.array(owners), np.array(shifts)
            many = np.array([len(p) for p in pieces]) - length + 1
            docs = np.full(len(pieces), np.iinfo(np.int64).max)
            np.minimum.at(docs, of, ids[row[owner]])
            least = earliest(list(pieces), many, docs, length)
            begins, many = (many.cumsum() - many)[of], many[of]
            nth = np.arange(many.sum()) - np.repeat(many.cumsum() - many, many)
            offset, whose = np.repeat(shift, many) + nth, np.repeat(owner, many)
            later = least[np.repeat(begins, many) + nth] < ids[row[whose]]
            whose, offset = whose[later], offset[later]
            # Runs of bytes from the begin of a piece, whose strings are in order.
            if len(whose):
                fresh = (whose[1:] != whose[:-1]) | (offset[1:] > offset[:-1] + length)
                edge = np.flatnonzero(np.concatenate([[True], fresh, [True]]))
                found.append((whose[edge[:-1]], offset[edge[:-1]], offset[edge[1:] - 1] + length))

        # Several anchors share a suffix array; an anchor with many fragments has one of its own.
        pieces, of, owners, shifts, size = {}, [], [], [], 0
        text, at = data.tobytes(), 0
        while at < len(edges) - 1:
            upto = max(at + 1, int(np.searchsorted(edges, edges[at] + COMPARED, side="right")) - 1)
            own = order[edges[at] : edges[upto]]
            group = np.repeat(np.arange(upto - at), np.diff(edges[at : upto + 1]))
            low, high = shareable(data, group, begin[own], lead[own], count[own], length)
            kept = np.flatnonzero(low < high)
            own, group, low, high = own[kept], group[kept], low[kept], high[kept]
            ends = np.append(group[1:] != group[:-1], True)[: len(own)]  # of an anchor's pieces
            spans = (own, low, begin[own] + low, begin[own] + high + length - 1, ends)
            for i, shift, a, b, over in zip(*(x.tolist() for x in spans), strict=True):
                piece = text[a:b]
                if piece not in pieces:
                    pieces[piece] = len(pieces)
                    size += b - a
                of.append(pieces[piece])
                owners.append(i)
                shifts.append(shift)
                if over and size >= SORTED:
                    settle(pieces, of, owners, shifts)
                    pieces, of, owners, shifts, size = {}, [], [], [], 0
            at = upto
        if pieces:
            settle(pieces, of, owners, shifts)
        whose, low, high = (np.concatenate(c) for c in zip(*found, strict=True))
        # A run of a piece is one at every place of the piece.
        many = places[whose]
        nth = np.arange(many.sum()) - np.repeat(many.cumsum() - many, many)
        place = start[np.repeat(first[whose], many) + nth]
        whose, runs = _runs_of(row[np.repeat(whose, many)], place + np.repeat(low, many), place + np.repeat(high, many))
        return pa.table({"doc_id": pa.array(ids[whose]), "version": pa.array(versions[whose]), "runs": runs})

    return sort


# -- step 4: documents -------------------------------------------------------------------


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        texts = batch.column("text").cast(pa.binary())
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            given = np.frombuffer(b"".join(batch.column("runs")[i].as_py() or []), np.uint32)
            given = given.reshape(-1, 2).astype(np.int64)
            runs = joined_runs(given[:, 0], given[:, 1])
            kept, at = [], 0
            for start, stop in runs.tolist():
                kept.append(text[at:start])
                at = stop
            kept.append(text[at:])
            kept = b"".join(kept)
            rows.append((len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), runs.ravel()))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
        )


def without_repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed.

    A byte of a text is removed if it lies in a string of ``length`` bytes that also starts in a
    document with a smaller id. Strings are those of the input, overlaps count, and matches do
    not cross documents. ``removed`` has starts and stops of the removed runs in turn. A null
    text is empty. Rows without id lose nothing and are no earlier document. Rows with one id
    are one document for others, and lose nothing to each other. Other columns are not read. An
    empty table gives no row.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))
    with Workspace(spark, "substrings") as work:
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        buckets = max(1, math.ceil(size / BUCKET_BYTES))
        identified = rows.filter("doc_id IS NOT NULL")
        names = identified.mapInArrow(_name(length, buckets), NAMES)
        # Answers need no meeting, so they are spread out.
        group = F.when(F.col("bucket") < 0, F.pmod(F.hash("content"), F.lit(buckets)))
        names = names.withColumn("spread", F.coalesce(group, F.lit(0)))
        # As many parts of the documents as buckets: packed answers are few rows at any size.
        packed = names.groupBy("bucket", "spread").applyInArrow(_resolve(buckets), PACKED)
        packed = work.table("packed", packed)
        work.release()
        answers = packed.groupBy("part").applyInArrow(_merge, ANSWERS).withColumnRenamed("content", "answer")
        answers = work.table("answers", answers)
        work.drop("packed")
        work.release()
        tagged = identified.withColumn("tag", F.col("version").bitwiseAND(F.lit(_TAG)).cast("int"))
        sent = tagged.join(answers.hint("merge"), ["doc_id", "tag"]).mapInArrow(_send(length, buckets), SENT)
        sent = work.table("sent", sent)
        work.drop("answers")
        work.release()
        known = sent.filter("bucket < 0").select("doc_id", "version", F.col("start").alias("runs"))
        found = sent.filter("bucket >= 0").groupBy("bucket").applyInArrow(_sort(length), RUNS)
        # Written before the texts are dealt out again, so that they and what was sent are not on disk together.
        runs = work.table("runs", known.unionByName(found))
        work.drop("sent")
        work.release()
        runs = runs.groupBy("doc_id", "version").agg(F.collect_list("runs").alias("runs"))
        result = rows.join(runs.hint("merge"), ["doc_id", "version"], "left").select("doc_id", "text", "runs").mapInArrow(
            _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<bigint>"
        )
        return work.keep("result", result)
