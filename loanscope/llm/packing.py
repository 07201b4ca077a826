"""Packing of token sequences with bounded space.

Each task packs its documents online. A document is cut into full windows first; its
last part goes to the open window that it fills best. When none has room and the task
already keeps its number of open windows, the fullest is closed: the part is cut to
fill it, unless the gap is too short to be worth a cut. Windows that are still open when
a task ends are few; they are merged in groups of tasks, each into full windows and at
most one that is not.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscope.llm.tokens import Encoder
from loanscope.llm.workspace import Workspace

#: Windows that a task keeps open.
OPEN_WINDOWS = 64
#: A gap of fewer tokens is padded rather than filled by a cut.
SHORTEST_CUT = 16
#: Tasks whose open windows are merged together.
MERGED_TASKS = 32

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
COLUMNS = [c.split(" ")[0] for c in PIECE.split(", ")]


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        first = Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens)
        return first, Piece(self.doc_id, self.start + at, self.ids[at:], self.doc_tokens)


@dataclass
class Window:
    size: int
    pieces: list[Piece] = field(default_factory=list)
    filled: int = 0

    def put(self, piece: Piece) -> Window:
        self.pieces.append(piece)
        self.filled += len(piece.ids)
        return self

    @property
    def free(self) -> int:
        return self.size - self.filled


class Packer:
    """Places pieces one after another; closed windows come back from :meth:`place`."""

    def __init__(self, size: int, open_windows: int):
        self.size, self.most = size, open_windows
        self.open: list[Window] = []  # by free space, so the fullest is the first

    def place(self, piece: Piece) -> list[Window]:
        closed = []
        while len(piece.ids) > self.size:
            first, piece = piece.cut(self.size)
            closed.append(Window(self.size).put(first))
        at = bisect.bisect_left(self.open, len(piece.ids), key=lambda w: w.free)
        if at < len(self.open):
            window = self.open.pop(at)
        elif len(self.open) < self.most:
            window = Window(self.size)
        else:
            window = Window(self.size)
            fullest = self.open.pop(0)
            if fullest.free >= SHORTEST_CUT:
                first, piece = piece.cut(fullest.free)
                fullest.put(first)
            closed.append(fullest)
        window.put(piece)
        if window.free:
            bisect.insort(self.open, window, key=lambda w: w.free)
        else:
            closed.append(window)
        return closed


def _rows(windows: list[Window], first_id: int) -> dict[str, list]:
    rows: dict[str, list] = {name: [] for name in COLUMNS}
    for sequence, window in enumerate(windows, first_id):
        offset = 0
        for piece in window.pieces:
            values = (
                piece.doc_id, piece.start, len(piece.ids), zlib.crc32(piece.ids.astype("<u4").tobytes()),
                piece.doc_tokens, sequence, offset,
            )
            for name, value in zip(COLUMNS, values, strict=True):
                rows[name].append(value)
            offset += len(piece.ids)
    return rows


def _online(tokenizer: str, size: int, open_windows: int, end_id: int):
    def batch_of(windows: list[Window], first_id: int, task: int, still_open: bool) -> pa.RecordBatch:
        rows = _rows(windows, first_id)
        n = len(rows["doc_id"])
        ids = [p.ids.astype("<u4").tobytes() if still_open else None for w in windows for p in w.pieces]
        arrays = [pa.array(rows[name], pa.int64()) for name in COLUMNS]
        arrays += [pa.array([task] * n, pa.int64()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=[*COLUMNS, "task", "ids"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder.load(tokenizer), Packer(size, open_windows)
        task = TaskContext.get().partitionId()
        number = task << 32
        for batch in batches:
            closed: list[Window] = []
            keys = batch.column("doc_id").to_pylist()
            texts = batch.column("text").to_pylist()
            for key, ids in zip(keys, encoder.encode(texts), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                closed += packer.place(Piece(key, 0, ids, len(ids)))
            yield batch_of(closed, number, task, False)
            number += len(closed)
        yield batch_of(packer.open, number, task, True)

    return pack


def _merge(size: int):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        """Fill windows one after another, cutting where a window ends."""
        rows = rows.sort_values(["sequence_id", "offset"])
        windows, window = [], Window(size)
        for row in rows.itertuples(index=False):
            key = None if pd.isna(row.doc_id) else int(row.doc_id)
            piece = Piece(key, row.start, np.frombuffer(row.ids, "<u4"), row.doc_tokens)
            while len(piece.ids) >= window.free:
                first, piece = piece.cut(window.free)
                windows.append(window.put(first))
                window = Window(size)
            if len(piece.ids):
                window.put(piece)
        if window.pieces:
            windows.append(window)
        # The ids of the windows that are taken apart are free again.
        merged = pd.DataFrame(_rows(windows, 0))
        merged["sequence_id"] = rows["sequence_id"].drop_duplicates().to_numpy()[merged["sequence_id"]]
        merged["doc_id"] = merged["doc_id"].astype("Int64")
        return merged

    return merge


def pack(
    docs: DataFrame, tokenizer: str, size: int = 1024, open_windows: int = OPEN_WINDOWS, end_id: int = 0,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece of a document in a sequence of at most ``size`` tokens.

    A document is the ids of its whole text and then ``end_id``; a null text is empty and
    so is one token long. Each id lies in exactly one piece. ``start`` counts the
    document's ids before the piece, ``offset`` the sequence's. Sequence numbers are
    unique but not gapless. Repeated rows are packed as documents of their own, null ids
    stay null, other columns are not read, and an empty table gives no row.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    with Workspace(spark, "packing") as work:
        online = rows.mapInArrow(
            _online(tokenizer, size, open_windows, end_id), f"{PIECE}, task long, ids binary"
        )
        online = work.table("online", online)
        still_open = F.col("ids").isNotNull()
        merged = (
            online.filter(still_open)
            .groupBy(F.floor(F.col("task") / MERGED_TASKS).alias("group"))
            .applyInPandas(_merge(size), PIECE)
        )
        return work.keep("pieces", online.filter(~still_open).select(*COLUMNS).unionByName(merged))
