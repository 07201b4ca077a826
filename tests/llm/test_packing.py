import zlib
from collections import defaultdict

from tests.llm.conftest import pairs
from tokenizers import Tokenizer

from loanscope.llm import packing
from loanscope.llm.queries import TOKENIZER


def verify(rows, docs, size):
    """Every id once, no gaps, no overlap; returns the fill of each sequence."""
    library = Tokenizer.from_file(TOKENIZER)
    ids = defaultdict(list)
    for doc_id, text in docs:
        ids[doc_id].append([*library.encode(text or "", add_special_tokens=False).ids, 0])
    sequences, found = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        found[r.doc_id].append((r.doc_tokens, r.start, r.length, r.ids_crc32))
    for doc_id, texts in ids.items():
        assert sum(x[2] for x in found[doc_id]) == sum(map(len, texts))
        for tokens, start, length, crc in found[doc_id]:
            same = [t for t in texts if len(t) == tokens]
            packed = [b"".join(i.to_bytes(4, "little") for i in t[start : start + length]) for t in same]
            assert crc in [zlib.crc32(p) for p in packed]
        if len(texts) == 1:
            at = 0
            for _, start, length, _ in sorted(found[doc_id], key=lambda x: x[1]):
                assert start == at
                at += length
    assert set(found) == set(ids)
    fills = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
        fills.append(at)
    return fills


def test_edge_cases(edge_docs, no_docs):
    docs = edge_docs.repartition(3)
    verify(packing.pack(docs, TOKENIZER, 64, open_windows=2).collect(), pairs(edge_docs), 64)
    assert packing.pack(no_docs, TOKENIZER).collect() == []


def test_real_documents_leave_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)
    fills = verify(packing.pack(docs, TOKENIZER).collect(), pairs(docs), 1024)
    assert sum(fills) / (1024 * len(fills)) > 0.995


def test_best_fit_and_closing():
    import numpy as np

    piece = lambda n: packing.Piece(1, 0, np.zeros(n, np.uint32), n)
    packer = packing.Packer(100, 2)
    assert packer.place(piece(50)) == [] and packer.place(piece(70)) == []
    packer.place(piece(30))  # fills the fuller one exactly
    assert [w.filled for w in packer.open] == [50]
    packer.place(piece(90))
    closed = packer.place(piece(60))  # none has room: the fullest closes, its gap too short for a cut
    assert [w.filled for w in closed] == [90] and sorted(w.filled for w in packer.open) == [50, 60]
