"""Token ids of whole texts, as the tokenizer's own library gives them.

A ``.model`` file goes to sentencepiece and a ``.json`` file to tokenizers. For one
kind of ``.json`` file there is a faster road to the same ids: plain byte-level BPE
whose merges rank as their ids do. tiktoken encodes with the ranks read from that same
file; texts with special strings, or with characters on whose class the two libraries'
Unicode tables might differ, still go to tokenizers. The tests compare both roads.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np

#: Characters on whose class (letter, digit, space, other) the libraries agree.
_UNUSUAL = re.compile(
    r"[^\x00-\x1b\x20-\x7f\u00a1\u00a7\u00ab\u00bb\u00bf-\u024f\u2010-\u2027]"
).search


class Encoder:
    """Encodes texts without begin, end or added special tokens, never truncated or padded.

    Special strings inside a text are treated as the library does by default.
    """

    def encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        raise NotImplementedError

    @staticmethod
    @functools.lru_cache(maxsize=4)  # a Python worker serves many tasks
    def load(path: str) -> Encoder:
        if path.endswith(".model"):
            return _Sentencepiece(path)
        with open(path, encoding="utf-8") as file:
            ranks = _byte_ranks(json.load(file))
        return _Tokenizers(path) if ranks is None else _Ranked(path, ranks)

    @staticmethod
    def release(path: str) -> str:
        """Name and version of the library, for cache keys."""
        if path.endswith(".model"):
            import sentencepiece as library
        else:
            import tokenizers as library
        return f"{library.__name__} {library.__version__}"


class _Sentencepiece(Encoder):
    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts):
        for text in texts:
            yield np.array(self.processor.encode(text, num_threads=1), np.uint32)


class _Tokenizers(Encoder):
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def encode(self, texts):
        for text in texts:
            yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


class _Ranked(_Tokenizers):
    def __init__(self, path: str, ranks: dict[bytes, int]):
        super().__init__(path)
        import public_tokenizers
        import tiktoken

        self.fast = tiktoken.Encoding(
            "ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)").search

    def encode(self, texts):
        for text in texts:
            if _UNUSUAL(text) or self.special(text):
                yield from super().encode([text])
            else:
                yield self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)


def _byte_ranks(settings: dict) -> dict[bytes, int] | None:
    """Token bytes to ids, if the file is plain byte-level BPE ranked by id; else None."""
    model, split = settings["model"], settings.get("pre_tokenizer") or {}
    if (
        model["type"] != "BPE"
        or settings.get("normalizer")
        or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        or model.get("ignore_merges")
        or split.get("type") != "ByteLevel"
        or split.get("add_prefix_space")
        or not split.get("use_regex", True)
    ):
        return None
    added = {t["content"] for t in settings.get("added_tokens") or []}
    byte_of = _byte_of_character()
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in added}
    merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    made = [vocabulary["".join(pair)] for pair in merges]
    ranked = made == sorted(made) and len(made) + 256 == len(vocabulary) == 256 + len(set(made))
    if not ranked or any(c not in byte_of for t in vocabulary for c in t):
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items()}


def _byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for themselves, the other bytes in order for the
    characters from U+0100 on.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}
