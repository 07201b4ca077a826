"""Word hashes and shingles, computed on whole arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_RULE = np.random.Generator(np.random.PCG64(20240229))
#: A random 64-bit value for each byte.
_BYTE = _RULE.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
#: ASCII letters in lower case, all other bytes as they are.
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: ASCII white space: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: All of ASCII but letters and digits.
NOT_ALPHANUMERIC = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes hashed at once; a longer word is hashed whole.
SPAN = 1 << 18


def mixed(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


class _Powers:
    """Powers of the base and of its inverse, as many as asked for so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.ones(max(n, 2 * len(self.up)), np.uint64)
            steps[1:] = _BASE
            self.up = np.multiply.accumulate(steps)
            steps[1:] = _INVERSE
            self.down = np.multiply.accumulate(steps)
        return self.up, self.down


_POWERS = _Powers()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base, and of its inverse."""
    return _POWERS.upto(n)


@dataclass(frozen=True)
class Words:
    """The words of a stretch of bytes: where they lie, and hashes of parts of them."""

    start: np.ndarray
    end: np.ndarray
    sums: np.ndarray

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the words, or of the parts between given places."""
        start = self.start if start is None else start
        end = self.end if end is None else end
        down = _POWERS.upto(len(self.sums))[1]
        return mixed((self.sums[end] - self.sums[start]) * down[start])


def words_of(span: np.ndarray, separators: np.ndarray = SPACE) -> Words:
    """Words of an array of bytes; A to Z count as a to z."""
    inside = np.zeros(len(span) + 2, np.int8)
    inside[1:-1] = ~separators[span]
    edges = np.diff(inside)
    up = _POWERS.upto(len(span))[0]
    sums = np.zeros(len(span) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[span]] * up[: len(span)], out=sums[1:])
    return Words(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), sums)


def spans(data: np.ndarray, separators: np.ndarray = SPACE) -> Iterator[np.ndarray]:
    """The bytes of a text in stretches that end between words."""
    if len(data) <= SPAN:
        yield data
        return
    at, between = 0, np.flatnonzero(separators[data])
    while at < len(data):
        cut = np.searchsorted(between, at + SPAN)
        if cut and between[cut - 1] > at:
            end = between[cut - 1]
        else:  # a word longer than a stretch
            end = between[cut] if cut < len(between) else len(data)
        end = max(int(end), at + 1)
        yield data[at:end]
        at = end


def text_bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def word_hashes(text: str, separators: np.ndarray = SPACE) -> np.ndarray:
    """Hashes of the words of a text: runs of bytes that are not separators.

    A to Z count as a to z. Equal words have equal hashes. Unequal ones of a regular pattern and
    over a thousand letters can have too; where that matters take :func:`wide_hashes`.
    """
    return np.concatenate([words_of(s, separators).hashes() for s in spans(text_bytes(text), separators)])


def wide_hashes(text: str, separators: np.ndarray = SPACE) -> np.ndarray:
    """128-bit hashes (n x 2) of the words of a text: runs of bytes that are not separators.

    A to Z count as a to z.
    """
    return np.concatenate([_wide_hashes(s, separators) for s in spans(text_bytes(text), separators)])


def _wide_hashes(span: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """128-bit hashes of the words of a stretch of bytes.

    Each byte of a word gives a pseudo-random number that depends on its place in the word, and
    the hash adds them up. No regular pattern in words makes these sums meet, as it can with a
    polynomial modulo a power of two.
    """
    inside = ~separators[span]
    letters = _LOWER[span[inside]]
    edges = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]).astype(np.int8))
    lengths = np.flatnonzero(edges == -1) - np.flatnonzero(edges == 1)
    if not len(lengths):
        return np.zeros((0, 2), np.uint64)
    starts = np.cumsum(lengths) - lengths
    place = (np.arange(len(letters)) - np.repeat(starts, lengths)).astype(np.uint64)
    one = mixed(_BYTE[letters] + place * _BASE)
    other = (one ^ (one >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    other ^= other >> np.uint64(32)
    return np.column_stack([mixed(np.add.reduceat(one, starts)), mixed(np.add.reduceat(other, starts))])


def shingle_set(text: str, size: int) -> np.ndarray:
    """Distinct 128-bit hashes (n x 2) of the word shingles of a text, in ascending order.

    Words are runs of bytes other than ASCII white space; A to Z count as a to z. With fewer
    words than ``size`` the whole sequence is the one shingle; a text without words has none.
    """
    words = wide_hashes(text)
    if not len(words):
        return words
    width = min(size, len(words))
    total = np.full((len(words) - width + 1, 2), width, np.uint64)
    total[:, 1] += _INVERSE
    for i in range(width):
        total = mixed(total * _BASE + words[i : len(words) - width + 1 + i])
    total = total[np.argsort(total[:, 0], kind="stable")]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]).any(axis=1)
    if (total[1:, 0] == total[:-1, 0])[new[1:]].any():  # one first half with several second halves
        return np.unique(total, axis=0)
    return total[new]


def common_shingles(left: np.ndarray, right: np.ndarray) -> int:
    """How many shingles two sets share."""
    small, large = sorted((left, right), key=len)
    if not len(large) or (large[1:, 0] == large[:-1, 0]).any():
        return len(set(map(tuple, left.tolist())) & set(map(tuple, right.tolist())))
    at = np.searchsorted(large[:, 0], small[:, 0])
    at[at == len(large)] = 0
    return int((large[at] == small).all(axis=1).sum())
