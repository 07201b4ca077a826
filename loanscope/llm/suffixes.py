"""Suffix sorting by linear grouping (Baier, 2016).

The first phase sorts suffixes into groups: those that begin with the same Lyndon word,
their longest. It takes groups in descending order; a group's suffixes look for their
previous smaller suffix, the nearest one to the left whose group is still to come. A
suffix pointed to moves up, into a new group right after its old one, and further up the
more often it is pointed to. No group is ever named anew. The second phase goes up the
groups and emits the order within each: a placed suffix places the one before it, and
those that it reaches by previous-smaller pointers, at the front of their groups.
"""

from __future__ import annotations

_OPEN = -2
_END = -1


def suffix_array(text: bytes) -> list[int]:
    """Start positions of the suffixes of a text in lexicographic order, in linear time."""
    previous, group, starts = _grouped(text)
    order = [0] * len(text)
    # The end of the text is the smallest suffix of all: it places the last character.
    s, at = len(text) - 1, 0
    while True:
        while s >= 0:
            here = starts[group[s]]
            if here < 0:
                break  # a group of one that is placed already
            order[here] = s
            starts[group[s]] = here + 1
            group[s] = len(starts) - 1  # placed
            s = previous[s]
        if at == len(text):
            return order
        s = order[at] - 1
        at += 1


def _grouped(text: bytes) -> tuple[list[int], list[int], list[int]]:
    """Previous-smaller pointers, the group of each suffix, and where each group starts.

    A last group with start -1 stands for suffixes that have been placed.
    """
    members: list[set[int]] = [set() for _ in range(256)]
    for i, symbol in enumerate(text):
        members[symbol].add(i)
    group = list(text)
    lower = list(range(-1, 255))
    upper = [*range(1, 256), _END]
    previous = [_OPEN] * len(text)
    current = 255
    while current >= 0:
        inside = members[current]
        if len(inside) == 1:
            (s,) = inside
            p = s - 1
            while p >= 0 and previous[p] != _OPEN:
                p = previous[p]
            previous[s] = p
            if p >= 0:
                old = group[p]
                if len(members[old]) > 1:
                    members[old].discard(p)
                    group[p] = _above(old, members, lower, upper, {p})
        elif inside:
            pointed: dict[int, int] = {}
            for s in sorted(inside):
                p = s - 1
                while p >= 0 and previous[p] != _OPEN:
                    p = previous[p]
                previous[s] = p
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
            moves: dict[tuple[int, int], list[int]] = {}
            for p, times in pointed.items():
                moves.setdefault((-times, group[p]), []).append(p)
            for (_, old), moved in sorted(moves.items()):
                if len(moved) < len(members[old]):
                    members[old].difference_update(moved)
                    fresh = _above(old, members, lower, upper, set(moved))
                    for p in moved:
                        group[p] = fresh
        current = lower[current]
    starts, at, current = [0] * len(members), 0, 0
    while current != _END:
        starts[current] = at
        at += len(members[current])
        current = upper[current]
    return previous, group, [*starts, -1]


def _above(old: int, members: list, lower: list[int], upper: list[int], inside: set[int]) -> int:
    """A new group right after an old one."""
    fresh = len(members)
    members.append(inside)
    following = upper[old]
    upper[old] = fresh
    upper.append(following)
    lower.append(old)
    if following != _END:
        lower[following] = fresh
    return fresh
