"""Suffix arrays of byte strings in numpy: Larsson-Sadakane refinement and common prefixes after Kasai."""

from __future__ import annotations

import numpy as np

U64 = np.uint64


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one big-endian number; 0 beyond the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(text)]).view(">u8").ravel().astype(np.uint64)


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and the place of each suffix in that order.

    Suffixes are first ordered by seven bytes. Then groups that are still equal, and only those, are refined by the
    groups of the suffixes h places on; h doubles until no group is left. A suffix that ends counts as smaller.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # seven bytes and how many of them are real: zero bytes beyond the end equal real ones
    h = 7
    first = words_at(text) & ~U64(0xFF) | np.minimum(n - np.arange(n), h).astype(U64)
    order = np.argsort(first)
    rank = np.empty(n, np.int64)
    starts = group_starts(np.diff(first[order]) != 0, n)
    rank[order] = starts
    # only groups of several suffixes are sorted again, always as a whole
    where = several(starts)
    starts = starts[where]
    while len(where):
        open_ = order[where]
        ahead = open_ + h
        ahead = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = starts * (n + 1) + ahead  # one number for both ranks: sorting it is much faster than sorting by two
        again = np.argsort(key)
        open_, key = open_[again], key[again]
        order[where] = open_
        starts = where[group_starts(np.diff(key) != 0, len(key))]
        rank[open_] = starts
        left = several(starts)
        where, starts = where[left], starts[left]
        h *= 2
    return order, rank


def several(starts: np.ndarray) -> np.ndarray:
    """Places of the groups that have more than one member."""
    same = starts[1:] == starts[:-1]
    return np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]]))


def group_starts(changed: np.ndarray, n: int) -> np.ndarray:
    lead = np.concatenate([[True], changed])
    return np.maximum.accumulate(np.where(lead, np.arange(n), 0))


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each place in the order, the bytes shared with the suffix before it (0 for the first).

    Kasai's step: a suffix shares at least one byte less with its predecessor than the suffix one place earlier in
    the text did with its own, and exactly one less if the bytes before both are equal. Only where they
    differ is the length counted, for all such places at once, eight bytes a turn.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    places = np.arange(n)
    counted = (before < 0) | (before == 0) | (places == 0)
    inner = ~counted
    counted[inner] = text[places[inner] - 1] != text[before[inner] - 1]
    shared = np.zeros(n, np.int64)
    going = np.flatnonzero(counted & (before >= 0))
    eight = words_at(text)
    while len(going):
        a, b = going + shared[going], before[going] + shared[going]
        room = (a + 8 <= n) & (b + 8 <= n)
        equal = np.zeros(len(going), bool)
        equal[room] = eight[a[room]] == eight[b[room]]
        shared[going[equal]] += 8
        last = going[~equal]
        for _ in range(8):
            a, b = last + shared[last], before[last] + shared[last]
            inside = (a < n) & (b < n)
            last = last[inside]
            last = last[text[a[inside]] == text[b[inside]]]
            shared[last] += 1
        going = going[equal]
    source = np.maximum.accumulate(np.where(counted, places, 0))
    shared = np.where(counted, shared, shared[source] - (places - source))
    return shared[order]
