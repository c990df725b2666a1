"""Suffix arrays by linear grouping construction, for many short texts at once.

Phase 1 takes the groups of suffixes in descending order. A suffix's pointer goes to the nearest
position to its left that lies in a lower group. The positions that the group's pointers meet leave
their own group for a new one right after it, those met more often for a higher one, so that in the end suffixes
are grouped by the prefix their Lyndon factorisation starts with, in order. Phase 2 gives out the places of every
group from left to right: each suffix placed places the one before it, and along that one's pointers
all not yet placed. Neither phase renames or recurses.

The texts are independent, so each step is done for all of them with numpy: phase 1 takes the greatest
open group of every text, phase 2 the next place of every text.
"""

from __future__ import annotations

import numpy as np


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges start .. start + size, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def suffix_arrays(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Suffix array of every text, in one array.

    ``symbols`` holds the texts one after another, each with a last symbol that is the least of its text and
    occurs once. Values are positions in ``symbols``.
    """
    n, first = len(symbols), np.cumsum(lengths) - lengths
    if not n:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(lengths)), lengths)
    group, pointer = _groups(symbols.astype(np.int64), text, first, lengths)
    return _emit(group, pointer, first, lengths)


def _groups(symbols, text, first, lengths):
    n = len(symbols)
    key = text * (int(symbols.max()) + 1) + symbols
    order = np.argsort(key, kind="stable")  # positions by group
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    sorted_key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]))
    sizes = np.diff(np.concatenate([starts, [n]]))
    group = np.empty(n, np.int64)  # a group's name is where it starts in ``order``
    group[order] = np.repeat(starts, sizes)
    after = np.zeros(n + 1, np.int64)  # where it ends
    after[starts] = starts + sizes
    done = np.zeros(n + 1, bool)  # one more for what lies before the first text
    pointer = np.arange(-1, n)
    pointer[first] = pointer[n] = -1
    moved = np.zeros(n, bool)
    top = first + lengths
    base = first.copy()
    while len(top):
        low = group[order[top - 1]]
        members = order[_ragged(low, top - low)]
        done[members] = True
        p = pointer[members]
        while True:
            passed = done[p]  # done[-1] is never set
            if not passed.any():
                break
            p = np.where(passed, pointer[p], p)
        pointer[members] = p
        on = low > base
        top, base = low[on], base[on]
        p = p[p >= 0]
        if len(p):
            met, times = np.unique(p, return_counts=True)
            of = group[met]
            at = np.lexsort((times, of))
            met, times, of = met[at], times[at], of[at]
            new = np.concatenate([[True], of[1:] != of[:-1]])
            count = np.diff(np.concatenate([np.flatnonzero(new), [len(of)]]))
            home = of[new]
            end = after[home]
            slots = _ragged(end - count, count)
            moved[met] = True
            there = order[slots]
            out = there[~moved[there]]
            moved[met] = False
            old = place[met]
            free = old[old < np.repeat(end - count, count)]
            order[free], place[out] = out, free
            order[slots], place[met] = met, slots
            after[home] = end - count
            head = new | np.concatenate([[True], times[1:] != times[:-1]])
            heads = slots[head]
            number = np.diff(np.concatenate([np.flatnonzero(head), [len(of)]]))
            after[heads] = heads + number
            group[met] = np.repeat(heads, number)
    return group, pointer


def _emit(group, pointer, first, lengths):
    n = len(group)
    out = np.full(n + 1, -1)
    placed = np.zeros(n + 1, bool)
    placed[n] = True  # what -1 stands for
    following = np.arange(n)  # next free place of a group
    opening = np.zeros(n + 1, bool)
    opening[first] = True
    last = first + lengths - 1
    out[first] = last
    placed[last] = True
    following[first] += 1
    i, end = first.copy(), first + lengths
    j = np.where(opening[last], -1, last - 1)
    while len(i):
        go = ~placed[j]
        js = j[go]
        g = group[js]
        s = following[g]
        out[s] = js
        placed[js] = True
        following[g] = s + 1
        j[go] = pointer[js]
        stop = ~go
        i[stop] += 1
        if (ended := i >= end).any():
            on = ~ended
            i, end, j, stop = i[on], end[on], j[on], stop[on]
        x = out[i[stop]]
        j[stop] = np.where(opening[x], -1, x - 1)
    return out[:n]
