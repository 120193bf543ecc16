"""Suffix arrays by linear grouping construction, for many texts at once.

First the suffixes are grouped by their Lyndon prefix (the longest prefix that
is smaller than all its own suffixes). Groups begin as one a symbol and are
processed in descending order. A suffix of the group at hand points to the
nearest one to its left in a smaller group, its previous smaller one, over
which its Lyndon prefix then extends: of each group, the suffixes that were
pointed to are moved, by how often, into new groups right above it. When all
groups are processed, a group's suffixes share their Lyndon prefix and groups
are in order. Then each group's order is emitted: suffixes are visited in
ascending order, and each places the ones whose Lyndon prefix ends right before
it (along the pointers, from its left neighbour) at the next free place of
their group. Nothing is renamed or sorted again.

Both parts are loops over groups and suffixes. They run over many texts in
step, one group (or suffix) of each at a time, as numpy operations, so that
their cost is shared; a batch should hold texts of about equal length.
"""

from __future__ import annotations

import numpy as np

INT = np.int32


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ..., for ``size`` each, end to end."""
    upto = np.cumsum(size)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(start - (upto - size), size)


def _groups(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, stop: np.ndarray):
    """Final group of each position (the place where it begins) and the pointers to previous smaller suffixes.

    A text lies in places begin..end - 1 behind one stop place, where pointers end.
    """
    n = len(symbols)
    text = np.repeat(np.arange(len(begin)), end - begin + 1)
    key = text * (int(symbols.max(initial=0)) + 2) + np.where(stop, 0, symbols.astype(np.int64) + 1)
    order = np.argsort(key, kind="stable").astype(INT)          # stop places stay at their text's begin - 1
    rank = np.empty(n, INT)
    rank[order] = np.arange(n, dtype=INT)
    new = np.append(True, key[order][1:] != key[order][:-1])
    heads = np.flatnonzero(new)
    size = np.zeros(n, INT)                                     # of the group that begins at a place
    size[heads] = np.diff(np.append(heads, n))
    group = np.empty(n, INT)
    group[order] = np.repeat(heads, size[heads])
    pointer = np.arange(-1, n - 1, dtype=INT)
    done = np.zeros(n, bool)
    pointed = np.zeros(n, bool)
    last, low = end - 1, begin
    while len(last):
        first = group[order[last]]
        at = order[_ranges(first, last - first + 1)]
        done[at] = True
        to = pointer[at]
        over = np.flatnonzero(done[to])
        while len(over):                                      # over what is processed already, in doubling steps
            pointer[at[over]] = to[over] = pointer[to[over]]
            over = over[done[to[over]]]
        last = first - 1
        more = last >= low
        last, low = last[more], low[more]
        to = to[~stop[to]]
        if not len(to):
            continue
        if len(to) == 1:
            up, often = to, np.ones(1, INT)
        else:
            to = np.sort(to)
            heads = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            up, often = to[heads], np.diff(np.append(heads, len(to)))
        old = group[up]
        by = np.lexsort((often, old))
        up, often, old = up[by], often[by], old[by]
        change = np.append(True, old[1:] != old[:-1])
        heads = np.flatnonzero(change)
        count = np.diff(np.append(heads, len(up)))
        olds = old[heads]
        size[olds] -= count
        top = _ranges(olds + size[olds], count)               # the places above what stays
        pointed[up] = True
        there = order[top]
        leave = there[~pointed[there]]
        pointed[up] = False
        if len(leave):
            below = rank[up] < np.repeat(olds + size[olds], count)
            free = np.sort(rank[up[below]])
            order[free] = leave
            rank[leave] = free
        order[top] = up
        rank[up] = top
        step = change | np.append(True, often[1:] != often[:-1])
        heads = np.flatnonzero(step)
        run = np.diff(np.append(heads, len(up)))
        size[top[heads]] = run
        group[up] = np.repeat(top[heads], run)
    return group, pointer


def _emit(group: np.ndarray, pointer: np.ndarray, begin: np.ndarray, end: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, text by text (stop places hold their own)."""
    n = len(group)
    out = np.arange(n, dtype=INT)
    free = np.arange(n, dtype=INT)
    placed = stop.copy()
    out[begin], at = end - 1, begin.copy()                    # the last symbol is the smallest
    placed[end - 1] = True
    stay = end
    now = out[at] - 1
    while len(at):
        fresh = ~placed[now]
        put = now[fresh]
        if len(put):
            place = free[group[put]]
            out[place] = put
            free[group[put]] += 1
            placed[put] = True
            now[fresh] = pointer[put]
        if len(put) < len(now):
            rest = np.flatnonzero(~fresh)
            at[rest] += 1
            over = at[rest] >= stay[rest]
            go = rest[~over]
            now[go] = out[at[go]] - 1
            if over.any():
                keep = np.ones(len(at), bool)
                keep[rest[over]] = False
                at, now, stay = at[keep], now[keep], stay[keep]
    return out


def suffix_arrays(symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array of each text of ``symbols`` (texts of ``sizes`` end to end), as positions in ``symbols``.

    Symbols are integers from 1; a text's end counts as smaller than every symbol.
    """
    sizes = np.asarray(sizes, np.int64)
    if not len(sizes):
        return np.zeros(0, INT)
    begin = np.cumsum(sizes + 2) - sizes - 1                  # a stop place before, an end symbol behind each text
    end = begin + sizes + 1
    n = int((sizes + 2).sum())
    stop = np.zeros(n, bool)
    stop[begin - 1] = True
    wide = np.zeros(n, INT)
    inside = _ranges(begin, sizes)
    wide[inside] = symbols
    group, pointer = _groups(wide, begin, end, stop)
    out = _emit(group, pointer, begin, end, stop)
    before = np.arange(len(sizes)) * 2 + 1                    # stop places and ends before a position
    return out[_ranges(begin + 1, sizes)] - np.repeat(before, sizes)
