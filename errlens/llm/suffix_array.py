"""Suffix array by linear grouping construction.

Phase 1 sorts suffixes into groups that share their Lyndon prefix.  Groups
are processed from the highest to the lowest.  For each suffix of a group
the pointer to the previous suffix of a lower group is found by following
the pointers of higher groups.  Suffixes that are pointed to are moved,
out of their own group, to new groups right after it: the more suffixes of
the processed group point to one, the higher its new group.

Phase 2 walks the final order once.  Each suffix put in place lets the one
before it, and in turn that one's pointers, take the next free place of
their groups.  No suffix is renamed and nothing is sorted recursively.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of an integer text whose last symbol is its unique smallest."""
    n = len(text)
    if n <= 1:
        return np.arange(n)
    order = np.argsort(text, kind="stable")
    sorted_text = text[order]
    starts = np.r_[0, np.flatnonzero(sorted_text[1:] != sorted_text[:-1]) + 1]
    sizes = np.diff(np.r_[starts, n])
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    group_of = np.empty(n, np.int64)
    group_of[order] = np.repeat(starts, sizes)
    sa: list[int] = order.tolist()
    at: list[int] = place.tolist()          # place of each suffix in sa
    group: list[int] = group_of.tolist()    # a group is named by its first place
    last = [0] * n                          # last place of each group
    for s, k in zip(starts.tolist(), sizes.tolist()):
        last[s] = s + k - 1
    prev = [-1] * n
    top = n - 1
    while top >= 0:
        g = group[sa[top]]
        # pointers, in text order: a pointer into the same group is that suffix's own pointer
        count: dict[int, int] = {}
        for s in (sorted(sa[g:top + 1]) if top > g else (sa[g],)):
            p = s - 1
            while p >= 0 and group[p] > g:
                p = prev[p]
            if p >= 0 and group[p] == g:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                count[p] = count.get(p, 0) + 1
        if len(count) == 1:
            (p, _), = count.items()
            _move(p, group, last, sa, at)
        elif count:
            by_count: dict[int, dict[int, list[int]]] = {}
            for p, c in count.items():
                by_count.setdefault(c, {}).setdefault(group[p], []).append(p)
            for c in sorted(by_count, reverse=True):
                for h, members in by_count[c].items():
                    end = last[h]
                    for p in members:
                        k, other = at[p], sa[end]
                        sa[k], sa[end] = other, p
                        at[other], at[p] = k, end
                        end -= 1
                    if end >= h:
                        new = end + 1
                        last[new], last[h] = last[h], end
                        for p in members:
                            group[p] = new
        top = g - 1
    out = [-1] * n
    nxt = list(range(n))                    # next free place of each group
    placed = bytearray(n)
    out[0] = n - 1                          # the smallest suffix
    placed[n - 1] = 1
    nxt[group[n - 1]] += 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[nxt[g]] = j
            nxt[g] += 1
            placed[j] = 1
            j = prev[j]
    return np.array(out)


def _move(p: int, group: list[int], last: list[int], sa: list[int], at: list[int]) -> None:
    """Put one suffix into a new group right after the rest of its group."""
    h = group[p]
    end = last[h]
    if end == h:
        return
    k, other = at[p], sa[end]
    sa[k], sa[end] = other, p
    at[other], at[p] = k, end
    group[p] = end
    last[end], last[h] = end, end - 1
