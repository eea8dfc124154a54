"""Suffix sorting by grouping: no recursion and no renaming, linear in the text's length."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffixes of text (non-negative integers, of which the last is the only smallest one), in order.

    First every suffix is put into a group by its longest Lyndon prefix; groups lie in the order of these prefixes.
    At the start groups hold suffixes of equal first symbol; they are gone through in descending order. Each member's
    pointer leads to the nearest suffix before it in a smaller group, whose prefix it extends: what n members of a
    group point to moves behind the rest of its own group, the further the larger n is. When all groups are done,
    suffixes are emitted in ascending order: each one is what follows the Lyndon prefix of those that its
    predecessor's pointers lead to, so these come next in their groups."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(text[order]) != 0])
    starts = np.repeat(first, np.diff(np.r_[first, n]))
    sa: list[int] = order.tolist()
    at, group, size = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    at[order], group[order], size[first] = np.arange(n), starts, np.diff(np.r_[first, n])
    at, group, size = at.tolist(), group.tolist(), size.tolist()
    prev = [-1] * n
    high = n
    while high > 0:
        start = group[sa[high - 1]]
        if start == high - 1:
            s = sa[start]
            p = s - 1
            while p >= 0 and group[p] > start:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                g = group[p]
                left = size[g] - 1
                if left:
                    e = g + left
                    q, a = sa[e], at[p]
                    sa[a], sa[e], at[q], at[p] = q, p, a, e
                    size[g], size[e], group[p] = left, 1, e
            high = start
            continue
        members = sa[start:high]
        high = start
        for s in members:
            p = s - 1
            while p >= 0 and group[p] > start:
                p = prev[p]
            prev[s] = p
        counts: dict[int, int] = {}
        for s in members:
            p = prev[s]
            if p >= 0 and group[p] == start:  # follow members to what lies before them, shortening the way
                chain = [s]
                while p >= 0 and group[p] == start:
                    chain.append(p)
                    p = prev[p]
                for x in chain:
                    prev[x] = p
        for s in members:
            p = prev[s]
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        if not counts:
            continue
        most = max(counts.values())
        if most == 1:
            levels = [list(counts)]
        else:
            levels = [[] for _ in range(most)]
            for p, k in counts.items():
                levels[most - k].append(p)
        for moving in levels:
            for p in moving:
                g = group[p]
                left = size[g] - 1
                size[g] = left
                e, a = g + left, at[p]
                q = sa[e]
                sa[a], sa[e], at[q], at[p] = q, p, a, e
            moved: dict[int, int] = {}
            for p in moving:
                g = group[p]
                moved[g] = moved.get(g, 0) + 1
            for g, k in moved.items():
                moved[g] = g + size[g]
                size[g + size[g]] = k
            for p in moving:
                group[p] = moved[group[p]]
    placed = bytearray(n)
    following = list(range(n))  # of a group's start: where its next suffix goes
    out = [0] * n
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            k = following[g]
            out[k] = s
            following[g] = k + 1
            placed[s] = 1
            s = prev[s]
    return np.array(out, dtype=np.int64)
