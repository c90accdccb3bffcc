"""Two-stage suffix sorting, vectorised, and adjacent common prefixes up to a depth.

Stage one sorts directly only the suffixes that are smaller than their successor (by their first ``depth`` bytes).  Stage two
scans the buckets of the first byte in ascending order: the suffix before each sorted one, if it is larger than that one,
goes to the next place of its own bucket.  The order is exact in the first ``depth`` bytes; suffixes that agree in these
stand side by side in any order.
"""

from __future__ import annotations

import numpy as np

_ROWS = 1 << 15


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """For each suffix, whether it is smaller than its successor; the empty suffix is the least of all."""
    n = len(t)
    up = np.zeros(n, dtype=bool)
    if n > 1:
        up[:-1] = t[:-1] < t[1:]
        same = np.concatenate([t[:-1] == t[1:], [False]])
        until = np.where(same, n, np.arange(n))  # the next place whose successor differs
        until = np.minimum.accumulate(until[::-1])[::-1]
        up = up[until]
    return up


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """The order of all suffixes of the bytes t, exact in their first depth bytes."""
    n = len(t)
    if not n:
        return np.zeros(0, dtype=np.int64)
    up = smaller_than_next(t)
    padded = np.concatenate([t, np.zeros(depth, dtype=np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(padded, depth)
    direct = np.flatnonzero(up)[::-1]  # of those that end within the depth, the shorter comes first
    keys = np.ascontiguousarray(view[direct]).view(f"S{depth}").ravel()
    direct = direct[np.argsort(keys, kind="stable")]
    del keys
    edges = np.searchsorted(t[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[t[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        level = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, dtype=np.int64)
        parts = []
        while len(level):  # suffixes that begin with one more c than those before
            parts.append(level)
            before = level[level > 0] - 1
            level = before[t[before] == c]
        parts.append(direct[edges[c] : edges[c + 1]])
        bucket = np.concatenate(parts)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[t[before] > c]
        if len(before):
            first = t[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(before, cuts):
                waiting[t[part[0]]].append(part)
    return np.concatenate(out)


def adjacent_prefixes(t: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in the order, at most depth; 0 for the first."""
    n = len(t)
    padded = np.concatenate([t, np.zeros(depth, dtype=np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(padded, depth)
    out = np.zeros(n, dtype=np.int64)
    for lo in range(1, n, _ROWS):
        hi = min(n, lo + _ROWS)
        differ = view[order[lo:hi]] != view[order[lo - 1 : hi - 1]]
        first = differ.argmax(axis=1)
        out[lo:hi] = np.where(differ[np.arange(hi - lo), first], first, depth)
    room = n - order
    out[1:] = np.minimum(out[1:], np.minimum(room[1:], room[:-1]))
    return out
