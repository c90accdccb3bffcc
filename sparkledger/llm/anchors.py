"""Content-defined anchors of byte windows (winnowing), vectorised.

Every window of ``WINDOW`` bytes selects one of its ``GRAM``-byte grams: the leftmost of those with the least hash.  The
choice depends on the window's bytes alone, so equal windows select equal grams at equal offsets.  Consecutive windows that
select the same gram form a run.
"""

from __future__ import annotations

import numpy as np

from . import bytetext as B

WINDOW, GRAM = 200, 64
_SPREAD = WINDOW - GRAM + 1  # grams of a window
_BYTES = B.byte_codes(5)
_STEP = [np.uint64(pow(0x9E3779B97F4A7C15 | 1, 1 << k, 1 << 64)) for k in range(8)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each run of GRAM bytes, by doubling."""
    h = _BYTES[data]
    size = 1
    k = 0
    while size < GRAM:
        h = h[:-size] * _STEP[k] + h[size:]
        size, k = size * 2, k + 1
    return B.mix64(h)


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) of the runs of one text; none if it is shorter than a window."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    h = gram_hashes(data)
    # the hash's upper half with the place below it: the least value is the leftmost of the least hashes
    least = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= _SPREAD:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = _SPREAD - size
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    place = (least[:n] & np.uint64((1 << 32) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [n]]) - 1
    return h[place[first]], first, last
