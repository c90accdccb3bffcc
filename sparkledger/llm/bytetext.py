"""Vectorised kernels over the UTF-8 buffers of Arrow string columns.

Everything here works on whole texts.  A batch is walked in slices of whole rows of at most ``max_bytes`` text bytes (a
single longer row forms a slice of its own), so the numpy temporaries of a task stay bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64); returns a new array."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def byte_codes(seed: int) -> np.ndarray:
    """256 pseudo-random 64-bit codes, one for each byte value."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * _BASE + np.uint64(seed))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least n + 1 of each."""
    if not _POWERS or len(_POWERS["up"]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        with np.errstate(over="ignore"):
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            up, down = np.full(size, _BASE), np.full(size, inverse)
            up[0] = down[0] = 1
            _POWERS["up"], _POWERS["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS["up"], _POWERS["down"]


def utf8_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; row i is bytes[offsets[i]:offsets[i + 1]].  A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1] if offsets is not None and len(column) else np.zeros(len(column) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    offs = offs.astype(np.int64)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def row_slices(offsets: np.ndarray, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most max_bytes each; a longer row comes alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def lut(allowed: bytes | None = None, excluded: bytes | None = None) -> np.ndarray:
    """A table of 256 booleans."""
    table = np.zeros(256, dtype=bool) if excluded is None else np.ones(256, dtype=bool)
    table[list(allowed or b"")] = True
    table[list(excluded or b"")] = False
    return table


def fold_ascii() -> np.ndarray:
    """A byte table that lower-cases A-Z alone."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


class Words:
    """The words of a slice of rows: start and end byte of each, and offsets of each row's words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
        n = len(data)
        inside = np.zeros(n + 1, dtype=bool)
        np.take(word_bytes, data, out=inside[:n])
        before = np.zeros(n + 1, dtype=bool)
        before[1:] = inside[:n]
        edges = offsets[1:-1]
        edges = np.unique(edges[(edges > 0) & (edges < n)])
        joined = edges[inside[edges] & before[edges]]  # a word may not run over a row's end
        before[joined] = False
        self.starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(before & ~inside)
        self.ends = np.sort(np.concatenate([ends, joined])) if len(joined) else ends
        self.rows = np.searchsorted(self.starts, offsets)

    def hashes(self, data: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each word's bytes under the given codes."""
        up, down = powers(len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(codes[data] * up[: len(data)], out=sums[1:])
        return mix64((sums[self.ends] - sums[self.starts]) * down[self.starts])


_STEPS = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of n words (across rows too: the caller keeps those inside a row)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = words[:count] * _STEPS[0]
    for k in range(1, n):
        total += words[k : k + count] * _STEPS[k]
    return mix64(total)


def short_hash(words: np.ndarray) -> np.uint64:
    """The hash of a whole row of fewer words than a gram has; another family than gram_hashes of other lengths."""
    return gram_hashes(words, len(words))[0] ^ np.uint64(0xA5A5A5A5 + len(words))
