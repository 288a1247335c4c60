"""Vectorised text primitives over Arrow string columns.

A text column is read as its UTF-8 byte buffer; words, lines and 64-bit
content hashes come from numpy passes over the bytes.  Work goes slice by
slice (:func:`slices`), so memory is bounded by the slice size, or by the one
text that is longer than it.  NULL counts as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15


def _byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo:hi + 1] = True
    return out


#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = _byte_class((0x20, 0x20), (0x09, 0x0D))
#: Letters, digits and every byte of a non-ASCII character (after lower-casing).
ALNUM = _byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: A-Z to a-z; other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(32)
    return x


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    filled, factor = 1, base & _MASK
    while filled < n:
        m = min(filled, n - filled)
        out[filled:filled + m] = out[:m] * np.uint64(factor)
        factor = factor * factor & _MASK
        filled += m
    return out


_TABLES: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES[0]) < n:
        size = max(n, 1 << 16)
        _TABLES[:] = [_power_table(_BASE, size), _power_table(pow(_BASE, -1, 1 << 64), size)]
    return _TABLES[0], _TABLES[1]


def string_column(col: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One string array with 64-bit offsets, NULL as ''."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.large_string()), "")


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and n + 1 offsets of a large-string array."""
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]] if len(offsets) else buf[:0], offsets - (offsets[0] if len(offsets) else 0)


def slices(col: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` (or one longer text)."""
    _, off = raw(col)
    i, n = 0, len(col)
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def spans(member: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``member`` bytes; no run crosses a text."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = member.copy(), member.copy()
    start[1:] &= ~member[:-1]
    end[:-1] &= ~member[1:]
    full = np.flatnonzero(off[1:] > off[:-1])
    first, last = off[full], off[full + 1] - 1
    start[first] = member[first]
    end[last] = member[last]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = SLICE_BYTES) -> np.ndarray:
    """64-bit hash of each span's bytes (spans ascending, not overlapping)."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + step, side="right")))
        a, b = int(starts[i]), int(ends[j - 1])
        power, inverse = _powers(b - a + 1)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[buf[a:b]] * power[:b - a], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


def per_text(starts: np.ndarray, off: np.ndarray) -> np.ndarray:
    """n + 1 positions: the spans of text i are ``[out[i], out[i + 1])``."""
    return np.searchsorted(starts, off)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive values (``len(h) - width + 1`` of them)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = 1
    for k in range(width):
        factor = factor * 0xC2B2AE3D27D4EB4F & _MASK
        out += h[k:k + n] * np.uint64(factor)
    return mix(out)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(s, s + n)`` for each pair."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    out = np.ones(total, np.int64)
    at = np.cumsum(lengths)[:-1]
    out[0] = starts[0]
    out[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(out)
