"""Words of Arrow text batches as numpy arrays: bounds, counts and 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from migratrace.llm.common import BLANKS

_CHUNK = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True
_UNITS = np.random.Generator(np.random.PCG64(20240607)).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_POWERS: list[np.ndarray] = []


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the bounds of its rows; a null row is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_bounds(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the bounds of each row's words among them."""
    solid = ~_BLANK[data]
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[rows] = True
    starts = np.flatnonzero(solid & (first[:n] | ~np.append(False, solid[:-1]))) if n else np.zeros(0, np.int64)
    ends = np.flatnonzero(solid & (first[1:] | ~np.append(solid[1:], False))) + 1 if n else starts
    return starts, ends, np.searchsorted(starts, rows)


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for base in (_BASE, inverse):
                _POWERS.append(np.cumprod(np.append(np.uint64(1), np.full(_CHUNK, base))))
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash of the bytes of every word; with ``lower``, A-Z count as a-z.

    Works through stretches of bounded size; a word longer than one is hashed
    in parts.
    """
    up, down = _powers()
    units = _UNITS[_LOWER] if lower else _UNITS
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        last = max(int(np.searchsorted(ends, low + _CHUNK, "right")), at)
        if last == at:  # one word longer than a stretch
            h = np.uint64(0)
            for k in range(int(low), int(ends[at]), _CHUNK):
                part = units[data[k : min(k + _CHUNK, int(ends[at]))]]
                h = mix(np.array([h + (part * up[: len(part)]).sum(dtype=np.uint64)]))[0]
            out[at] = h
            at += 1
            continue
        sums = np.zeros(int(ends[last - 1] - low) + 1, np.uint64)
        np.cumsum(units[data[low : ends[last - 1]]] * up[: len(sums) - 1], out=sums[1:])
        s, e = starts[at:last] - low, ends[at:last] - low
        out[at:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = last
    return out


def windows(hashes: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every ``size`` neighbouring words of a row: positions and hashes."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        h = mix(h + hashes[k : n - size + 1 + k])
    row = np.searchsorted(words, np.arange(n), "right") - 1
    at = np.flatnonzero(row[: n - size + 1] == row[size - 1 :])
    return at, h[at]


def per_row(flags: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of ``flags`` over each row's stretch."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[rows[1:]] - total[rows[:-1]]
