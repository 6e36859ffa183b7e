"""Words, word hashes and window hashes of many texts at once, as numpy arrays.

A hash of a span is a polynomial over its units modulo 2**64, taken from running sums, then mixed. All units of
a batch lie in one array, so no loop runs per word or per text.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Odd multipliers (they have an inverse modulo 2**64). Two give a fingerprint of 128 bits.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
BLOCK = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n. The tables grow in steps and stay in the worker."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        up = np.full(size, U(base))
        up[0] = 1
        down = np.full(size, U(pow(base, -1, 2**64)))
        down[0] = 1
        have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if n <= 4 * BLOCK:
            _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit hash."""
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(29))
    h = h * U(0xFF51AFD7ED558CCD)
    return h ^ (h >> U(32))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0], table=None) -> np.ndarray:
    """The hash of values[start:end] (or of their entries in ``table``) for each span; spans are sorted by start.

    Works through blocks of values, so that a very long text needs little memory beside itself.
    """
    out = np.empty(len(starts), U)
    if not len(starts):
        return out
    edges = np.flatnonzero(np.diff(starts // BLOCK)) + 1
    for a, b in zip([0, *edges], [*edges, len(starts)]):
        lo, hi = int(starts[a]), int(ends[a:b].max())
        up, down = powers(base, hi - lo + 1)
        sums = np.zeros(hi - lo + 1, U)
        part = values[lo:hi] if table is None else table[values[lo:hi]]
        np.cumsum(part * up[: hi - lo], out=sums[1:])
        out[a:b] = (sums[ends[a:b] - lo] - sums[starts[a:b] - lo]) * down[starts[a:b] - lo]
    return mix(out ^ ((ends - starts).astype(U) * U(0x9FB21C651E98DF25)))


def word_spans(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = WHITE):
    """(start, end, text number) of each maximal run of bytes outside ``apart``; texts lie one after another."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~apart[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    begins[bounds] = inside[bounds]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    stops[bounds - 1] = inside[bounds - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    return span_hashes(data, starts, ends, base, BYTE_VALUES)


def window_hashes(units: np.ndarray, n: int, base: int = BASES[0]) -> np.ndarray:
    """The hash of units[i : i + n] for each i that has n units after it."""
    count = len(units) - n + 1
    if count <= 0:
        return np.zeros(0, U)
    out = np.empty(count, U)
    for a in range(0, count, BLOCK):
        b = min(count, a + BLOCK)
        size = b - a + n - 1
        up, down = powers(base, size + 1)
        sums = np.zeros(size + 1, U)
        np.cumsum(units[a : a + size] * up[:size], out=sums[1:])
        out[a:b] = (sums[n:] - sums[: b - a]) * down[: b - a]
    return mix(out)


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """min(keys[i : i + width]) for each i that has ``width`` keys after it."""
    count = len(keys) - width + 1
    if count <= 0:
        return keys[:0]
    pad = -len(keys) % width
    grid = np.concatenate([keys, np.full(pad, np.iinfo(keys.dtype).max, keys.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])
