"""Hashes of every window of a byte string, and the anchors that every long window of it chooses by content alone."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from junctionflow.llm.common import mix

_POSITION_BITS = 24
_BASE = 0x9E3779B97F4A7C55  # odd, so that its powers have inverses modulo 2^64
_STEP = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=2)
def _byte_values(seed: int) -> np.ndarray:
    """A 64-bit value for each byte."""
    return mix(np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * seed))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base, and of its inverse."""
    up, down = np.full(n, np.uint64(_BASE)), np.full(n, np.uint64(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def rolled(data: np.ndarray, length: int) -> np.ndarray:
    """A cheap hash of each window of ``length`` bytes, good enough to choose anchors by: texts can be made whose
    different windows have one hash, so that it proves nothing equal."""
    n = len(data)
    up, down = _powers(1 << max(14, n.bit_length()))
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_byte_values(0)[data] * up[:n], out=sums[1:])
    return mix((sums[length:] - sums[: n + 1 - length]) * down[: n + 1 - length])


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of each window of ``length`` bytes that has no such pairs: windows of 1, 2, 4, ... bytes are hashed from
    two halves, with bits spread at each step, and the powers of two in ``length`` put together likewise."""
    power, done, out, h = 1, 0, None, _byte_values(1)[data]
    while True:
        if length & power:
            part = h[done : done + len(data) - length + 1]
            out = part.copy() if out is None else mix(out * _STEP + part)
            done += power
        power *= 2
        if power > length:
            return mix(out + np.uint64(length))
        m = len(h) - power // 2
        h = h[:m] * _STEP + (h[power // 2 :] ^ (h[power // 2 :] >> np.uint64(29)))
        h ^= h >> np.uint64(32)


def anchors(data: np.ndarray, window: int, core: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last, hash): each start of a ``window``-byte string chooses the ``core``-byte part in it whose hash
    is least, the leftmost on a tie. Starts first..last choose the part at ``place``. Equal strings choose alike."""
    n = len(data) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    w = window - core + 1
    g = rolled(data, core)
    low = np.uint64((1 << _POSITION_BITS) - 1)
    keys = (g & ~low) | np.arange(len(g), dtype=np.uint64)
    blocks = np.full(-(-len(keys) // w) * w, np.iinfo(np.uint64).max)
    blocks[: len(keys)] = keys
    rows = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(behind[:n], ahead[w - 1 : w - 1 + n]) & low).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    place = place[first]
    return place, first, last, g[place]
