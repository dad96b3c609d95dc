"""Words of many texts at once, as hashes in numpy arrays."""

from __future__ import annotations

import numpy as np

from tessera.llm.piecetable import slice_hashes

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _word_bytes() -> np.ndarray:
    table = np.zeros(256, bool)
    for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        table[a:b] = True
    return table


WORD_BYTES = _word_bytes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def words(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first byte) of each word: a run of letters and digits (A-Z lower-cased) or bytes beyond ASCII."""
    n = len(body)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    inside = WORD_BYTES[body]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a text's begin parts words too
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | edge[1:n]
    begin, end = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return slice_hashes(LOWER[body], begin, end), np.searchsorted(offsets, begin, side="right") - 1, begin


def mix(a: np.ndarray, b: np.ndarray | None = None, kind: int = 0) -> np.ndarray:
    """One hash of one or two hashes and a kind."""
    h = a * _A + np.uint64(kind) * _C
    if b is not None:
        h += (b ^ (b >> np.uint64(31))) * _B
    h ^= h >> np.uint64(32)
    h *= _A
    return h ^ (h >> np.uint64(29))
