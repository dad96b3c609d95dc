"""A worker's memory of pieces: what each distinct piece of text encodes to, looked up for many pieces at once.

Pieces are slices of one byte buffer. A slice is found by a 64-bit polynomial
hash from prefix sums and then compared byte by byte with the remembered
piece, so a collision of hashes can't give a wrong result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each slice, all in one array."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) if len(lengths) else np.empty(0, np.int64)
    return shift + np.arange(total)


class Powers:
    """Powers of a multiplier and of its inverse modulo 2**64, as far as needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _R), ("down", _R_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def slice_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice of body; equal slices have equal hashes wherever they stand."""
    n = len(body)
    up, down = _POWERS.upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= h >> np.uint64(29)
    h *= _MIX
    h ^= h >> np.uint64(32)
    return h


class PieceTable:
    """encode: ids of each of some distinct pieces, as a uint32 array a piece. At most about limit pieces are kept."""

    def __init__(self, encode: Callable[[list[bytes]], list[np.ndarray]], limit: int):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.hashes, self.entry = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.text = np.empty(0, np.uint8)
        self.text_at, self.text_len = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)
        self.ids_at, self.ids_len = np.empty(0, np.int64), np.empty(0, np.int64)

    def _add(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """New pieces, with hashes ascending and none of them known."""
        found = self.encode(pieces)
        first = len(self.text_at)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        counts = np.fromiter(map(len, found), np.int64, len(found))
        self.text_at = np.concatenate([self.text_at, len(self.text) + np.cumsum(sizes) - sizes])
        self.ids_at = np.concatenate([self.ids_at, len(self.ids) + np.cumsum(counts) - counts])
        self.text_len = np.concatenate([self.text_len, sizes])
        self.ids_len = np.concatenate([self.ids_len, counts])
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(pieces), np.uint8)])
        self.ids = np.concatenate([self.ids, *found]) if found else self.ids
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.entry = np.insert(self.entry, at, first + np.arange(len(pieces)))

    def entries(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """The entry of each slice, or None if two different pieces share a hash (then use plain())."""
        if len(self.hashes) > self.limit:
            self.clear()
        h, where, back = np.unique(slice_hashes(body, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, h)
        new = np.ones(len(h), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != h[inside]
        if new.any():
            raw = body.tobytes()
            self._add(h[new], [raw[a:b] for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist())])
            at = np.searchsorted(self.hashes, h)
        entry = self.entry[at][back]
        length = ends - starts
        if (self.text_len[entry] != length).any() or (self.text[spread(self.text_at[entry], length)] != body[spread(starts, length)]).any():
            return None
        return entry

    def looked_up(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each slice, all ids in order)."""
        entry = self.entries(body, starts, ends)
        if entry is None:
            raw = body.tobytes()
            found = self.encode([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
            return np.fromiter(map(len, found), np.int64, len(found)), np.concatenate([np.empty(0, np.uint32), *found])
        counts = self.ids_len[entry]
        return counts, self.ids[spread(self.ids_at[entry], counts)]
