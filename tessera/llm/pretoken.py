"""Splitting text into the pieces inside which byte-level BPE merges.

The split is the public byte-level pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
expressed over an array of code points: the class of each character (space,
letter, number, other) gives the runs, and four rules about spaces and
apostrophes move the run boundaries to where the pattern's matches begin.
"""

from __future__ import annotations

import functools

import numpy as np
import regex

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: Fixed values of the public pattern: what may follow an apostrophe in a match of its own.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text, where = "".join(map(chr, points)), np.array(points)
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, text):
            table[where[m.start() : m.end()]] = kind
    return table


def starts(points: np.ndarray) -> np.ndarray:
    """Positions (in code points) at which the matches over a whole text begin."""
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    kind = classes()[points]
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    space = kind == SPACE
    # The last character of a run of spaces before other text stands apart ...
    last_space = np.zeros(n, bool)
    last_space[:-1] = space[:-1] & ~space[1:]
    first |= last_space
    # ... and if it is a blank, what follows belongs to it.
    joins = last_space & (points == 0x20)
    after = np.flatnonzero(joins) + 1
    first[after] = False
    # A match that begins at an apostrophe may be a contraction.
    quotes = np.flatnonzero((points == 0x27) & first)
    if len(quotes):
        tail = np.zeros((2, len(quotes)), points.dtype)
        for k in (1, 2):
            ok = quotes + k < n
            tail[k - 1, ok] = points[quotes[ok] + k]
        for word in CONTRACTIONS:
            hit = tail[0] == ord(word[0])
            if len(word) == 2:
                hit &= tail[1] == ord(word[1])
            at = quotes[hit]
            first[at + 1] = False
            end = at + 1 + len(word)
            first[end[end < n]] = True
            # what follows an ended contraction begins anew: a second apostrophe there is a first one already
    return np.flatnonzero(first)


def cuts(text: str) -> tuple[bytes, np.ndarray]:
    """(the text in UTF-8, the byte at which each match begins)."""
    body = text.encode()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at = starts(points)
    if len(body) != len(points):
        width = np.ones(len(points), np.int64)
        for edge in (0x80, 0x800, 0x10000):
            width += points >= edge
        ends = np.cumsum(width)
        at = ends[at] - width[at]
    return body, at


def pieces(text: str) -> list[bytes]:
    """The UTF-8 bytes of each match, in order."""
    body, at = cuts(text)
    edges = [*at.tolist(), len(body)]
    return [body[a:b] for a, b in zip(edges, edges[1:])]


def stretches(text: str, limit: int):
    """A long text in stretches of about limit characters whose pieces are those of the whole.

    No match holds a blank after a character that isn't white space, so the
    matches of the whole text also end there. Without such a place the
    stretch grows until there is one.
    """
    start, n = 0, len(text)
    while n - start > limit:
        low, high, cut = start + limit // 2, start + limit, -1
        while cut < 0:
            at = text.rfind(" ", low, high)
            while at > 0 and text[at - 1].isspace():
                at = text.rfind(" ", low, at)
            cut = at if at > start else -1
            if cut < 0:
                if high >= n:
                    break
                low, high = high - 1, min(n, 2 * high - start)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]
