"""Token counts by overlap resynchronisation.

A text longer than ``chunk`` bytes is encoded in overlapping chunks with the
offset of every piece. Two neighbouring chunks are spliced at a place where
in both a piece begins, and this place is proven:

* the left chunk was scanned from a true beginning, so its pieces are those
  of the whole text up to its end less ``GUARD`` bytes (a match looks one
  character ahead, a special token is shorter than the guard);
* a match depends only on the text from where it begins, so from a common
  beginning on the right chunk's pieces are those of the whole text too.

If the overlap holds no such place it is widened to twice its size, in the
end to the last proven place itself, and the chunk grows with it.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.frames import mapped
from tessera.llm.piecetable import PieceTable
from tessera.llm.pretoken import cuts

CHUNK, OVERLAP = 1 << 14, 256
#: Pieces whose counts a worker remembers.
CACHED = 400_000


class TokenCounter:
    """Counts tokens as the tokenizers library does for a byte-level BPE file."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder().values()
        self.special = [t.content.encode() for t in added]
        self.guard = 16 + max([0, *map(len, self.special)])
        self.known = PieceTable(self._encode, CACHED)

    def _encode(self, todo: list[bytes]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast([x.decode() for x in todo], add_special_tokens=False)
        return list(np.fromiter(map(len, found), np.uint32, len(found)).reshape(-1, 1))

    def pieces(self, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(where the pieces of one text begin, in bytes; whether each is a special token)."""
        spots = []
        for s in self.special:
            at = body.find(s)
            while at >= 0:
                spots.append((at, at + len(s)))
                at = body.find(s, at + len(s))
        if not spots:
            at = cuts(body.decode())[1]
            return at, np.zeros(len(at), bool)
        begin, special, last = [], [], 0
        for a, b in sorted(spots):
            if a < last:
                continue
            at = cuts(body[last:a].decode())[1]
            begin += [at + last, np.array([a])]
            special += [np.zeros(len(at), bool), np.ones(1, bool)]
            last = b
        at = cuts(body[last:].decode())[1]
        return np.concatenate([*begin, at + last]), np.concatenate([*special, np.zeros(len(at), bool)])

    def many(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(piece beginnings, tokens of each piece) of each text, looked up together."""
        split = [self.pieces(x) for x in texts]
        shift = np.cumsum([0, *map(len, texts)])
        begin = np.concatenate([np.empty(0, np.int64), *[at + s for (at, _), s in zip(split, shift)]])
        special = np.concatenate([np.empty(0, bool), *[x for _, x in split]])
        end = np.append(begin[1:], shift[-1])[: len(begin)]
        counts = np.ones(len(begin), np.int64)
        plain = ~special
        if plain.any():
            body = np.frombuffer(b"".join(texts), np.uint8)
            counts[plain] = self.known.looked_up(body, begin[plain], end[plain])[1]
        edge = np.cumsum([0, *[len(at) for at, _ in split]])
        return [(at, counts[a:b]) for (at, _), a, b in zip(split, edge, edge[1:])]

    def count(self, body: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Tokens of one text, in overlapping chunks if it is longer than chunk bytes."""
        n, total = len(body), 0

        def character(i: int) -> int:
            while 0 < i < n and body[i] & 0xC0 == 0x80:
                i -= 1
            return i

        begin, proven, end = 0, 0, n if n <= chunk else character(chunk)
        at, counts = self.many([body[:end]])[0]
        while end < n:
            wide, size = overlap, chunk
            while True:
                start = max(character(end - wide), proven)
                stop = min(n, start + size)
                stop = n if stop == n else character(stop)
                if stop <= end:  # a chunk must bring something new
                    size *= 2
                    continue
                right_at, right_counts = self.many([body[start:stop]])[0]
                common = np.intersect1d(at + begin, right_at + start)
                common = common[(common >= proven) & (common <= end - self.guard)]
                if start == proven:  # scanned from a true beginning itself
                    splice = proven
                elif len(common):
                    splice = int(common[-1])
                else:
                    wide, size = 2 * wide, 2 * size
                    continue
                break
            left = at + begin
            total += int(counts[(left >= proven) & (left < splice)].sum())
            begin, end, proven, at, counts = start, stop, splice, right_at, right_counts
        return total + int(counts[at + begin >= proven].sum())


@lru_cache(maxsize=2)
def _loaded(digest: str, spec: bytes) -> TokenCounter:
    return TokenCounter(spec.decode())


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    n_bytes: str = "n_bytes",
    n_tokens: str = "n_tokens",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The columns keep, with the bytes (UTF-8) and tokens of every whole text.

    tokenizer is the path of a byte-level BPE file of the tokenizers library;
    the driver reads and broadcasts it. A null or empty text has 0 bytes and
    0 tokens. Special strings inside a text count as the library counts them:
    one token. Repeated rows each give their row; other columns aren't read.
    """
    if chunk < 64 or not 0 < overlap < chunk:
        raise ValueError("chunk must be 64 bytes or more and overlap smaller than it")
    with open(tokenizer, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def kernel():
        counter = _loaded(hashlib.sha256(spec.value).hexdigest(), spec.value)

        def count(body: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
            sizes = np.diff(offsets)
            text_of = lambda i: body[offsets[i] : offsets[i + 1]].tobytes()
            tokens = np.zeros(len(sizes), np.int64)
            short = np.flatnonzero((sizes > 0) & (sizes <= chunk))
            for i, (_, counts) in zip(short, counter.many([text_of(i) for i in short])):
                tokens[i] = counts.sum()
            for i in np.flatnonzero(sizes > chunk):
                tokens[i] = counter.count(text_of(i), chunk, overlap)
            return [sizes, tokens]

        return count

    return mapped(docs, keep, text, [T.StructField(n_bytes, T.LongType(), False), T.StructField(n_tokens, T.LongType(), False)], kernel)
