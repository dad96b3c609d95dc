"""SentencePiece encoding (merge type) by a table of each prefix's last token, and decoding.

Merging pieces by their scores gives every prefix of a text one sequence of
tokens, and a sequence is the one of its text exactly if each two neighbours
are: a merge across a border would show in the two tokens beside it alone. So
the last token of a prefix is the one piece that ends there and goes together
with the last token of what stands before it. An automaton finds the pieces
that end at each character, a test of pairs (merging the characters of both,
remembered) picks the one, and the ids are read off the table from the end.

No piece has a blank mark after another character, and many pairs of bytes are
in no piece at all: what stands between two such places is encoded by itself,
and repeated stretches are remembered.
"""

from __future__ import annotations

import codecs
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.frames import fresh, row_groups, text_buffers
from tessera.llm.piecetable import PieceTable, spread

#: Fixed values of the public model format: kinds of pieces, and the mark that stands for a blank.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BLANK = "▁"
MARK = BLANK.encode()
UNKNOWN_SURFACE = " ⁇ "
#: Stretches of at most so many bytes are remembered, so many a worker; new pairs too.
REMEMBERED, CACHED, PAIRS = 128, 400_000, 4_000_000
#: Bytes of text that are worked off together.
HELD = 1 << 19


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a message: integers, or the bytes of fixed-width and nested ones."""
    at, n = 0, len(message)

    def integer() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = message[at]
            at += 1
            value |= (b & 0x7F) << shift
            if b < 0x80:
                return value
            shift += 7

    while at < n:
        number, kind = divmod(integer(), 8)
        if kind == 0:
            yield number, integer()
        elif kind in (1, 2, 5):
            size = integer() if kind == 2 else 8 if kind == 1 else 4
            yield number, message[at : at + size]
            at += size
        else:
            raise ValueError(f"not a model: field {number} of kind {kind}")


class PrefixTable:
    """Encoder and decoder for a merge-type model with byte fallback, given as the bytes of its public file."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        scores, kinds = [], []
        trainer: dict = {}
        normalizer: dict = {}
        for number, value in fields(model):
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                scores.append(float(np.frombuffer(piece[2], "<f4")[0]) if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24):
            raise ValueError("not a merge-type model with byte fallback and blanks before words")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("models that rewrite characters or blanks, or have symbols of their own, aren't supported")
        self.prefixed = bool(normalizer.get(3, 1))
        self.kinds = kinds
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE}
        self.score = {p: s for p, s, k in zip(self.pieces, scores, kinds) if k == NORMAL}
        single = {p for p in self.score if len(p) == 1}
        if set("".join(self.score)) - single or any(BLANK in p.lstrip(BLANK) for p in self.score):
            raise ValueError("a piece has a character that is no piece, or a blank after another character")
        self.apart = np.ones(1 << 16, bool)  # of two neighbouring bytes whether a text can be cut between them
        for p in self.score:
            raw = np.frombuffer(p.encode(), np.uint8).astype(np.int64)
            self.apart[raw[:-1] << 8 | raw[1:]] = False
        self.apart.reshape(256, 256)[:, 0x80:0xC0] = False  # inside a character
        self.sizes = [len(p) for p in self.pieces]
        self.automaton = ahocorasick.Automaton()
        for i, (p, k) in enumerate(zip(self.pieces, kinds)):
            if k == NORMAL and len(self.merged(p)) == 1:  # one that its own characters don't merge to never occurs
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.known = PieceTable(self.encode_stretches, CACHED)
        surface = [self._surface(i) for i in range(len(self.pieces))]
        self.surface_len = np.fromiter(map(len, surface), np.int64, len(surface))
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        self.surface = np.frombuffer(b"".join(surface), np.uint8)

    def _surface(self, i: int) -> bytes:
        kind, piece = self.kinds[i], self.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return b"" if kind == CONTROL else (UNKNOWN_SURFACE if kind == UNKNOWN else piece.replace(BLANK, " ")).encode()

    def merged(self, text: str, border: int = 0) -> list[str]:
        """The characters of a short text merged by the best score, leftmost first; [] once a merge crosses the border."""
        parts, score = list(text), self.score
        at = list(range(len(parts)))
        while True:
            best, where = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, where = s, i
            if where < 0:
                return parts
            if border and at[where + 1] == border:
                return []
            parts[where] += parts.pop(where + 1)
            del at[where + 1]

    def together(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart beside each other."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            text = self.pieces[left]
            known = self.pairs[key] = bool(self.merged(text + self.pieces[right], len(text)))
        return known

    def last_tokens(self, text: str) -> array:
        """For each number of characters the last token of the prefix, -1 if its last character is in no piece."""
        last = array("i", [-1]) * (len(text) + 1)
        done, pairs = 0, self.pairs
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if end > done:
                left = last[end - size]
                if left < 0:  # nothing merges with the begin of a text or a character in no piece
                    ok = True
                else:
                    ok = pairs.get(left << 32 | token)
                    if ok is None:
                        ok = self.together(left, token)
                if ok:
                    last[end] = token
                    done = end
        return last

    def ids(self, text: str) -> np.ndarray:
        """The ids of a normalized text, from its end to its begin."""
        last, sizes, at, out = self.last_tokens(text), self.sizes, len(text), array("I")
        while at:
            token = last[at]
            if token >= 0:
                out.append(token)
                at -= sizes[token]
            else:
                at -= 1
                out.extend(self.byte_id[b] for b in reversed(text[at].encode()))
        return np.frombuffer(out, np.uint32)[::-1]

    def encode_stretches(self, todo: list[bytes]) -> list[np.ndarray]:
        return [self.ids(x.decode()) for x in todo]

    def _flush(self, parts: list[tuple[int, bytes]], out: list[list[np.ndarray]]) -> None:
        """Encode gathered parts (text number, normalized bytes) together and add the ids of each to its text."""
        if not parts:
            return
        body = np.frombuffer(b"".join(x for _, x in parts), np.uint8)
        edge = np.cumsum([0, *[len(x) for _, x in parts]])
        blank = np.zeros(len(body), bool)
        if len(body) > 2:
            blank[:-2] = (body[:-2] == MARK[0]) & (body[1:-1] == MARK[1]) & (body[2:] == MARK[2])
        first = blank.copy()
        first[3:] &= ~blank[:-3]
        first[1:] |= self.apart[body[:-1].astype(np.int64) << 8 | body[1:]]
        first[edge[:-1]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(body))
        short = ends - starts <= REMEMBERED
        counts = np.zeros(len(starts), np.int64)
        counts[short], ids = self.known.looked_up(body, starts[short], ends[short])
        if not short.all():
            found = self.encode_stretches([body[a:b].tobytes() for a, b in zip(starts[~short].tolist(), ends[~short].tolist())])
            counts[~short] = [len(x) for x in found]
            at = np.cumsum(counts) - counts
            every = np.empty(int(counts.sum()), np.uint32)
            every[spread(at[short], counts[short])] = ids
            every[spread(at[~short], counts[~short])] = np.concatenate(found)
            ids = every
        stop = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, edge)].tolist()
        for (i, _), a, b in zip(parts, stop, stop[1:]):
            out[i].append(ids[a:b])
        parts.clear()

    def _normalized(self, text: bytes) -> Iterator[bytes]:
        """The text with marks for blanks, a long one in parts that begin with a mark after another character."""
        body = text.replace(b" ", MARK)
        if body and self.prefixed:
            body = MARK + body
        at, n = 0, len(body)
        while n - at > HELD:
            cut = at + HELD // 2
            while (cut := body.find(MARK, cut)) >= 0 and body[cut - 3 : cut] == MARK:
                cut += 3
            if cut < 0:
                break
            yield body[at:cut]
            at = cut
        if at < n:
            yield body[at:]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text (UTF-8) with the begin and end ids, as little-endian unsigned 32-bit integers."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        parts: list[tuple[int, bytes]] = []
        held = 0
        for i, text in enumerate(texts):
            for part in self._normalized(text):
                parts.append((i, part))
                held += len(part)
                if held >= HELD:
                    self._flush(parts, out)
                    held = 0
        self._flush(parts, out)
        begin, end = np.array([self.begin], np.uint32), np.array([self.end], np.uint32)
        return [np.concatenate([begin, *x, end]).astype("<u4").tobytes() for x in out]

    def decode(self, texts: list[bytes]) -> list[str]:
        """The texts of ids: control ids are silent, and of a text's first piece a leading blank goes if one was put there."""
        ids = np.frombuffer(b"".join(texts), "<u4").astype(np.int64)
        sizes = self.surface_len[ids]
        raw = self.surface[spread(self.surface_at[ids], sizes)].tobytes()
        stop = np.cumsum([0, *[len(x) // 4 for x in texts]])
        at = np.concatenate([[0], np.cumsum(sizes)])[stop].tolist()
        silent = np.array([k == CONTROL for k in self.kinds])[ids]
        out = []
        for a, b, i, k in zip(at, at[1:], stop.tolist(), stop[1:].tolist()):
            while i < k and silent[i]:
                i += 1
            if self.prefixed and i < k and self.kinds[ids[i]] == NORMAL and self.pieces[ids[i]].startswith(BLANK):
                a += 1
            part = raw[a:b]
            inside = np.flatnonzero(silent[i:k]) if silent[i : max(i, k - 1)].any() else []
            if len(inside):  # bytes on both sides of a silent id aren't one character
                cut = [0, *(np.cumsum(sizes[i:k])[inside] - (len(part) < sizes[i:k].sum())).tolist(), len(part)]
                out.append("".join(_text(part[x:y]) for x, y in zip(cut, cut[1:])))
            else:
                out.append(_text(part))
        return out


def _text(raw: bytes) -> str:
    """The bytes as text; each byte that isn't UTF-8 becomes a replacement character."""
    return raw.decode("utf-8", "each_byte")


codecs.register_error("each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


@lru_cache(maxsize=2)
def _loaded(digest: str, model: bytes) -> PrefixTable:
    return PrefixTable(model)


def loaded(model: bytes) -> PrefixTable:
    """One encoder a worker for each model."""
    return _loaded(hashlib.sha256(model).hexdigest(), model)


def encode_decode(
    docs: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """The columns keep, with the ids of every whole text (begin and end included) and the text decoded from them.

    ids is binary: little-endian unsigned 32-bit integers. model is the path of
    a merge-type model, which the driver reads and broadcasts (a vocabulary:
    its size doesn't depend on the data). A null or empty text has only the
    begin and end ids and decodes to the empty text; blank marks of a text
    decode as blanks, as in the library. Repeated rows each give their row;
    other columns of docs aren't read.
    """
    with open(model, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = docs.select(*keep)
    fresh(kept, ids, decoded)
    rows = docs.select(*keep, docs[text].alias("__text"))
    width = len(kept.columns)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.BinaryType(), False), T.StructField(decoded, T.StringType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = loaded(spec.value)
        for batch in batches:
            body, offsets = text_buffers(batch.column(width))
            for a, b in row_groups(offsets):
                edge = offsets[a : b + 1].tolist()
                coded = table.encode([body[i:k].tobytes() for i, k in zip(edge, edge[1:])])
                columns = [batch.column(c).slice(a, b - a) for c in range(width)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(coded, pa.binary()), pa.array(table.decode(coded), pa.string())], names=[*keep, ids, decoded])

    return rows.mapInArrow(work, schema)
