"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A piece of n bytes has n - 1 adjacent pairs. The leaves of a segment tree hold
for each pair ``rank * leaves + position`` (or a large number if the pair
can't merge) and every inner node the smaller of its children, so the root
yields the leftmost pair of the lowest rank. A merge changes three leaves and
the logarithmic paths above them; it ends when the root has no mergeable pair.
Short pieces are worked off many at a time (one tree per row of an array),
long ones by a tree of their own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.frames import fresh, row_groups, text_buffers
from tessera.llm.piecetable import PieceTable, spread
from tessera.llm.pretoken import cuts, stretches

#: Pieces longer than this get a tree of their own.
WIDE = 256
#: Leaves of the trees that are worked off together.
TREE_CELLS = 1 << 20
#: Pieces whose ids a worker remembers.
CACHED = 400_000
#: Characters of a long text that are cut into pieces at once.
STRETCH = 1 << 18

_NONE = np.iinfo(np.int32).max


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class SegmentTreeBpe:
    """Encoder and decoder for a byte-level BPE given as the JSON text of a public tokenizer file."""

    def __init__(self, spec: str):
        doc = json.loads(spec)
        model = doc["model"]
        kinds = (model.get("type", "BPE"), (doc.get("pre_tokenizer") or {}).get("type"), doc.get("normalizer"))
        if kinds != ("BPE", "ByteLevel", None) or model.get("ignore_merges") or doc["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"not a plain byte-level BPE: {kinds}")
        letters, vocab = byte_letters(), model["vocab"]
        self.special = {t["content"]: t["id"] for t in doc.get("added_tokens", [])}
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in doc.get("added_tokens", [])):
            raise ValueError("added tokens that take the spaces beside them aren't supported")
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * self.size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token) if token not in self.special else token.encode()
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.first = np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.first[b] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int32)
        self.rank_of = dict(zip(key.tolist(), range(len(key))))
        sizes = np.array([len(x) for x in self.bytes_of], np.int64)
        self.letters = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.letters_at, self.letters_len = np.cumsum(sizes) - sizes, sizes
        self.known = PieceTable(self.encode_pieces, CACHED)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or -1."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def _encode_rows(self, rows: list[bytes], leaves: int) -> list[np.ndarray]:
        """Pieces of at most leaves bytes, one tree a row. Key of a leaf: rank * leaves + position."""
        m, p = len(rows), leaves
        size = np.fromiter(map(len, rows), np.int64, m)
        cells = np.arange(p) < size[:, None]
        ids = np.zeros((m, p), np.int32)
        ids[cells] = self.first[np.frombuffer(b"".join(rows), np.uint8)]
        tree = np.full((m, 2 * p), _NONE, np.int32)
        rank = self._ranks(ids[:, :-1][cells[:, 1:]], ids[:, 1:][cells[:, 1:]])
        spot = np.broadcast_to(np.arange(p - 1), (m, p - 1))[cells[:, 1:]]
        leaf = np.full((m, p - 1), _NONE, np.int32)
        leaf[cells[:, 1:]] = np.where(rank >= 0, rank * p + spot, _NONE)
        tree[:, p : 2 * p - 1] = leaf
        width = p // 2
        while width:
            np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2], out=tree[:, width : 2 * width])
            width //= 2
        after = np.broadcast_to(np.arange(1, p + 1, dtype=np.int32), (m, p)).copy()
        after[np.arange(m), size - 1] = p  # p: none
        before = np.broadcast_to(np.arange(-1, p - 1, dtype=np.int32), (m, p)).copy()
        flat, ids1, after1, before1, alive1 = tree.reshape(-1), ids.reshape(-1), after.reshape(-1), before.reshape(-1), cells.reshape(-1)
        row = np.flatnonzero(tree[:, 1] < _NONE)
        while len(row):
            root = flat[row * (2 * p) + 1]
            open_ = root < _NONE
            row, root = row[open_], root[open_]
            if not len(row):
                break
            base, rank, pos = row * p, root // p, root % p
            here = base + pos
            gone = after1[here].astype(np.int64)
            new = self.merged[rank]
            ids1[here] = new
            alive1[base + gone] = False
            nxt = after1[base + gone].astype(np.int64)
            after1[here] = nxt
            right = nxt < p
            before1[(base + nxt)[right]] = pos[right]
            prev = before1[here].astype(np.int64)
            left = prev >= 0
            key_here = np.full(len(row), _NONE, np.int32)
            r = self._ranks(new[right], ids1[(base + nxt)[right]])
            key_here[right] = np.where(r >= 0, r * p + pos[right], _NONE)
            key_prev = np.full(len(row), _NONE, np.int32)
            r = self._ranks(ids1[(base + prev)[left]], new[left])
            key_prev[left] = np.where(r >= 0, r * p + prev[left], _NONE)
            # the three leaves, then their paths to the root
            root_of = row * (2 * p)
            flat[root_of + p + gone] = _NONE
            flat[root_of + p + pos] = key_here
            flat[(root_of + p + prev)[left]] = key_prev[left]
            node = np.concatenate([p + gone, p + pos, p + np.where(left, prev, pos)])
            root_of = np.concatenate([root_of] * 3)
            while node[0] > 1:
                node >>= 1
                child = root_of + 2 * node
                flat[root_of + node] = np.minimum(flat[child], flat[child + 1])
        out = ids[cells].astype(np.uint32)
        ends = np.cumsum(cells.sum(axis=1)).tolist()
        return [out[a:b] for a, b in zip([0, *ends], ends)]

    def _encode_one(self, piece: bytes) -> np.ndarray:
        """One long piece, by a tree in a list."""
        n, size, rank_of, merged = len(piece), self.size, self.rank_of, self.merged.tolist()
        leaves = 1 << (n - 1).bit_length()
        none = (len(merged) + 1) * leaves
        ids = self.first[np.frombuffer(piece, np.uint8)].tolist()
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]

        def key(a: int, b: int) -> int:
            if a < 0 or b < 0:
                return none
            r = rank_of.get(ids[a] * size + ids[b], -1)
            return none if r < 0 else r * leaves + a

        tree = [none] * (2 * leaves)
        for a in range(n - 1):
            tree[leaves + a] = key(a, a + 1)
        for i in range(leaves - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        while tree[1] < none:
            rank, a = divmod(tree[1], leaves)
            b = after[a]
            ids[a], ids[b] = merged[rank], -1
            after[a] = c = after[b]
            if c >= 0:
                before[c] = a
            z = before[a]
            changed = [(b, none), (a, key(a, c))]
            if z >= 0:
                changed.append((z, key(z, a)))
            for at, value in changed:
                i = leaves + at
                tree[i] = value
                i >>= 1
                while i:
                    x, y = tree[2 * i], tree[2 * i + 1]
                    best = x if x < y else y
                    if tree[i] == best:
                        break
                    tree[i] = best
                    i >>= 1
        return np.array([i for i in ids if i >= 0], np.uint32)

    def encode_pieces(self, todo: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        by_leaves: dict[int, list[int]] = {}
        out: list = [b""] * len(todo)
        for i, piece in enumerate(todo):
            if len(piece) > WIDE:
                out[i] = self._encode_one(piece)
            elif piece:
                by_leaves.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for leaves, rows in by_leaves.items():
            step = max(1, TREE_CELLS // leaves)
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                for i, ids in zip(part, self._encode_rows([todo[i] for i in part], leaves)):
                    out[i] = ids
        return out

    def _parts(self, text: str) -> Iterator[tuple[str, int]]:
        """(ordinary text, -1) and (special token, id) in order; specials are found before the split into pieces."""
        at = 0
        while self.special:
            found = [(i, -len(s), s) for s in self.special if (i := text.find(s, at)) >= 0]
            if not found:
                break
            i, _, s = min(found)
            if i > at:
                yield text[at:i], -1
            yield s, self.special[s]
            at = i + len(s)
        if at < len(text):
            yield (text[at:] if at else text), -1

    def _flush(self, parts: list[tuple[int, bytes, np.ndarray]], out: list[list[np.ndarray]]) -> None:
        """Encode gathered parts (text number, bytes, where pieces begin) together and add the ids of each to its text."""
        if not parts:
            return
        shift = np.cumsum([0, *[len(body) for _, body, _ in parts]])
        starts = np.concatenate([at + s for (_, _, at), s in zip(parts, shift)])
        body = np.frombuffer(b"".join(x for _, x, _ in parts), np.uint8)
        counts, ids = self.known.looked_up(body, starts, np.append(starts[1:], shift[-1]))
        per_part = np.add.reduceat(counts, np.cumsum([0, *[len(at) for _, _, at in parts[:-1]]]))
        ends = np.cumsum(per_part).tolist()
        for (i, _, _), a, b in zip(parts, [0, *ends], ends):
            out[i].append(ids[a:b])
        parts.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes. New pieces of all texts are worked off together, a long text in stretches."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        parts: list[tuple[int, bytes, np.ndarray]] = []
        held = 0
        for i, text in enumerate(texts):
            for part, special in self._parts(text):
                if special >= 0:
                    self._flush(parts, out)
                    out[i].append(np.array([special], np.uint32))
                    continue
                for s in stretches(part, STRETCH):
                    body, at = cuts(s)
                    parts.append((i, body, at))
                    held += len(body)
                    if held >= 2 * STRETCH:
                        self._flush(parts, out)
                        held = 0
        self._flush(parts, out)
        return [np.concatenate([np.empty(0, np.uint32), *x]).astype("<u4").tobytes() for x in out]

    def decode(self, texts: list[bytes]) -> list[str]:
        """The texts of ids as encode() gives them, special tokens included; bytes that aren't UTF-8 are replaced."""
        ids = np.frombuffer(b"".join(texts), "<u4")
        sizes = self.letters_len[ids]
        raw = self.letters[spread(self.letters_at[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *[len(x) // 4 for x in texts]])].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=2)
def _loaded(digest: str, spec: bytes) -> SegmentTreeBpe:
    return SegmentTreeBpe(spec.decode())


def loaded(spec: bytes) -> SegmentTreeBpe:
    """One encoder a worker for each tokenizer."""
    return _loaded(hashlib.sha256(spec).hexdigest(), spec)


def encode_decode(
    docs: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """The columns keep, with the token ids of every whole text and the text decoded from these ids.

    ids is binary: little-endian unsigned 32-bit integers (``id_array`` gives
    an array). tokenizer is the path of a byte-level BPE file, which the driver
    reads and broadcasts (a vocabulary: its size doesn't depend on the data).
    A null or empty text has empty ids and decodes to the empty text. Repeated
    rows each give their row; other columns of docs aren't read. Special
    strings inside a text become their token, as in the tokenizers library.
    """
    with open(tokenizer, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(*keep, docs[text].alias("__text"))
    fresh(docs.select(*keep), ids, decoded)
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(ids, T.BinaryType(), False), T.StructField(decoded, T.StringType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(spec.value)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            _, sizes = text_buffers(column)
            for a, b in row_groups(sizes):
                part = batch.slice(a, b - a)
                coded = bpe.encode([x or "" for x in part.column(part.num_columns - 1).to_pylist()])
                back = bpe.decode(coded)
                columns = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(coded, pa.binary()), pa.array(back, pa.string())], names=[*keep, ids, decoded])

    return rows.mapInArrow(work, schema)


def id_array(ids: bytes | None) -> list[int]:
    """The ids of one text as integers."""
    return np.frombuffer(ids or b"", "<u4").tolist()
