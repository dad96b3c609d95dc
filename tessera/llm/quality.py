"""Quality by attention-based multiple-instance learning.

A document is a bag of passages (64 words each, of the whole text). Every
passage is encoded from the frequencies of its neighbouring character classes
and hashed byte trigrams and a few measures of its words; a gated attention
(tanh times sigmoid) weighs the passages, and the weighted sum of their codes
is scored. Only the documents have labels; which passages matter is learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.frames import GROUP_BYTES, labelled, listed, mapped, slabs, within
from tessera.llm.piecetable import slice_hashes

#: Labelled documents that are learned from, at most, and passages they have together (2 kB each in the one task that
#: learns). A sample with more ends before the document that would go beyond.
SAMPLE, PASSAGES = 3_000, 150_000
#: Passages that a step of the training holds at once; a longer document stands alone.
STEP = 8_192
WORDS, CODE, GATE = 64, 32, 16
EPOCHS, BATCH, RATE, DECAY = 20, 32, 3e-3, 1e-4

#: Classes of bytes: letters, digits, blanks, some punctuation marks for themselves, others.
_CLASS = np.full(256, 15, np.int64)
_CLASS[0x61:0x7B] = 0
_CLASS[0x41:0x5B] = 1
_CLASS[0x30:0x3A] = 2
_CLASS[0x80:] = 3
_CLASS[[0x20, 0x09]] = 4
_CLASS[[0x0A, 0x0B, 0x0C, 0x0D]] = 5
for _i, _c in enumerate(b".,!|#$%&*"):
    _CLASS[_c] = 6 + _i
CLASSES, TRIGRAMS, MEASURES = 16, 256, 6
WIDTH = CLASSES * CLASSES + TRIGRAMS + MEASURES
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def passages(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each passage, its features) of some texts; a text without words has no passage."""
    n = len(body)
    space = _SPACE[body]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = ~space
    start[1:] &= space[:-1] | edge[1:n]
    begin = np.flatnonzero(start)
    if not len(begin):
        return np.empty(0, np.int64), np.empty((0, WIDTH), np.float32)
    row = np.searchsorted(offsets, begin, side="right") - 1
    first = np.searchsorted(row, np.arange(len(offsets) - 1))  # first word of each text
    order = (np.arange(len(begin)) - first[row]) // WORDS
    opens = np.ones(len(begin), bool)
    opens[1:] = (row[1:] != row[:-1]) | (order[1:] != order[:-1])
    passage = np.cumsum(opens) - 1  # of each word
    count = passage[-1] + 1
    # of each byte: that of the last word begun in its text (bytes before a text's first word are left out)
    of = np.cumsum(start) - 1
    text_row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    own = (of >= 0) & (row[np.maximum(of, 0)] == text_row)
    where = passage[np.maximum(of, 0)]
    kind = _CLASS[body]
    pair = own[:-1] & own[1:] & (where[:-1] == where[1:])
    features = np.zeros((count, WIDTH), np.float32)
    a, b = CLASSES * CLASSES, CLASSES * CLASSES + TRIGRAMS
    features[:, :a] = np.bincount(where[:-1][pair] * a + (kind[:-1] * CLASSES + kind[1:])[pair], minlength=count * a).reshape(count, a)
    low = body.astype(np.uint32)
    tri = ((low[:-2] * np.uint32(0x9E3779B1) + low[1:-1] * np.uint32(0x85EBCA77) + low[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(24)).astype(np.int64)
    triple = pair[:-1] & pair[1:]
    features[:, a:b] = np.bincount(where[:-2][triple] * TRIGRAMS + tri[triple], minlength=count * TRIGRAMS).reshape(count, TRIGRAMS)
    size = np.maximum(np.bincount(where[own], minlength=count), 1).astype(np.float32)[:, None]
    features[:, :b] = np.sqrt(features[:, :b] / size)
    # measures of the words
    stop = ~space
    stop[:-1] &= space[1:] | edge[1:n]
    end = np.flatnonzero(stop) + 1
    h = slice_hashes(body, begin, end)
    words = np.bincount(passage, minlength=count).astype(np.float32)
    distinct = np.unique(passage.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (h & np.uint64((1 << 40) - 1)) * np.uint64(0xC2B2AE3D27D4EB4F), return_index=True)[1]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])
    length = np.bincount(passage, end - begin, count) / words
    features[:, b] = np.bincount(passage[distinct], minlength=count) / words
    features[:, b + 1] = np.bincount(passage[again], minlength=count) / words
    features[:, b + 2] = length / 16.0
    features[:, b + 3] = np.sqrt(np.maximum(np.bincount(passage, (end - begin) ** 2.0, count) / words - length**2, 0)) / 16.0
    features[:, b + 4] = words / WORDS
    features[:, b + 5] = 1.0
    return row[opens], features


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Bag:
    """The parts of the model: encoder w, attention v (tanh), u (gate) and a, scorer c (last entry: bias)."""

    w: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray

    def encoded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code, attention logit) of each passage."""
        h = np.tanh(x @ self.w)
        return h, (np.tanh(h @ self.v) * _sigmoid(h @ self.u)) @ self.a

    def kernel(self):
        def score(body: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
            n = len(offsets) - 1
            top, mass, held = np.full(n, -np.inf), np.zeros(n), np.zeros((n, CODE))
            parts = [(body, offsets)]
            if n == 1 and len(body) > GROUP_BYTES:
                parts = ((np.frombuffer(p, np.uint8), np.array([0, len(p)])) for p in slabs(body.tobytes()))
            for part in parts:  # softmax over all passages, slab by slab
                row, x = passages(*part)
                h, logit = self.encoded(x)
                most = top.copy()
                np.maximum.at(most, row, logit)
                shrink = np.exp(np.where(np.isfinite(top), top - most, -np.inf))
                e = np.exp(logit - most[row])
                mass = mass * shrink + np.bincount(row, e, n)
                add = np.zeros((n, CODE))
                np.add.at(add, row, e[:, None] * h)
                held = held * shrink[:, None] + add
                top = most
            z = held / np.maximum(mass, 1e-300)[:, None]
            p = _sigmoid(z @ self.c[:-1] + self.c[-1]).astype(np.float64)
            return [p, (p >= 0.5).astype(np.int32)]

        return score


NAMES = ("w", "v", "u", "a", "c")


def gradient(p: Bag, part: list[tuple[np.ndarray, int]]) -> tuple[float, dict[str, np.ndarray]]:
    """The summed cross entropy of some bags (passages, label) and its gradient by each part of the model."""
    x = np.concatenate([b[0] for b in part]) if len(part) > 1 else part[0][0]
    y = np.array([b[1] for b in part], x.dtype)
    size = np.array([len(b[0]) for b in part])
    bag = np.repeat(np.arange(len(part)), size)
    h = np.tanh(x @ p.w)
    t, g = np.tanh(h @ p.v), _sigmoid(h @ p.u)
    logit = (t * g) @ p.a
    top = np.full(len(part), -np.inf, x.dtype)
    np.maximum.at(top, bag, logit)
    e = np.exp(logit - top[bag])
    alpha = e / np.bincount(bag, e, len(part))[bag]
    z = np.zeros((len(part), CODE), x.dtype)
    np.add.at(z, bag, alpha[:, None] * h)
    score = z @ p.c[:-1] + p.c[-1]
    loss = float(np.sum(np.logaddexp(0, score) - y * score))
    err = _sigmoid(score) - y
    dz = err[:, None] * p.c[:-1]
    dalpha = (dz[bag] * h).sum(axis=1)
    dlogit = alpha * (dalpha - np.bincount(bag, alpha * dalpha, len(part))[bag])
    dtg = dlogit[:, None] * p.a
    dv, du = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
    dh = (alpha[:, None] * dz[bag] + dv @ p.v.T + du @ p.u.T) * (1 - h * h)
    return loss, {"w": x.T @ dh, "v": h.T @ dv, "u": h.T @ du, "a": (t * g).T @ dlogit, "c": np.append(z.T @ err, err.sum())}


def steps(part: list[tuple[np.ndarray, int]], most: int = STEP) -> Iterator[list[tuple[np.ndarray, int]]]:
    """The bags in runs of at most so many passages, a longer bag by itself."""
    held: list[tuple[np.ndarray, int]] = []
    count = 0
    for bag in part:
        if held and count + len(bag[0]) > most:
            yield held
            held, count = [], 0
        held.append(bag)
        count += len(bag[0])
    if held:
        yield held


def train(bags: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, seed: int = 7) -> Bag:
    """Adam over the bags' cross entropy; every passage of every bag is seen by itself."""
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    p = Bag(small(WIDTH, CODE), small(CODE, GATE), small(CODE, GATE), small(GATE), np.append(small(CODE), np.float32(0)))
    m = {k: np.zeros_like(getattr(p, k)) for k in NAMES}
    s = {k: np.zeros_like(getattr(p, k)) for k in NAMES}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            part = [bags[i] for i in order[at : at + BATCH]]
            grads = [gradient(p, some)[1] for some in steps(part)]
            step += 1
            for k in NAMES:
                own = getattr(p, k)
                d = (sum(g[k] for g in grads) / len(part)).astype(np.float32) + DECAY * own
                m[k] = 0.9 * m[k] + 0.1 * d
                s[k] = 0.999 * s[k] + 0.001 * d * d
                setattr(p, k, (own - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32))
    return p


def constant(share: float) -> Bag:
    """A model that gives every document the same score."""
    bias = np.float32(np.clip(np.log(max(share, 1e-12) / max(1 - share, 1e-12)), -25, 25))
    return Bag(np.zeros((WIDTH, CODE), np.float32), np.zeros((CODE, GATE), np.float32), np.zeros((CODE, GATE), np.float32), np.zeros(GATE, np.float32), np.append(np.zeros(CODE, np.float32), bias))


def _bags(body: np.ndarray, offsets: np.ndarray) -> list:
    """The passages of each text, laid flat."""
    if len(offsets) == 2 and len(body) > GROUP_BYTES:
        x = np.concatenate([passages(np.frombuffer(p, np.uint8), np.array([0, len(p)]))[1] for p in slabs(body.tobytes())])
        return [pa.array([x.ravel()], pa.list_(pa.float32()))]
    row, x = passages(body, offsets)
    edge = np.searchsorted(row, np.arange(len(offsets)))
    return [pa.array([x[a:b].ravel() for a, b in zip(edge, edge[1:])], pa.list_(pa.float32()))]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", folds: int = 3, fold: int = 1, sample: int = SAMPLE, most: int = PASSAGES) -> Bag:
    """Learn from at most sample labelled documents whose crc32(doc_id as text) mod folds isn't fold.

    All tasks encode the sample's passages, one task learns from each of them:
    it takes the documents in the order of their hashes until most passages
    are reached, and holds most * WIDTH floats. Without rows of both labels every score is the share of
    label 1 (1 without any label, so that nothing is dropped).
    """
    chosen = labelled(docs, labels, label, doc_id, text, folds, fold, sample)
    rows = mapped(chosen, ("__id", "__label", "__order"), "text", [T.StructField("bag", T.ArrayType(T.FloatType()))], lambda: _bags)
    rows = rows.groupBy("__id", "__label", "__order").agg(F.min("bag").alias("bag"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_ = (r for b in batches for r in listed(b, "__order", "__id", "bag", "__label"))
        have = within(rows_, lambda r: len(r[2]) // WIDTH, most)
        bags = [(r[2].reshape(-1, WIDTH).astype(np.float32), r[3]) for r in have if len(r[2])]
        ones = sum(b[1] for b in bags)
        model = train(bags) if 0 < ones < len(bags) else constant(ones / len(bags) if bags else 1.0)
        for k in NAMES:
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([getattr(model, k).ravel()], pa.list_(pa.float32()))], names=["part", "value"])

    shapes = {"w": (WIDTH, CODE), "v": (CODE, GATE), "u": (CODE, GATE), "a": (GATE,), "c": (CODE + 1,)}
    found = {r["part"]: np.array(r["value"], np.float32).reshape(shapes[r["part"]]) for r in rows.repartition(1).sortWithinPartitions("__order", "__id").mapInArrow(learn, "part string, value array<float>").collect()}
    return Bag(**found) if found else constant(1.0)


def score(docs: DataFrame, model: Bag, keep: tuple[str, ...] = ("doc_id",), text: str = "text", out: str = "score", predicted: str = "predicted") -> DataFrame:
    """The columns keep with the probability of label 1 for every whole text and whether it is 0.5 or more.

    A null text, or one without words, has no passage and the scorer's bias as
    its score. Repeated rows each give their row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(out, T.DoubleType(), False), T.StructField(predicted, T.IntegerType(), False)]
    return mapped(docs, keep, text, fields, lambda: shared.value.kernel())
