"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A feature is present or not: single words, pairs of neighbours and pairs with
one word between. Each coordinate has a learning rate of its own
(alpha / (beta + sqrt(sum of squared gradients))) and an L1 penalty that keeps
all but the telling coordinates at exactly zero, so the weights are a short
list that is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.frames import GROUP_BYTES, labelled, listed, mapped, slabs, within
from tessera.llm.words import mix, words

#: Hashed feature space; the weights can't have more entries.
BITS = 20
#: Labelled documents that are learned from, at most, and features present in them, summed over the documents: 4 bytes
#: each go to the one task that learns. A sample with more ends before the document that would go beyond.
SAMPLE, PRESENT = 24_000, 50_000_000
EPOCHS, ALPHA, BETA, L1, L2 = 6, 1.0, 1.0, 20.0, 0.1
#: Weight of a document with label 1, as these are few.
POSITIVE = 2.0


def features(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of some texts, with repeats."""
    h, row, _ = words(body, offsets)
    found, where = [mix(h)], [row]
    for gap in (1, 2):
        same = row[:-gap] == row[gap:]
        found.append(mix(h[:-gap][same], h[gap:][same], gap))
        where.append(row[:-gap][same])
    return np.concatenate(where), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


def distinct_features(body: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The features present in each text. A text beyond ``GROUP_BYTES`` is worked off in slabs that share two words."""
    if len(offsets) == 2 and len(body) > GROUP_BYTES:
        seen = np.zeros(1 << BITS, bool)
        for part in slabs(body.tobytes(), GROUP_BYTES, 2):
            seen[features(np.frombuffer(part, np.uint8), np.array([0, len(part)]))[1]] = True
        return [np.flatnonzero(seen)]
    row, feature = features(body, offsets)
    both = np.unique((row << BITS) | feature)
    edges = np.searchsorted(both >> BITS, np.arange(len(offsets)))
    return [both[a:b] & ((1 << BITS) - 1) for a, b in zip(edges, edges[1:])]


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2, positive: float = POSITIVE) -> tuple[np.ndarray, float]:
    """(weights, bias) after the rows, in order, epochs times. The bias isn't penalised."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    penalty = np.full((1 << BITS) + 1, l1)
    penalty[-1] = 0.0

    def weight(at: np.ndarray) -> np.ndarray:
        own = z[at]
        w = -(own - np.sign(own) * penalty[at]) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(own) <= penalty[at], 0.0, w)

    for _ in range(epochs):
        for present, label in rows:
            at = np.append(present, 1 << BITS)
            w = weight(at)
            g = (1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label) * (positive if label else 1.0)
            own = n[at]
            z[at] += g - (np.sqrt(own + g * g) - np.sqrt(own)) / alpha * w
            n[at] = own + g * g
    every = weight(np.arange((1 << BITS) + 1))
    return every[:-1], float(every[-1])


@dataclass(frozen=True)
class Toxicity:
    """Nonzero weights by feature, and a bias."""

    feature: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.empty(0))
    bias: float = -35.0

    def kernel(self):
        dense = np.zeros(1 << BITS)
        dense[self.feature] = self.weight
        telling = dense != 0

        def score(body: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
            if len(offsets) == 2 and len(body) > GROUP_BYTES:
                present = distinct_features(body, offsets)[0]
                total = np.array([dense[present].sum()])
            else:
                row, feature = features(body, offsets)
                hit = telling[feature]
                both = np.unique((row[hit] << BITS) | feature[hit])
                total = np.bincount(both >> BITS, dense[both & ((1 << BITS) - 1)], len(offsets) - 1)
            p = 1.0 / (1.0 + np.exp(-np.clip(total + self.bias, -35, 35)))
            return [p, (p >= 0.5).astype(np.int32)]

        return score


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", folds: int = 5, fold: int = 0, sample: int = SAMPLE, present: int = PRESENT) -> Toxicity:
    """Learn from at most sample labelled documents whose crc32(doc_id as text) mod folds isn't fold.

    The features of the sample (of one row for an id that has several: the
    smallest) are made by all tasks and learned from by one, which takes them
    in the order of their hashes until present features are reached. Without rows of
    both labels there are no weights, and every score is the share of label 1
    (0 without any).
    """
    chosen = labelled(docs, labels, label, doc_id, text, folds, fold, sample)
    rows = mapped(chosen, ("__id", "__label", "__order"), "text", [T.StructField("features", T.ArrayType(T.IntegerType()))], lambda: lambda body, offsets: [pa.array([x.astype(np.int32) for x in distinct_features(body, offsets)], pa.list_(pa.int32()))])
    rows = rows.groupBy("__id", "__label", "__order").agg(F.min("features").alias("features"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_ = (row for batch in batches for row in listed(batch, "__order", "__id", "features", "__label"))
        have = within(rows_, lambda r: len(r[2]), present)
        ones = sum(r[3] for r in have)
        if 0 < ones < len(have):
            w, bias = ftrl([r[2:] for r in have])
        else:
            w, bias = np.zeros(0), 35.0 if ones else -35.0
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w[at], bias))], names=["feature", "weight"])

    model = rows.repartition(1).sortWithinPartitions("__order", "__id").mapInArrow(learn, "feature long, weight double").toPandas()
    bias = model.weight[model.feature < 0]
    at = model.feature >= 0
    return Toxicity(model.feature[at].to_numpy(), model.weight[at].to_numpy(), float(bias.sum()) if len(bias) else -35.0)


def score(docs: DataFrame, model: Toxicity, keep: tuple[str, ...] = ("doc_id",), text: str = "text", out: str = "score", predicted: str = "predicted") -> DataFrame:
    """The columns keep with the probability of label 1 for every whole text and whether it is 0.5 or more.

    An empty or null text has the score of no features. Repeated rows each
    give their row; columns outside keep aren't read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(out, T.DoubleType(), False), T.StructField(predicted, T.IntegerType(), False)]
    return mapped(docs, keep, text, fields, lambda: shared.value.kernel())
