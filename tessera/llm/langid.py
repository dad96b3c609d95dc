"""Language identification with a blended-spectrum string kernel.

The kernel of two texts is the number of n-grams (n = 1, 2, 3, over bytes with
A-Z lower-cased and every other ASCII character taken as a blank) present in
both, divided by the root of the product of the texts' own counts. n-grams
that no landmark has play no part. Nyström: a ridge regression per language
against the rest in the span of some landmark texts,

    alpha = (K_nm' K_nm + ridge * n * K_mm)^-1 K_nm' Y.

A text's value for a language is its kernel row times alpha; the landmark's
n-grams are the same for every text, so this product is folded into one
weight per n-gram and language and a batch of texts is scored by the product
of its presence matrix with those weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.frames import GROUP_BYTES, in_training, listed, mapped, slabs

#: Texts learned from and landmarks, at most, dealt out evenly over the languages.
SAMPLE, LANDMARKS, RIDGE = 3_000, 128, 1e-4
#: Rows whose presence matrix is held at once.
ROWS = 64
UNKNOWN = "und"

#: Bytes to letters of a small alphabet: 0 blank, 1-26 letters, 27 on the bytes beyond ASCII.
ALPHABET = 155
_LETTER = np.zeros(256, np.int32)
_LETTER[0x61:0x7B] = _LETTER[0x41:0x5B] = np.arange(1, 27)
_LETTER[0x80:] = np.arange(27, 155)
GRAMS = ALPHABET + ALPHABET**2 + ALPHABET**3


def grams(body: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, code) of the 1-, 2- and 3-grams of some texts, repeats included."""
    x = _LETTER[body]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    yield row, x
    two = x[:-1] * ALPHABET + x[1:]
    same = row[:-1] == row[1:]
    yield row[:-1][same], two[same] + ALPHABET
    same = row[:-2] == row[2:]
    yield row[:-2][same], (two[:-1] * ALPHABET + x[2:])[same] + (ALPHABET + ALPHABET**2)


def distinct_grams(body: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The codes present in each text."""
    if len(offsets) == 2:
        seen = np.zeros(GRAMS, bool)
        for part in slabs(body.tobytes(), GROUP_BYTES, 1):
            for _, code in grams(np.frombuffer(part, np.uint8), np.array([0, len(part)])):
                seen[code] = True
        return [np.flatnonzero(seen)]
    both = np.unique(np.concatenate([row.astype(np.int64) * GRAMS + code for row, code in grams(body, offsets)]))
    edges = np.searchsorted(both, np.arange(len(offsets)) * GRAMS)
    return [both[a:b] % GRAMS for a, b in zip(edges, edges[1:])]


@dataclass(frozen=True)
class Languages:
    """names, ascending; the n-grams of the landmarks, ascending; weight[n-gram, language]."""

    names: tuple[str, ...]
    gram: np.ndarray
    weight: np.ndarray

    def kernel(self):
        at = np.full(GRAMS, -1, np.int32)
        at[self.gram] = np.arange(len(self.gram))
        weight = self.weight.astype(np.float32)

        def presence(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
            out = np.zeros((len(offsets) - 1, len(self.gram)), np.float32)
            parts = [(body, offsets)]
            if len(offsets) == 2 and len(body) > GROUP_BYTES:
                parts = ((np.frombuffer(p, np.uint8), np.array([0, len(p)])) for p in slabs(body.tobytes(), GROUP_BYTES, 1))
            for part in parts:
                for row, code in grams(*part):
                    column = at[code]
                    known = column >= 0
                    out[row[known], column[known]] = 1.0
            return out

        def predict(body: np.ndarray, offsets: np.ndarray) -> list:
            names, scores = [], []
            for a in range(0, len(offsets) - 1, ROWS):
                edge = offsets[a : a + ROWS + 1]
                part = body[edge[0] : edge[-1]]
                for b, c in zip(edge, edge[1:]):
                    names.append(any(x.isalpha() for x in body[b:c].tobytes().decode("utf-8", "ignore")))
                if not self.names:
                    scores += [0.0] * (len(edge) - 1)
                    continue
                p = presence(part, edge - edge[0])
                value = (p @ weight) / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1.0))
                value = np.exp(4.0 * (value - value.max(axis=1, keepdims=True)).astype(np.float64))
                best = value.argmax(axis=1)
                for i, k in enumerate(best):
                    letters = names[a + i]
                    names[a + i] = self.names[k] if letters else UNKNOWN
                    scores.append(float(value[i, k] / value[i].sum()) if letters else 0.0)
            if not self.names:
                names = [UNKNOWN] * len(scores)
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return predict


def ridge(rows: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Languages:
    """Learn from (language, n-grams present); the first rows of each language are the landmarks."""
    names = tuple(sorted({r[0] for r in rows}))
    if not names:
        return Languages((), np.empty(0, np.int64), np.empty((0, 0)))
    each = max(1, landmarks // len(names))
    chosen = [g for name in names for g in [r[1] for r in rows if r[0] == name][:each] if len(g)]
    if not chosen:
        return Languages(names, np.empty(0, np.int64), np.empty((0, len(names))))
    gram = np.unique(np.concatenate(chosen))

    def dense(sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), len(gram)), np.float32)
        for i, g in enumerate(sets):
            at = np.searchsorted(gram, g)
            at = at[(at < len(gram)) & (gram[np.minimum(at, len(gram) - 1)] == g)]
            out[i, at] = 1.0
        return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1.0))

    base = dense(chosen)
    mm = (base @ base.T).astype(np.float64)
    left, right = np.zeros_like(mm), np.zeros((len(chosen), len(names)))
    for a in range(0, len(rows), 256):  # K_nm' K_nm and K_nm' Y, block by block
        part = rows[a : a + 256]
        k = (dense([r[1] for r in part]) @ base.T).astype(np.float64)
        y = np.array([[1.0 if r[0] == name else -1.0 for name in names] for r in part])
        left += k.T @ k
        right += k.T @ y
    alpha = np.linalg.solve(left + ridge * len(rows) * mm + 1e-8 * np.eye(len(mm)), right)
    return Languages(names, gram, base.T.astype(np.float64) @ alpha)


def fit(docs: DataFrame, lang: str = "lang", doc_id: str = "doc_id", text: str = "text", folds: int = 3, fold: int = 1, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Languages:
    """Learn from at most sample rows with a language whose crc32(doc_id as text) mod folds isn't fold.

    The rows are those of the smallest hashes of each language, the languages
    in turn. Their n-grams are made by all tasks; one task learns from them.
    Without such rows every text is ``und``.
    """
    ids = docs.select(F.col(doc_id).alias("__id"), F.col(lang).alias("__lang")).where(F.col("__lang").isNotNull() & in_training("__id", folds, fold)).distinct()
    turn = Window.partitionBy("__lang").orderBy("__order", "__id")
    ids = ids.withColumn("__order", F.xxhash64("__id")).withColumn("__turn", F.row_number().over(turn)).where(F.col("__turn") <= sample)
    chosen = F.broadcast(ids.orderBy("__turn", "__order", "__id", "__lang").limit(sample))  # at most sample rows
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(lang).alias("__lang"), F.col(text).alias("text")).join(chosen, ["__id", "__lang"])
    made = [T.StructField("grams", T.ArrayType(T.IntegerType()))]
    rows = mapped(rows, ("__id", "__lang", "__turn"), "text", made, lambda: lambda body, offsets: [pa.array([x.astype(np.int32) for x in distinct_grams(body, offsets)], pa.list_(pa.int32()))])
    rows = rows.groupBy("__id", "__lang", "__turn").agg(F.min("grams").alias("grams"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = sorted((row for batch in batches for row in listed(batch, "__lang", "__turn", "__id", "grams")), key=lambda r: r[:3])
        model = ridge([(r[0], r[3].astype(np.int64)) for r in have], landmarks)
        for i, name in enumerate(model.names):
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([model.gram], pa.list_(pa.int64())), pa.array([model.weight[:, i]], pa.list_(pa.float64()))], names=["name", "gram", "weight"])

    found = sorted(rows.repartition(1).mapInArrow(learn, "name string, gram array<long>, weight array<double>").collect(), key=lambda r: r["name"])
    if not found:
        return Languages((), np.empty(0, np.int64), np.empty((0, 0)))
    weight = np.array([r["weight"] for r in found], np.float64).reshape(len(found), -1).T
    return Languages(tuple(r["name"] for r in found), np.array(found[0]["gram"], np.int64), weight)


def predict(docs: DataFrame, model: Languages, keep: tuple[str, ...] = ("doc_id",), text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """The columns keep, the language of every whole text and its share among the languages.

    A null text or one without a letter is ``und`` with score 0. Ties go to
    the first name. Repeated rows each give their row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(out, T.StringType(), False), T.StructField(score, T.DoubleType(), False)]
    return mapped(docs, keep, text, fields, lambda: shared.value.kernel())
