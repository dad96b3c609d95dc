"""LM scoring by a subword lattice.

The pieces are those of a public byte-level tokenizer and, as arcs over a
whole word, the training words themselves with the scores of their counts.
The tokenizer's order gives its pieces their first unigram scores; some rounds
of expectation maximisation over all training words re-estimate these and the
share of the whole-word arcs (a word's own arc counts its other occurrences
only, so that what is learned holds for new words). A word, with the blank
before it, is a lattice of all its segmentations, and its probability is their
sum, found by a forward recursion in log space (all single bytes are pieces,
so every word has one). A text is a sequence of words and an end:

    log10 P(text) = log10 P(end) + sum over words of log10((1 - P(end)) * P(word))

Words repeat, so they are counted first (combined before the shuffle) and each
distinct word is scored once. The most frequent ones, at most ``HOT_WORDS``,
are broadcast; the rest of the words of each document meet their scores in a
join, from which the frequent words, its hot keys, are thus kept.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.frames import GROUP_BYTES, fresh, held_out, row_groups, stored, text_buffers
from tessera.llm.piecetable import _POWERS, slice_hashes
from tessera.llm.words import LOWER

#: Words whose scores are broadcast, at most (24 bytes each).
HOT_WORDS = 1 << 21
ROUNDS, FLOOR, SHARE = 3, 0.05, 0.9
#: Longer words (with their blank) are worked off one by one.
LONG = 64
#: Distinct words a task counts before it passes them on.
HELD = 300_000
_MIX = np.uint64(0xBF58476D1CE4E5B9)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BLANKS = re.compile(rb"[\x20\x09-\x0D]")


def vocabulary(path: str) -> list[bytes]:
    """The pieces of a public file of base64 tokens and ranks that can stand in a lower-cased word, in their order."""
    with open(path, "rb") as f:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
    keep = [p for _, p in ranked if p == p.lower() and not _BLANKS.search(p[1:]) and p[:1] not in b"\t\n\r\x0b\x0c"]
    every = [bytes([b]) for b in range(256)]
    return keep + [p for p in every if p not in set(keep)]


@dataclass
class Lattice:
    """Pieces and their log probabilities; the share of whole-word arcs, and the number of training words."""

    pieces: list[bytes]
    logp: np.ndarray
    share: float = 0.0
    total: int = 0

    @staticmethod
    def first(pieces: list[bytes]) -> Lattice:
        p = 1.0 / (np.arange(len(pieces)) + 10.0)
        return Lattice(pieces, np.log(p / p.sum()))

    def ready(self) -> Lattice:
        """Look-up tables, made once a task."""
        body = np.frombuffer(b"".join(self.pieces), np.uint8)
        end = np.cumsum([len(p) for p in self.pieces])
        h = slice_hashes(body, np.concatenate([[0], end[:-1]]), end)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[h >> np.uint64(44)] = True
        self.widest = max(map(len, self.pieces))
        self.at = {p: i for i, p in enumerate(self.pieces)}
        self.lengths = sorted({len(p) for p in self.pieces})
        return self

    def _found(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, or -1."""
        out = np.full(h.shape, -1, np.int64)
        likely = self.maybe[h >> np.uint64(44)]
        some = h[likely]
        at = np.minimum(np.searchsorted(self.hashes, some), len(self.hashes) - 1)
        out[likely] = np.where(self.hashes[at] == some, self.order[at], -1)
        return out

    def _edges(self, letters: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(length, piece or -1, log probability) of every substring of words of one length (rows of letters)."""
        n, size = letters.shape
        up, down = _POWERS.upto(size + 1)
        sums = np.zeros((n, size + 1), np.uint64)
        np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * up[:size], axis=1, out=sums[:, 1:])
        out = []
        for k in self.lengths:
            if k > size:
                break
            h = (sums[:, k:] - sums[:, : size + 1 - k]) * down[: size + 1 - k]
            h ^= h >> np.uint64(29)
            h *= _MIX
            h ^= h >> np.uint64(32)
            piece = self._found(h)
            if (piece >= 0).any():
                out.append((k, piece, np.where(piece >= 0, self.logp[piece], -np.inf)))
        return out

    def weight(self, total: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Of c occurrences, those expected to be spelled by pieces, when each looks at the others for its word's own arc."""
        spelled = np.log1p(-self.share) + total
        whole = np.log(np.maximum(c - 1, 1e-300) / max(self.total - 1, 1)) + np.log(max(self.share, 1e-300))
        return c * np.exp(spelled - np.logaddexp(spelled, whole))

    def with_words(self, total: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log P with the arcs of whole words that occur c times in training."""
        spelled = np.log1p(-self.share) + total
        return np.where(c > 0, np.logaddexp(spelled, np.log(max(self.share, 1e-300)) + np.log(np.maximum(c, 1) / max(self.total, 1))), spelled)

    def rows(self, letters: np.ndarray, c: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
        """log P by pieces of words of one length; with their counts, adds the expected uses of each piece to expected."""
        n, size = letters.shape
        edges = self._edges(letters)
        forward = np.full((size + 1, n), -np.inf)
        forward[0] = 0.0
        for j in range(1, size + 1):
            for k, _, lp in edges:
                if k <= j:
                    forward[j] = np.logaddexp(forward[j], forward[j - k] + lp[:, j - k])
        total = forward[size]
        if expected is not None:
            weight = self.weight(total, c)
            backward = np.full((size + 1, n), -np.inf)
            backward[size] = 0.0
            for j in range(size - 1, -1, -1):
                for k, _, lp in edges:
                    if j + k <= size:
                        backward[j] = np.logaddexp(backward[j], lp[:, j] + backward[j + k])
            for k, piece, lp in edges:
                share = forward[: size + 1 - k].T + lp + backward[k:].T - total[:, None]
                hit = piece >= 0
                use = np.exp(share) * weight[:, None]
                expected += np.bincount(piece[hit], use[hit], len(self.pieces))
        return total

    def one(self, word: bytes, c: float = 0.0, expected: np.ndarray | None = None) -> float:
        """log P by pieces of one long word, letter by letter."""
        n, wide = len(word), min(self.widest, len(word))
        forward, edges = np.full(n + 1, -np.inf), []
        forward[0] = 0.0
        for j in range(1, n + 1):
            own = [(k, self.at[word[j - k : j]]) for k in range(1, min(wide, j) + 1) if word[j - k : j] in self.at]
            forward[j] = np.logaddexp.reduce([forward[j - k] + self.logp[i] for k, i in own])
            edges.append(own)
        if expected is not None:
            weight = float(self.weight(forward[n:], np.array([c]))[0])
            backward = np.full(n + 1, -np.inf)
            backward[n] = 0.0
            for j in range(n, 0, -1):
                for k, i in edges[j - 1]:
                    expected[i] += weight * np.exp(forward[j - k] + self.logp[i] + backward[j] - forward[n])
                    backward[j - k] = np.logaddexp(backward[j - k], self.logp[i] + backward[j])
        return float(forward[n])

    def words(self, words: list[bytes], c: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
        """log P by pieces of each word (a blank is put before it)."""
        out = np.empty(len(words))
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        for k in np.unique(size):
            at = np.flatnonzero(size == k)
            if k > LONG:
                for i in at:
                    out[i] = self.one(b" " + words[i], 0.0 if c is None else float(c[i]), expected)
                continue
            step = max(1, (1 << 17) // int(k))
            for a in range(0, len(at), step):
                part = at[a : a + step]
                letters = np.frombuffer(b"".join(b" " + words[i] for i in part), np.uint8).reshape(-1, k)
                out[part] = self.rows(letters, None if c is None else c[part], expected)
        return out


def word_slabs(body: bytes, limit: int = GROUP_BYTES) -> Iterator[bytes]:
    """A long text in parts that hold whole words."""
    start = 0
    while len(body) - start > limit:
        blank = _BLANKS.search(body, start + limit)
        if not blank:
            break
        yield body[start : blank.start()]
        start = blank.start()
    yield body[start:]


def word_counts(docs: DataFrame, doc_id: str, text: str, folds: int, fold: int) -> DataFrame:
    """(word, n, c): occurrences in all texts and in the training texts."""
    rows = docs.select(held_out(doc_id, folds, fold).alias("held"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {True: Counter(), False: Counter()}

        def flush() -> pa.RecordBatch:
            words = list(counts[True].keys() | counts[False].keys())
            c = np.fromiter((counts[False][w] for w in words), np.int64, len(words))
            n = c + np.fromiter((counts[True][w] for w in words), np.int64, len(words))
            for x in counts.values():
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n), pa.array(c)], names=["word", "n", "c"])

        for batch in batches:
            held = batch.column(0).to_pylist()
            body, offsets = text_buffers(batch.column(1))
            for i, h in enumerate(held):
                for part in word_slabs(body[offsets[i] : offsets[i + 1]].tobytes()):
                    counts[h].update(part.lower().split())
                    if len(counts[h]) > HELD:
                        yield flush()
        yield flush()

    made = rows.mapInArrow(work, "word binary, n long, c long")
    return made.groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def fitted(counts: DataFrame, pieces: list[bytes], total: int, rounds: int = ROUNDS) -> Lattice:
    """Unigram scores re-estimated from the expected uses of each piece in all training words (total of them)."""
    spark = counts.sparkSession
    model = Lattice.first(pieces)
    if not total:
        return model
    model.share, model.total = SHARE, total
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value.ready()
            expected, spelled = np.zeros(len(own.pieces)), 0.0
            for batch in batches:
                c = batch.column(1).to_numpy().astype(float)
                spelled += float(own.weight(own.words(batch.column(0).to_pylist(), c, expected), c).sum())
            at = np.flatnonzero(expected)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(expected[at], spelled))], names=["piece", "uses"])

        uses = counts.where("c > 0").select("word", "c").mapInArrow(work, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()
        piece, uses = uses.piece.to_numpy(dtype=np.int64), uses.uses.to_numpy(dtype=float)
        sums = np.full(len(pieces), FLOOR)
        sums[piece[piece >= 0]] += uses[piece >= 0]
        share = 1 - float(uses[piece < 0].sum()) / total
        model = Lattice(pieces, np.log(sums / sums.sum()), min(max(share, 0.001), 0.999), total)
    return model


def scored_words(counts: DataFrame, model: Lattice) -> DataFrame:
    """counts with key (the hash that the documents' words are looked up by) and logp (natural logarithm)."""
    shared = counts.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.ready()
        for batch in batches:
            body, offsets = text_buffers(batch.column(0))
            key = slice_hashes(body, offsets[:-1], offsets[1:]).view(np.int64) if batch.num_rows else np.empty(0, np.int64)
            logp = own.with_words(own.words(batch.column(0).to_pylist()), batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key), pa.array(logp)], names=["word", "n", "c", "key", "logp"])

    return counts.select("word", "n", "c").mapInArrow(work, "word binary, n long, c long, key long, logp double")


#: Steps of word frequencies between a power of two and the next (every frequency below is a step of its own).
STEPS = 256


def frequency_step(n: str) -> Column:
    """A number that grows with the frequency n (1 or more) in at most 64 * ``STEPS`` steps."""
    power = F.length(F.bin(n)) - 1
    above = F.col(n) - F.call_function("shiftleft", F.lit(1).cast("long"), power)
    fine = F.when(power <= 8, F.call_function("shiftleft", above, F.greatest(8 - power, F.lit(0)))).otherwise(F.call_function("shiftright", above, F.greatest(power - 8, F.lit(0))))
    return (power * STEPS + fine).cast("int")


def least_step(table: DataFrame, hot_words: int) -> int:
    """The least step such that the words of it and of all above are no more than hot_words together."""
    held, least = 0, 64 * STEPS
    for row in table.groupBy("step").count().orderBy(F.desc("step")).collect():  # a row a step
        held += row["count"]
        if held > hot_words:
            break
        least = row["step"]
    return least


def text_scores(
    docs: DataFrame,
    vocabulary_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    folds: int = 10,
    fold: int = 0,
    rounds: int = ROUNDS,
    hot_words: int = HOT_WORDS,
    smoothing: float = 0.1,
) -> DataFrame:
    """One row a text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32(doc_id as text) mod folds isn't fold are learned from
    (a null id is; it isn't held out). A null text counts as empty: just an
    end. base_score is the smoothed unigram model of whole words, score the
    lattice's log10 probability. Repeated rows each count and each give their
    row. A word is looked up by a 64-bit hash among the broadcast ones, by
    itself in the join. Nothing learned from: the formula's values for N = 0.
    """
    fresh(docs.select(doc_id), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    spark = docs.sparkSession
    counts = stored(word_counts(docs, doc_id, text, folds, fold))
    ends = docs.where(~held_out(doc_id, folds, fold)).count()
    known = counts.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, kinds = known[0] + ends, known[1] + (1 if ends else 0)
    table = stored(scored_words(counts, fitted(counts, vocabulary(vocabulary_path), int(known[0]), rounds)))

    table = table.withColumn("step", frequency_step("n"))
    least = least_step(table, hot_words)
    hot = table.where(F.col("step") >= least).select("key", "c", "logp").toArrow()
    key = hot["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    shared = spark.sparkContext.broadcast((key[order], hot["c"].to_numpy()[order], hot["logp"].to_numpy()[order]))

    ten = np.log(10.0)
    scale = np.log10(tokens + smoothing * (kinds + 1))
    p_end = (ends + smoothing) / (tokens + 2 * smoothing)
    go_on = np.log10(1 - p_end)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).alias("id"), held_out(doc_id, folds, fold).alias("held"), F.col(text).alias("text"))
    fields = rows.select("uid", "id", "held").schema.fields + [
        T.StructField("words", T.LongType()),
        T.StructField("known", T.LongType()),
        T.StructField("base", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rest", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("uses", T.LongType())]))),
    ]
    pair = pa.struct([("word", pa.binary()), ("uses", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, c, logp = shared.value
        base_of = np.log10(c + smoothing) - scale
        score_of = logp / ten + go_on
        seen = c > 0

        def some(body: np.ndarray, offsets: np.ndarray, out: list[np.ndarray], rest: list[Counter], first: int) -> None:
            """Adds the words of some texts (rows from first on) to the sums and the rest."""
            space = _SPACE[body]
            edge = np.zeros(len(body) + 1, bool)
            edge[offsets] = True
            start, stop = ~space, ~space
            start[1:] &= space[:-1] | edge[1 : len(body)]
            stop[:-1] &= space[1:] | edge[1 : len(body)]
            begin, end = np.flatnonzero(start), np.flatnonzero(stop) + 1
            if not len(begin):
                return
            row = np.searchsorted(offsets, begin, side="right") - 1
            low = LOWER[body]
            h, back = np.unique(slice_hashes(low, begin, end), return_inverse=True)
            at = np.searchsorted(keys, h)
            hit = np.zeros(len(h), bool)
            inside = at < len(keys)
            hit[inside] = keys[at[inside]] == h[inside]
            at, hit = at[back], hit[back]
            n = len(offsets) - 1
            own = slice(first, first + n)
            out[0][own] += np.bincount(row, minlength=n)
            out[1][own] += np.bincount(row[hit], seen[at[hit]], n).astype(np.int64)
            out[2][own] += np.bincount(row[hit], base_of[at[hit]], n)
            out[3][own] += np.bincount(row[hit], score_of[at[hit]], n)
            raw = low.tobytes()
            for i, a, b in zip(row[~hit].tolist(), begin[~hit].tolist(), end[~hit].tolist()):
                rest[first + i][raw[a:b]] += 1

        for batch in batches:
            if not batch.num_rows:
                continue
            body, offsets = text_buffers(batch.column(3))
            n = batch.num_rows
            out = [np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)]
            rest = [Counter() for _ in range(n)]
            for a, b in row_groups(offsets):
                part = body[offsets[a] : offsets[b]]
                if b - a == 1 and len(part) > GROUP_BYTES:
                    for piece in word_slabs(part.tobytes()):
                        some(np.frombuffer(piece, np.uint8), np.array([0, len(piece)]), out, rest, a)
                else:
                    some(part, offsets[a : b + 1] - offsets[a], out, rest, a)
            ends_ = np.cumsum([0, *map(len, rest)])
            flat = pa.StructArray.from_arrays(
                [pa.array([w for r in rest for w in r], pa.binary()), pa.array([u for r in rest for u in r.values()], pa.int64())], fields=list(pair)
            )
            rests = pa.ListArray.from_arrays(pa.array(ends_, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *map(pa.array, out), rests], names=[f.name for f in fields])

    first = stored(rows.mapInArrow(work, T.StructType(fields)))
    rest = first.select("uid", F.explode("rest").alias("r")).select("uid", "r.word", "r.uses")
    met = rest.join(table.where(F.col("step") < least).select("word", "c", "logp"), "word")
    sums = met.groupBy("uid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("uses")).otherwise(0)).alias("known2"),
        F.sum(F.col("uses") * (F.log10(F.col("c") + smoothing) - F.lit(float(scale)))).alias("base2"),
        F.sum(F.col("uses") * (F.col("logp") / float(ten) + F.lit(float(go_on)))).alias("score2"),
    )
    end_base, end_score = float(np.log10(ends + smoothing) - scale), float(np.log10(p_end))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return first.join(sums, "uid", "left").select(
        F.col("id").alias(doc_id),
        F.col("held").alias("held_out"),
        (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + zero("known2") + (1 if ends else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("base2") + end_base).alias("base_score"),
        (F.col("score") + zero("score2") + end_score).alias("score"),
    )
