"""Lattice probabilities by listing all segmentations; text scores by counting in Python."""

import collections
import math
import zlib

import numpy as np
import pytest

from tests.conftest import SF0001
from tessera.llm import lattice
from tessera.llm.queries import tokenizer_path

PIECES = [bytes([b]) for b in range(256)] + [b" a", b"ab", b"abc", b"bc", b" ab"]
WORDS = [b"abc", b"a", b"abab", b"xyz", b"abcabcabc", b"ab" * 4, b"abc" * 30]


def every(word, p):
    """Sum over all segmentations, by recursion over the first piece."""
    memo = {len(word): 1.0}
    for i in range(len(word) - 1, -1, -1):
        memo[i] = sum(p[word[i:j]] * memo[j] for j in range(i + 1, len(word) + 1) if word[i:j] in p)
    return memo[0]


def test_all_segmentations_are_summed():
    model = lattice.Lattice.first(PIECES).ready()
    p = dict(zip(PIECES, np.exp(model.logp)))
    want = [math.log(every(b" " + w, p)) for w in WORDS]
    assert np.allclose(model.words(WORDS), want)
    assert np.allclose([model.one(b" " + w) for w in WORDS], want)


def test_expected_uses_agree_between_long_and_short():
    model = lattice.Lattice.first(PIECES)
    model.share, model.total = 0.5, 28
    model.ready()
    short = WORDS[:-1]
    a, b = np.zeros(len(PIECES)), np.zeros(len(PIECES))
    model.words(short, np.arange(1.0, 7.0), a)
    for i, w in enumerate(short):
        model.one(b" " + w, i + 1.0, b)
    assert np.allclose(a, b)
    spelled = model.weight(model.words(short), np.arange(1.0, 7.0))
    letters = sum(s * (len(w) + 1) for s, w in zip(spelled, short))
    assert math.isclose(sum(x * len(p) for x, p in zip(a, PIECES)), letters)  # the pieces used cover the words


@pytest.fixture(scope="module")
def vocabulary():
    return tokenizer_path("byte_bpe_50k.tiktoken")


def check(rows, docs, model=None):
    texts = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    c = collections.Counter()
    for i, words in texts:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            c.update(words + [None])
    n, v = sum(c.values()), len(c)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    want = sorted(
        (
            str(i),
            i is not None and zlib.crc32(str(i).encode()) % 10 == 0,
            len(w) + 1,
            sum(c[x] > 0 for x in w + [None]),
            n,
            round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w + [None]), 6),
        )
        for i, w in texts
    )
    assert got == want


def test_text_scores(spark, vocabulary):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    one = lattice.text_scores(docs, vocabulary, rounds=1).collect()
    check(one, docs)
    # the same with most words joined instead of broadcast
    two = {r.doc_id: r.score for r in lattice.text_scores(docs, vocabulary, rounds=1, hot_words=100).collect()}
    assert all(math.isclose(r.score, two[r.doc_id], rel_tol=1e-9) for r in one)
    assert all(r.score < 0 and math.isfinite(r.score) for r in one)


def test_no_more_words_are_broadcast_than_allowed(spark):
    rng = np.random.default_rng(3)
    counts = [*range(1, 1100), *(2 ** rng.uniform(0, 40, 500)).astype(int).tolist(), *[5000] * 4, *[2**62, 2**62 - 1]]
    table = spark.createDataFrame([(int(n),) for n in counts], "n long").withColumn("step", lattice.frequency_step("n"))
    rows = sorted((r.n, r.step) for r in table.collect())
    steps = [s for _, s in rows]
    assert steps == sorted(steps) and 0 <= steps[0] and steps[-1] < 64 * lattice.STEPS
    assert len({s for n, s in rows if n < 256}) == 255
    for most in (0, 1, 2, 3, 50, 700, 10_000):
        least = lattice.least_step(table, most)
        held = sum(s >= least for s in steps)
        assert held <= most
        below = [s for s in steps if s < least]
        if below:  # the next step would have been too many
            assert held + below.count(max(below)) > most


def test_equally_frequent_words_beyond_the_bound_are_joined(spark, vocabulary, monkeypatch):
    """Four words that each occur 5,000 times, of which one may be broadcast: none is, and the scores are the same."""
    docs = spark.createDataFrame([(i, "aa bb cc dd " * 50) for i in range(100)], "doc_id long, text string")
    took = []
    real = lattice.least_step
    monkeypatch.setattr(lattice, "least_step", lambda t, m: took.append((real(t, m), t)) or took[-1][0])
    far = lattice.text_scores(docs, vocabulary, rounds=1, hot_words=1).collect()
    least, table = took[0]
    assert table.where(table.step >= least).count() <= 1
    near = lattice.text_scores(docs, vocabulary, rounds=1).collect()
    check(far, docs)
    assert all(math.isclose(a.score, b.score, rel_tol=1e-9) for a, b in zip(sorted(far), sorted(near)))


def test_odd_rows(odd, empty, vocabulary):
    rows = lattice.text_scores(odd, vocabulary, rounds=1).collect()
    check(rows, odd)
    assert lattice.text_scores(empty, vocabulary, rounds=1).count() == 0
