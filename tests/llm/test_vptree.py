"""Nearest neighbours against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF0001
from tessera.llm import vptree


def brute(rows, every, k):
    """rows: (id, vector), usable and one for each id."""
    out = []
    for q, v in rows:
        if q % every == 0:
            score = {i: float(np.cumsum(np.float64(v) * np.float64(x))[-1]) for i, x in rows if i != q and len(x) == len(v)}
            best = sorted(score, key=lambda i: (-score[i], i))[:k]
            out += [(q, r + 1, i, score[i]) for r, i in enumerate(best)]
    return sorted(out)


def test_exact(spark):
    vectors = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, np.float32)) for r in vectors.collect()]
    want = brute(rows, 20, 20)
    for dealt in ({}, {"shard_rows": 60}, {"blocks": 3}, {"shard_bytes": 1 << 16, "blocks": 2}):
        assert sorted(map(tuple, vptree.nearest_neighbours(vectors, **dealt).collect())) == want


def test_every_task_has_one_shard_and_one_block(spark):
    """As many partitions as shards times blocks, of about the same size; every query meets every vector once."""
    rows = spark.range(20_000).select(F.lit(1).alias("dim"), "id", F.array(F.col("id") + 0.5).alias("v"))
    dealt = vptree.deal(rows, F.col("id") % 20 == 0, 4, 3).withColumn("p", F.spark_partition_id())
    sizes = {(r.p, r.query): r["count"] for r in dealt.groupBy("p", "query").count().collect()}
    assert sorted({p for p, _ in sizes}) == list(range(12))
    assert all(4500 < sizes[p, 0] < 5500 and 270 < sizes[p, 1] < 400 for p in range(12))
    # a vector lies in a block each, a query in a shard each, so that the two meet in one partition
    where = {(r.query, r.id): set(r.ps) for r in dealt.groupBy("query", "id").agg(F.collect_list("p").alias("ps")).where("id < 400").collect()}
    assert all(len(where[0, i] & where[1, q]) == 1 for i in range(400) for q in range(0, 400, 20))


def test_a_hot_id(spark):
    """An id with a third of all rows, of equal and of different vectors: the smallest counts, once."""
    rows = [(40, [float(1 + i % 3), 1.0]) for i in range(200)] + [(i, [float(i % 17), 1.0]) for i in range(41, 441)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute([(40, [1.0, 1.0]), *rows[200:]], 20, 20)
    assert sorted(map(tuple, vptree.nearest_neighbours(vectors, shard_rows=100, blocks=2).collect())) == want


def test_relaxed_recall(spark):
    """A factor above 1 prunes and still finds at least nine in ten."""
    rng = np.random.default_rng(5)
    points = np.concatenate([c + 0.05 * rng.normal(size=(300, 16)) for c in rng.normal(size=(8, 16))])
    tree = vptree.VpTree(points)
    exact = tree.search(points[:100], 10)[1]
    value = points[:100] @ points.T
    want = np.argsort(-value, axis=1)[:, :10]
    assert all(set(a) == set(b) for a, b in zip(exact, want))
    loose = tree.search(points[:100], 10, relax=3.0)[1]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(loose, want)]) >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "a"), (20, [0.0, 2.0], "a"), (40, None, "a"), (60, [0.0, 0.0], "a"), (80, [nan, 1.0], "a"), (100, [inf, 1.0], "a"),
        (120, [None, 1.0], "a"), (None, [1.0, 1.0], "a"), (140, [], "a"), (1, [1.0, 0.0], "a"), (2, [1.0, 0.0], "a"), (2, [1.0, 0.0], "a"),
        (3, [5.0, 5.0], "a"), (4, [-1.0, -1.0], "a"), (160, [1.0, 2.0, 3.0], "a"), (5, [1.0, 1.0, 1.0], "a"), (180, [7.0], "a"),
    ]
    rows += [(i, [1.0, 0.0], "a") for i in range(200, 260)]  # equal vectors
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    ok = {i: v for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    want = brute(sorted(ok.items()), 20, 20)
    for shard_rows in (4096, 10):
        assert sorted(map(tuple, vptree.nearest_neighbours(vectors, shard_rows=shard_rows).collect())) == want
    assert vptree.nearest_neighbours(vectors.limit(0)).count() == 0


def test_ties_of_different_vectors(spark):
    """Many different vectors of equal score: the smaller ids, in one shard and over several."""
    rng = np.random.default_rng(3)
    ids = (rng.permutation(300) + 1).tolist()
    ids = [i for i in ids if i % 20][:200]
    # the same score by another component each, which the query has at 0; then 0/1 vectors of few scores
    apart = [(i, [1.0, *(5.0 * (j == n) for j in range(200))]) for n, i in enumerate(ids)] + [(20, [5.0, *[0.0] * 200])]
    bits = list({tuple(b): i for i, b in enumerate(rng.integers(0, 2, (900, 12)).tolist()) if any(b)}.items())
    bits = [(i, [float(x) for x in b]) for b, i in bits]
    assert len(bits) > 500
    for rows in (apart, bits):
        vectors = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>")
        want = brute(rows, 20, 20)
        for shard_rows in (4096, 100):
            assert sorted(map(tuple, vptree.nearest_neighbours(vectors, shard_rows=shard_rows).collect())) == want
    assert [r[2] for r in brute(apart, 20, 20)] == sorted(ids)[:20]
