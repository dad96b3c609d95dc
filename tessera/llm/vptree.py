"""Nearest neighbours by largest inner product, with a vantage-point tree per shard.

A shard's vectors x become points (x, sqrt(M^2 - |x|^2)), M being the shard's
largest norm, and a query q becomes (q, 0): the Euclidean order of distances
is then the order of inner products, and the triangle inequality holds. An
inner node of the tree has a vantage point v and the median distance mu of its
points from v. A query at distance d from v whose k-th best distance so far is
t needs the other side of mu only if |d - mu| <= t. ``relax`` sharpens this to
relax * |d - mu| <= t: 1 is exact, larger values prune more and may miss some.
Queries go down the tree in batches: first along their near sides to one leaf,
whose points give a bound on t, then through each node once with all queries
that need it. A query whose k-th best score may be that of more points than
were kept goes down once more for all points that good.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.frames import fresh, stored

#: Bytes of a shard's vectors as doubles, about (a task takes some five times that), and points a leaf has, at most.
SHARD_BYTES, LEAF = 64 << 20, 64
NEAREST, RELAX, QUERY_EVERY = 20, 1.0, 20
#: Queries that go down a tree together.
BATCH = 512


class VpTree:
    """points: one row each, all different. Nodes are kept in lists, a leaf's points in a slice of ``order``."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points, max(1, leaf)
        squares = np.einsum("ij,ij->i", points, points)
        self.most = float(squares.max()) if len(points) else 0.0
        #: Rounding of an inner product or a squared distance, as a share of the squared lengths in it.
        self.rounding = 16 * max(1, points.shape[1]) * np.finfo(np.float64).eps
        self.lift = np.sqrt(np.maximum(self.most - squares, 0.0))
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(points))) if len(points) else -1

    def _build(self, members: np.ndarray) -> int:
        at = len(self.nodes)
        if len(members) <= self.leaf:
            self.nodes.append((members,))
            return at
        self.nodes.append(())
        vantage, rest = members[0], members[1:]
        inner = self.points[rest] @ self.points[vantage] + self.lift[rest] * self.lift[vantage]
        d = np.sqrt(np.maximum(2 * self.most - 2 * inner, 0.0))
        half = len(rest) // 2
        order = np.argpartition(d, half)
        mu = float(d[order[half]])  # d <= mu inside, d >= mu outside
        self.nodes[at] = (vantage, mu, self._build(rest[order[:half]]), self._build(rest[order[half:]]))
        return at

    def search(self, queries: np.ndarray, k: int, relax: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """(inner products, points) of the k best of each query, unordered; missing ones are -inf, -1."""
        n = len(queries)
        squares, slack = self._lengths(queries)
        # k real points of each query are as good as this, whatever the products' rounding
        bound = np.full(n, -np.inf)
        best, found = np.full((n, k), -np.inf), np.full((n, k), -1)

        def offer(who: np.ndarray, members: np.ndarray, value: np.ndarray) -> None:
            least = np.maximum(bound[who], best[who].min(axis=1))
            better = (value > least[:, None]).any(axis=1)
            who, value = who[better], value[better]
            if not len(who):
                return
            both = np.concatenate([best[who], value], axis=1)
            label = np.concatenate([found[who], np.broadcast_to(members, value.shape)], axis=1)
            top = np.argpartition(-both, k - 1, axis=1)[:, :k]
            best[who] = np.take_along_axis(both, top, axis=1)
            found[who] = np.take_along_axis(label, top, axis=1)

        def distance(who: np.ndarray, value: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(squares[who] + self.most - 2 * value, 0.0))

        def visit(at: int, who: np.ndarray, far: bool) -> None:
            """Offers the points below a node; the far side of a query's mu too, if its bound allows."""
            if not len(who):
                return
            node = self.nodes[at]
            if len(node) == 1:
                if len(node[0]):
                    offer(who, node[0], queries[who] @ self.points[node[0]].T)
                return
            vantage, mu, inside, outside = node
            value = queries[who] @ self.points[vantage]
            offer(who, np.array([vantage]), value[:, None])
            d = distance(who, value)

            def other() -> np.ndarray:
                kth = np.maximum(bound[who], best[who].min(axis=1))
                t = np.where(np.isfinite(kth), distance(who, np.where(np.isfinite(kth), kth, 0.0)), np.inf)
                # rounding of the distances must not cut off what the bound allows
                return ~(relax * np.abs(d - mu) > t + slack[who])

            # a node is visited once for all queries: the side where most of them are first
            sides = [(inside, d <= mu), (outside, d > mu)]
            for child, near in sorted(sides, key=lambda s: -int(s[1].sum())):
                visit(child, who[near | other()] if far else who[near], far)

        if self.root >= 0:
            # down the near sides to a leaf for a bound, then once more from the root for all that it allows
            visit(self.root, np.arange(n), False)
            bound = best.min(axis=1) - self.rounding * np.sqrt(squares * self.most)
            best[:], found[:] = -np.inf, -1
            visit(self.root, np.arange(n), True)
        return best, found

    def within(self, queries: np.ndarray, least: np.ndarray, relax: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """(queries, points) of all pairs with an inner product of at least the query's ``least``."""
        squares, slack = self._lengths(queries)
        t = np.sqrt(np.maximum(squares + self.most - 2 * least, 0.0)) + slack
        pairs: list[tuple[np.ndarray, np.ndarray]] = []

        def visit(at: int, who: np.ndarray) -> None:
            if not len(who):
                return
            node = self.nodes[at]
            members = node[0] if len(node) == 1 else np.array([node[0]])
            value = queries[who] @ self.points[members].T
            row, column = np.nonzero(value >= least[who, None])
            pairs.append((who[row], members[column]))
            if len(node) == 1:
                return
            _, mu, inside, outside = node
            d = np.sqrt(np.maximum(squares[who] + self.most - 2 * value[:, 0], 0.0))
            visit(inside, who[relax * (d - mu) <= t[who]])
            visit(outside, who[relax * (mu - d) <= t[who]])

        if self.root >= 0:
            visit(self.root, np.arange(len(queries)))
        return tuple(np.concatenate([p[i] for p in pairs]) if pairs else np.empty(0, int) for i in (0, 1))

    def _lengths(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared lengths of the queries, and what rounding may add to a sum of three distances."""
        squares = np.einsum("ij,ij->i", queries, queries)
        return squares, 3 * np.sqrt(self.rounding * (squares + 2 * self.most))


class Shard:
    """Some vectors with their ids, all different: equal vectors as one point."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, nearest: int):
        points, which = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort([ids, which.ravel()])
        edge = np.searchsorted(which.ravel()[order], np.arange(len(points) + 1))
        # a query needs no more than its nearest and itself of equal vectors
        self.ids = [ids[order[a : min(b, a + nearest + 1)]] for a, b in zip(edge, edge[1:])]
        # points in no order of their own, so that the first is a fair vantage point
        shuffled = np.random.default_rng(0).permutation(len(points))
        self.ids = [self.ids[i] for i in shuffled]
        self.smallest = np.array([i[0] for i in self.ids])
        self.tree = VpTree(points[shuffled].astype(np.float64))

    def nearest(self, ids: np.ndarray, queries: np.ndarray, k: int, relax: float) -> Iterator[tuple[int, int, float]]:
        """(query, id, inner product) of the k nearest other ids of each query."""
        queries = queries.astype(np.float64)
        # one more for the query itself, some more for points that differ by rounding only
        best, found = self.tree.search(queries, min(k + 5, max(1, len(self.ids))), relax)
        gathered = [points[points >= 0] for points in found]
        if found.shape[1] < len(self.ids):
            # k + 1 points have k other ids; points left out are no better than the last one found. Unless that
            # is clearly worse than the (k+1)-th, points as good may be missing, and smaller ids among them
            margin = self.tree.rounding * np.linalg.norm(queries, axis=1) * math.sqrt(self.tree.most)
            least = np.partition(best, -(k + 1), axis=1)[:, -(k + 1)] - margin
            tied = np.flatnonzero(best.min(axis=1) >= least)
            row, point = self.tree.within(queries[tied], least[tied], relax)
            order = np.argsort(row, kind="stable")
            parts = np.split(point[order], np.searchsorted(row[order], np.arange(1, len(tied))))
            for at, more in zip(tied.tolist(), parts):
                gathered[at] = np.union1d(gathered[at], more)
        for query, vector, points in zip(ids.tolist(), queries, gathered):
            # the products are added in the order of the components
            value = np.cumsum(self.tree.points[points] * vector, axis=1)[:, -1] if len(points) else np.empty(0)
            first = np.lexsort([self.smallest[points], -value])[: k + 1]
            rows = sorted((-s, i) for s, p in zip(value[first].tolist(), points[first].tolist()) for i in self.ids[p].tolist() if i != query)
            for s, i in rows[:k]:
                yield query, i, -s


def usable(vector: Column) -> Column:
    """Not null, of finite components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def deal(rows: DataFrame, asks: Column, shards: int, blocks: int) -> DataFrame:
    """(dim, query, id, v): partition ``shard * blocks + block`` has the shard's vectors, then (query = 1) the block's queries.

    By length; a vector is in one shard and all blocks, a row that asks also in one block of each shard.
    """

    def spread(salt: int, parts: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(parts)).cast("int")

    def every_one(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    own = rows.select(spread(0, shards).alias("shard"), every_one(blocks).alias("block"), "dim", F.lit(0).alias("query"), "id", "v")
    asked = rows.where(asks).select(every_one(shards).alias("shard"), spread(1, blocks).alias("block"), "dim", F.lit(1).alias("query"), "id", "v")
    both = own.unionByName(asked).repartitionById(shards * blocks, F.col("shard") * blocks + F.col("block"))
    return both.sortWithinPartitions("dim", "query", "id").select("dim", "query", "id", "v")


def nearest_neighbours(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    every: int = QUERY_EVERY,
    k: int = NEAREST,
    relax: float = RELAX,
    shard_bytes: int = SHARD_BYTES,
    shard_rows: int | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest of each row whose id is divisible by every, among all others.

    Unusable vectors (null, zero, with a null or non-finite component) and null
    ids take no part; only vectors of the same length are compared. Repeated
    rows of an id count once (of different vectors the smallest), reduced
    before they are dealt. Ties go to the smaller id. A query with fewer than k
    candidates has all of them.

    Vectors are dealt by a hash of their id to shards of about shard_bytes (or
    shard_rows vectors), queries to blocks. Each task has a shard and a block:
    it builds the tree and takes the block's queries as they come, ``BATCH`` at
    a time, so a block may be of any size. What is shuffled is a vector once a
    block and a query once a shard. Blocks (if not given) are as many as give
    each core two tasks, of at least ``BATCH`` queries each: one from a table
    on that has more shards than that.
    """
    fresh(vectors.select(F.col(vec_id).alias("vec_id")), "query_id", "rank", "score")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    # of an id with vectors of several lengths each length is a query of its own; the best is kept below
    rows = stored(rows.groupBy(F.size("v").alias("dim"), "id").agg(F.min("v").alias("v")))
    asks = F.col("id") % every == 0
    n, queries, size, least, most = rows.agg(F.count("*"), F.count_if(asks), F.sum(F.col("dim").cast("long")), F.min("dim"), F.max("dim")).first()
    shards = max(1, math.ceil(n / shard_rows if shard_rows else 8 * (size or 0) / shard_bytes))
    if blocks is None:
        blocks = max(1, min(math.ceil(2 * vectors.sparkSession.sparkContext.defaultParallelism / shards), queries // BATCH))

    dealt = deal(rows, asks, shards, blocks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard, held = None, None, []
        for batch in batches:
            dim, query, ids = (batch.column(i).to_numpy() for i in range(3))
            if not len(dim):
                continue
            flat = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            begin = np.concatenate([[0], np.cumsum(dim)[:-1]])
            cuts = np.flatnonzero((dim[1:] != dim[:-1]) | (query[1:] != query[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(dim)]):
                if dim[a] != at:
                    at, shard, held = dim[a], None, []
                x = flat[begin[a] : begin[b - 1] + dim[b - 1]].reshape(b - a, dim[a])
                if not query[a]:
                    held.append((ids[a:b], x))
                    continue
                if shard is None:
                    if not held:
                        continue
                    shard, held = Shard(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), k), []
                for c in range(0, b - a, BATCH):
                    found = list(shard.nearest(ids[a + c : min(b, a + c + BATCH)], x[c : c + BATCH], k, relax))
                    if found:
                        q, i, s = zip(*found)
                        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(work, "query_id long, vec_id long, score double")
    # the k best of each shard are few; of an id met with several lengths the best counts
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")) if least != most else found
    ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: The same by brute force.
NEAREST_SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
), c as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
    from v q join v c on q.vec_id <> c.vec_id
    where q.vec_id % 20 = 0
), r as (
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score from c
)
select query_id, rank, vec_id, score from r where rank <= 20
"""
