"""Connected components as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.frames import stored


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 100) -> DataFrame:
    """(node, root) of every node of the edges: root is the smallest node it is linked with.

    Each round hangs the neighbours of a node on the smallest one it knows
    (first the larger neighbours, then the smaller ones and the node itself),
    so long chains shorten geometrically. A round is two groupings by minimum
    (combined before the shuffle) and equi-joins, written to the checkpoint
    folder; the edges are never gathered. Loops and repeated edges do no harm;
    rows with a null end are ignored.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    e = stored(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    loops = e.where("u = v")
    last = None
    for _ in range(rounds):
        both = e.where("u <> v")
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # of the larger star each node now points to smaller ones only
        large = stored(large.unionByName(low.where("u <> m").select("u", F.col("m").alias("v"))).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    else:
        raise RuntimeError(f"no end after {rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    found = e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
    alone = loops.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return found.unionByName(alone.join(found, "node", "left_anti"))
