"""SimHash near-duplicates with pivot distance tables.

Fingerprints of equal value are one node. Two nodes that differ in at most
two of 64 bits agree in at least two of four 16-bit blocks, so candidates meet
in the buckets of six 32-bit keys. Each node carries its Hamming distances to
``PIVOTS`` reference fingerprints; by the triangle inequality no coordinate
of a linked pair differs by more than the limit, which discards pairs before
the exact distance is taken.

A bucket with more than ``CROWD`` nodes (a cluster of near copies) would give
pairs with the square of its size. Its nodes are linked exactly without
pairs: two values differ in at most two bits if and only if they share a
value that differs from each in at most one bit. Every node of a crowded
bucket names those 65 values, and the nodes of one value (65 at most, all
within two bits of each other) are tied to the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.frames import ROW, fresh, mapped, numbered, stored, without
from tessera.llm.graph import components

SHINGLE, MAX_BITS, SEED = 3, 2, 42
PIVOTS, BLOCKS, CROWD = 16, 4, 32
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16


def shingle_hashes(body: bytes, shingle: int) -> Iterator[np.ndarray]:
    """Unsigned XXH64 values of a text's shingles, repeats included, in blocks."""
    words = body.lower().split()  # of bytes: A-Z, and the spaces 0x20 and 0x09-0x0D
    if not words:
        return
    if len(words) < shingle:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        return
    count = len(words) - shingle + 1
    for a in range(0, count, COUNTED):
        part = words[a : min(a + COUNTED, count) + shingle - 1]
        joined = map(b" ".join, zip(*(part[k:] for k in range(shingle))))
        yield np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), np.uint64)


def fingerprints_of(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text: a bit is set if over half the hashes have it; no words: zero."""
    out = np.zeros(len(texts), np.uint64)
    for i, body in enumerate(texts):
        ones, n = np.zeros(64, np.int64), 0
        for h in shingle_hashes(body, shingle):
            ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(h)
        out[i] = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """The columns keep and the fingerprint (its 64 bits as a signed long). A null text counts as empty: zero."""

    def of_group(body: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        return [fingerprints_of([body[a:b].tobytes() for a, b in zip(offsets, offsets[1:])], shingle).view(np.int64)]

    return mapped(docs, keep, text, [T.StructField(out, T.LongType(), False)], lambda: of_group)


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(nodes: DataFrame, fp: str = "fp", max_bits: int = MAX_BITS, pivots: int = PIVOTS, crowd: int = CROWD) -> DataFrame:
    """(a, b) of distinct fingerprints that connect all those within max_bits of each other (2 at most).

    nodes must hold each value once. Not every linked pair is listed within a
    crowded bucket, but its ends are connected through listed ones.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the block keys and the shared neighbours hold for at most 2 bits")
    x = F.col(fp)
    references = [F.xxhash64(F.lit(i)) for i in range(pivots)]
    table = nodes.select(x.alias("fp"), F.array(*[distance(x, r).cast("tinyint") for r in references]).alias("far"))
    width = 64 // BLOCKS
    masks = [((1 << width) - 1) << (width * i) for i in range(BLOCKS)]
    keys = [m1 | m2 for m1, m2 in combinations(masks, 2)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    named = F.array(*[F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("part")) for i, m in enumerate(keys)])
    keyed = table.select("fp", "far", F.explode(named).alias("at")).select("fp", "far", "at.k", "at.part")
    sizes = keyed.groupBy("k", "part").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(keyed.join(sizes, ["k", "part"]))
    a = met.where(F.col("n") <= crowd)
    b = a.select("k", "part", F.col("fp").alias("fp2"), F.col("far").alias("far2"))
    apart = F.array_max(F.zip_with("far", "far2", lambda p, q: F.abs(p - q)))
    near = a.join(b, ["k", "part"]).where((F.col("fp") < F.col("fp2")) & (apart <= max_bits) & (distance(F.col("fp"), F.col("fp2")) <= max_bits))
    near = near.select(F.col("fp").alias("a"), F.col("fp2").alias("b"))
    if max_bits == 0:
        return near
    crowded = met.where(F.col("n") > crowd).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << i)).cast("long") for i in range(64)])
    shared = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("v"))
    if max_bits == 1:  # only those that are themselves a shared value's neighbour
        tied = shared.join(crowded.select(F.col("fp").alias("v")), "v", "left_semi").where("fp < v").select(F.col("fp").alias("a"), F.col("v").alias("b"))
    else:
        meet = shared.groupBy("v").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all")).where("size(all) > 1")  # 65 at most
        tied = meet.select("a", F.explode("all").alias("b")).where("a <> b")
    return near.unionByName(tied).distinct()


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    fingerprint: str = "fingerprint",
    component: str = "component_id",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id of every row.

    component_id is the smallest doc_id of the rows whose fingerprints are
    connected by links of at most max_bits bits. Empty and null texts have
    fingerprint zero and link like any other. Repeated rows each give their
    row; a null doc_id takes part but never names a component unless all its
    members are null. Extra columns aren't read.
    """
    fresh(docs.select(doc_id), fingerprint, component)
    fps = stored(fingerprints(docs, (doc_id,), text, "__fp", shingle).withColumnRenamed(doc_id, "__id"))
    nodes = stored(fps.groupBy(F.col("__fp").alias("fp")).agg(F.min("__id").alias("least")))
    joined = rooted(nodes, max_bits)
    least = joined.groupBy("root").agg(F.min("least").alias("__component"))
    named = joined.join(least, "root").select(F.col("fp").alias("__fp"), "__component")
    return fps.join(named, "__fp").select(
        F.col("__id").alias(doc_id),
        F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias(fingerprint),
        F.col("__component").alias(component),
    )


def rooted(nodes: DataFrame, max_bits: int) -> DataFrame:
    """nodes (fp, least) with the root of each one's component; a node without a link is its own."""
    found = components(links(nodes, "fp", max_bits))
    return nodes.join(found, nodes.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id (a null id last; of repeated ids the first row).

    docs must be a stored table: its rows are numbered in two reads.
    """
    rows = numbered(docs)
    fps = stored(fingerprints(rows, (ROW, doc_id), text, "__fp", shingle))
    first = F.min(F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(ROW).alias("row")))
    nodes = stored(fps.groupBy(F.col("__fp").alias("fp")).agg(first.alias("least")))
    kept = rooted(nodes, max_bits).groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.row").alias(ROW))
    return without(rows, fps.select(ROW).join(kept, ROW, "left_anti"))
