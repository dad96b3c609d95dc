"""Global and per-group positions computed without a single-task window.

``dense_index``: 0-based position of every row in a total order. The data is
range-partitioned and sorted, each row gets (partition id, position within
the partition), the result is checkpointed (so both uses below see the very
same partitions, also after executor loss or AQE re-planning), and a
per-partition row count -- one row per partition, a proven size bound --
is read on the driver, turned into start offsets and broadcast back.

``running_sum``: inclusive running sums within groups, ordered by an integer
position that is unique within the group. A window over a whole group would
put a hot group (a third of all rows) into one task, so the rows are sorted
over all partitions by group and position, however sparse the positions are:
a hot group lies on several neighbouring partitions. Each task sums along its
rows, starting anew at each group. Only the first group of a partition can
have begun on the partitions before it; its carry follows from the ends of
these partitions -- two rows each, which the driver reads -- and is broadcast
back, one row per partition. The sorted rows are checkpointed, as both the
ends and the result read them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_root

_MONO_SHIFT = 33  # monotonically_increasing_id puts the partition id above bit 33


def dense_index_with_count(
    df: DataFrame, order: Sequence[Column | str], name: str = "idx"
) -> tuple[DataFrame, int]:
    """``dense_index`` plus the total row count, from the same pass."""
    spark = df.sparkSession
    checkpoint_root(spark)
    ordered = df.orderBy(*order)
    tagged = (
        ordered.withColumn("_pid", F.spark_partition_id())
        .withColumn(
            "_local",
            F.monotonically_increasing_id()
            - F.shiftleft(F.col("_pid").cast("bigint"), _MONO_SHIFT),
        )
        .checkpoint(eager=True)
    )
    # One row per partition: the driver reads a list bounded by the partition count.
    counts = sorted(
        (r["_pid"], r["_n"])
        for r in tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect()
    )
    starts, total = [], 0
    for pid, n in counts:
        starts.append((pid, total))
        total += n
    offsets = spark.createDataFrame(starts, "_pid int, _start bigint")
    indexed = (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_start") + F.col("_local"))
        .drop("_pid", "_local", "_start")
    )
    return indexed, total


def dense_index(df: DataFrame, order: Sequence[Column | str], name: str = "idx") -> DataFrame:
    return dense_index_with_count(df, order, name)[0]


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two columns of equal length hold equal values; nulls are equal, and so are NaNs."""
    if pa.types.is_nested(a.type):
        return np.array([x == y for x, y in zip(a.to_pylist(), b.to_pylist())], bool)
    equal = pc.fill_null(pc.equal(a, b), False)
    equal = pc.or_(equal, pc.and_(a.is_null(), b.is_null()))
    if pa.types.is_floating(a.type):
        equal = pc.or_(equal, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return equal.to_numpy(zero_copy_only=False)


def _summed(values: pa.Array, start: np.ndarray, before: tuple, whole: bool) -> tuple[pa.Array, tuple]:
    """Sums along a batch that begin anew where start is true, going on from before: (sum, number of values)."""
    there = values.is_valid().to_numpy(zero_copy_only=False)
    v = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64 if whole else np.float64)
    total, count = np.cumsum(v), np.cumsum(there)
    if whole and len(v) and np.abs(np.cumsum(v.astype(np.float64))).max() + abs(before[0]) > 2.0**62:
        raise OverflowError("a running sum leaves the range of 64 bits")
    at = np.flatnonzero(start)
    run = np.cumsum(start)  # 0: goes on from the batch before
    base = np.concatenate([[-before[0]], total[at] - v[at]])[run]
    seen = np.concatenate([[-before[1]], count[at] - there[at]])[run]
    sums, number = total - base, count - seen
    return pa.array(sums, mask=number == 0), (sums[-1].item(), int(number[-1]))


def running_sum(
    df: DataFrame,
    group: Sequence[str],
    position: str,
    values: Sequence[str],
    suffix: str = "_cum",
) -> DataFrame:
    """Add ``<v><suffix>`` = sum of ``v`` over rows of the group at or before ``position``.

    Nulls in ``v`` add nothing (the sum is null until the first value). Rows
    whose group is null are a group; null positions come first.
    """
    g, vs = list(group), list(values)
    kinds = ["bigint" if isinstance(df.schema[v].dataType, T.IntegralType) else "double" for v in vs]
    inner = [f"_{v}_in" for v in vs]
    checkpoint_root(df.sparkSession)
    ordered = df.orderBy(*g, position)
    columns = df.columns
    added = [T.StructField(n, T.LongType() if k == "bigint" else T.DoubleType()) for n, k in zip(inner, kinds)]
    flags = [T.StructField("_pid", T.IntegerType()), *[T.StructField(n, T.BooleanType()) for n in ("_head", "_end")]]
    schema = T.StructType([*df.schema.fields, *added, *flags])

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        held: list | None = None  # the last batch, until it is known whether rows follow
        last, before, head = None, [(0, 0)] * len(vs), True

        def out(arrays: list, end: bool) -> pa.RecordBatch:
            n = len(arrays[0])
            ends = np.zeros(n, bool)
            ends[-1] = end
            return pa.RecordBatch.from_arrays([*arrays, pa.array(ends)], names=[*columns, *inner, "_pid", "_head", "_end"])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            start = np.zeros(n, bool)
            for c in g:
                own = batch.column(c)
                start[1:] |= ~_same(own[1:], own[:-1])
                if last is not None:
                    start[0] |= not _same(own[:1], last[c])[0]
            first = last is None
            last = {c: batch.column(c)[-1:] for c in g}
            opens = start.copy()
            opens[0] |= first
            sums = [_summed(batch.column(v), opens, b, k == "bigint") for v, b, k in zip(vs, before, kinds)]
            before = [b for _, b in sums]
            heads = (np.cumsum(start) == 0) & head
            head = bool(heads[-1])
            if held is not None:
                yield out(held, False)
            held = [*batch.columns, *[s for s, _ in sums], pa.array(np.full(n, pid, np.int32)), pa.array(heads)]
        if held is not None:
            yield out(held, True)

    d = ordered.mapInArrow(along, schema).checkpoint(eager=True)
    carries = _carries(d, g, inner)
    # one row a partition
    table = df.sparkSession.createDataFrame(carries, T.StructType([T.StructField("_pid", T.IntegerType()), *[T.StructField(f"_{v}_off", f.dataType) for v, f in zip(vs, added)]]))
    joined = d.join(F.broadcast(table), "_pid", "left")

    def total(v: str) -> Column:
        own, carried = F.col(f"_{v}_in"), F.when(F.col("_head"), F.col(f"_{v}_off"))
        return F.coalesce(own + carried, own, carried)

    return joined.select(*columns, *[total(v).alias(f"{v}{suffix}") for v in vs])


def _carries(d: DataFrame, group: list[str], inner: list[str]) -> list[tuple]:
    """(partition, carry of each value into its first group), from the last row and the first group of each partition."""
    same = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(group)])
    ends = d.where("_end").select("_pid", same.alias("g"), "_head", *inner)
    heads = d.where("_head").groupBy("_pid").agg(F.min(same).alias("g"))
    first = {r["_pid"]: r["g"] for r in heads.collect()}
    out, before, open_ = [], None, [None] * len(inner)
    add = lambda a, b: b if a is None else a if b is None else a + b
    for r in sorted(ends.collect(), key=lambda r: r["_pid"]):
        carry = open_ if before is not None and _equal(before, first[r["_pid"]]) else [None] * len(inner)
        out.append((r["_pid"], *carry))
        own = [r[c] for c in inner]
        open_ = [add(a, b) for a, b in zip(carry, own)] if r["_head"] else own  # one group all over goes on
        before = r["g"]
    return out


def _equal(a, b) -> bool:
    """Whether two groups are one: nulls are equal, and so are NaNs."""
    return all(x == y or (x is None and y is None) or (x != x and y != y) for x, y in zip(a, b))
