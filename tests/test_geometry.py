import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import indexing
from tessera.functions.indexing import dense_index, running_sum
from tessera.operators.geometry import assemble, assign_parts

SF = "/root/testdata/sf0.001"


def test_running_sum_matches_window(spark):
    e = spark.read.parquet(f"{SF}/events.parquet").select(
        "user_id", "event_id", F.round(F.col("value") * 100).cast("bigint").alias("v")
    )
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    ref = {(r.user_id, r.event_id): r.s for r in e.select("user_id", "event_id", F.sum("v").over(w).alias("s")).collect()}
    got = running_sum(e, ["user_id"], "event_id", ["v"])
    assert {(r.user_id, r.event_id): r.v_cum for r in got.collect()} == ref


def _many_partitions(spark, then):
    """then() with shuffles that keep their partitions, however small."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        return then()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_running_sum_of_a_hot_group_at_sparse_positions(spark, monkeypatch):
    """Half of all rows in one group, positions far apart, nulls, several values: the group lies on many
    partitions, and the driver reads two rows of each at most."""
    rows = [("hot" if i % 2 else f"g{i % 40}", i * 1_000_003, None if i % 7 == 0 else i % 13 - 6, i * 0.25) for i in range(6000)]
    rows += [(None, i * 999_983, 1, None) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, p long, v long, x double").repartition(7)
    took = {}
    real = indexing._carries
    monkeypatch.setattr(indexing, "_carries", lambda d, g, i: took.setdefault("carries", real(d, g, i)) if took.setdefault("d", d) is not None else None)
    got = _many_partitions(spark, lambda: {(r.g, r.p): (r.v_cum, r.x_cum) for r in running_sum(df, ["g"], "p", ["v", "x"]).collect()})
    parts = took["d"].groupBy("_pid").agg(F.max((F.col("g") == "hot").cast("int")).alias("hot"), F.sum((F.col("_end")).cast("int")).alias("ends")).collect()
    assert sum(r.hot or 0 for r in parts) >= 6 and all(r.ends == 1 for r in parts) and len(took["carries"]) == len(parts)
    sums, want = {}, {}
    for g, p, v, x in sorted(rows, key=lambda r: r[1]):
        a, b = sums.get(g, (None, None))
        a, b = a if v is None else (a or 0) + v, b if x is None else (b or 0) + x
        sums[g] = want[(g, p)] = (a, b)
    assert got == want


def test_running_sum_by_several_columns(spark):
    rows = [(i % 3, None if i % 5 == 0 else float("nan") if i % 5 == 1 else float(i % 2), i, 1) for i in range(400)]
    df = spark.createDataFrame(rows, "a long, b double, p long, v int")
    got = _many_partitions(spark, lambda: running_sum(df, ["a", "b"], "p", ["v"]).collect())
    seen = {}
    for a, b, p, _ in rows:
        key = (a, str(b))
        seen[key] = seen.get(key, 0) + 1
        assert [r.v_cum for r in got if r.p == p] == [seen[key]]
    assert running_sum(df.limit(0), ["a"], "p", ["v"]).count() == 0


def test_running_sum_keeps_rows_without_a_group(spark):
    rows = [(None, 1, 5), (None, 2, 6), (7, 1, 1), (7, None, 9)]
    got = running_sum(spark.createDataFrame(rows, "g long, p long, v long"), ["g"], "p", ["v"])
    assert sorted((str(r.g), str(r.p), r.v_cum) for r in got.collect()) == [
        ("7", "1", 10), ("7", "None", 9), ("None", "1", 5), ("None", "2", 11)
    ]


def test_running_sum_raises_beyond_64_bits(spark):
    df = spark.createDataFrame([(1, i, 1 << 62) for i in range(4)], "g long, p long, v long")
    with pytest.raises(Exception, match="64 bits"):
        running_sum(df, ["g"], "p", ["v"]).collect()


def test_dense_index_is_contiguous(spark):
    df = spark.range(0, 1000, 7, numPartitions=5).select((F.col("id") * 3).alias("k"))
    idx = dense_index(df, ["k"], "i").collect()
    pairs = sorted((r.k, r.i) for r in idx)
    assert [i for _, i in pairs] == list(range(len(pairs)))


def test_parts_from_lengths_drop_surplus_and_default_one_part(spark):
    verts = spark.createDataFrame(
        [(1, i, float(i), 0.0) for i in range(6)] + [(2, i, float(i), 1.0) for i in range(3)],
        "f long, vertex long, x double, y double",
    )
    lengths = spark.createDataFrame([(1, 0, 2), (1, 1, 3)], "f long, part long, length long")
    got = sorted((r.f, r.vertex, r.part) for r in assign_parts(verts, lengths, ["f"], "vertex").collect())
    # feature 1: parts [0,1] [2,3,4]; vertex 5 is beyond the lengths -> dropped
    # feature 2: no lengths -> one part
    assert got == [(1, 0, 0), (1, 1, 0), (1, 2, 1), (1, 3, 1), (1, 4, 1), (2, 0, 0), (2, 1, 0), (2, 2, 0)]
    # two parts may end at one place, and the plan reads the vertices once
    twice = spark.createDataFrame([(1, 0, 2), (1, 1, 0), (1, 2, 1)], "f long, part long, length long")
    assert sorted((r.f, r.vertex, r.part) for r in assign_parts(verts, twice, ["f"], "vertex").collect())[:3] == [(1, 0, 0), (1, 1, 0), (1, 2, 2)]
    parts = assign_parts(verts, lengths, ["f"], "vertex").withColumn("type", F.lit("polyline")).withColumn(
        "wkid", F.lit(None).cast("int")
    )
    g = {r.f: r.geometry for r in assemble(parts, ["f"], "vertex").collect()}
    assert [[v.x for v in p] for p in g[1].parts] == [[0.0, 1.0], [2.0, 3.0, 4.0]]
    assert len(g[2].parts) == 1


def test_per_array_running_sums_property():
    from itertools import accumulate

    import pyarrow as pa
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from tessera.functions.geometry import _cumsum_lists

    pairs = st.lists(st.tuples(st.integers(-(10**9), 10**9), st.integers(-(10**9), 10**9)), max_size=8)

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.one_of(st.none(), pairs), max_size=12), st.integers(0, 3))
    def check(rows, cut):
        arr = pa.array(
            [None if r is None else [v for p in r for v in p] for r in rows], pa.list_(pa.int64())
        )
        arr = arr.slice(min(cut, len(rows)))
        expect = []
        for r in rows[min(cut, len(rows)):]:
            if r is None:
                expect.append(None)
                continue
            xs = list(accumulate(p[0] for p in r))
            ys = list(accumulate(p[1] for p in r))
            expect.append([v for xy in zip(xs, ys) for v in xy])
        assert _cumsum_lists(arr, 2).to_pylist() == expect
        flat = [None if r is None else [p[0] for p in r] for r in rows[min(cut, len(rows)):]]
        got1 = _cumsum_lists(pa.array(flat, pa.list_(pa.int64())), 1).to_pylist()
        assert got1 == [None if f is None else list(accumulate(f)) for f in flat]

    check()
