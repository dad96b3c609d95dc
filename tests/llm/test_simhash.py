"""Fingerprints and components against brute force."""

import random

import xxhash

from tests.conftest import SF0001
from tessera.llm import simhash
from tessera.llm.graph import components


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(values, close):
    """Smallest member of each value's component, all pairs looked at."""
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    order = sorted(root)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if close(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in order}


def near(a, b, bits=2):
    return ((a ^ b) & (2**64 - 1)).bit_count() <= bits


def brute(rows):
    """component of each (id, text): smallest id not null."""
    fps = {fingerprint(t) for _, t in rows}
    root = roots(fps, near)
    least = {}
    for i, t in rows:
        r = root[fingerprint(t)]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted((str(i), f"{fingerprint(t):016x}", least[root[fingerprint(t)]]) for i, t in rows)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [(str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got) == brute(rows)


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = [(str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    assert simhash.near_duplicates(empty).count() == 0


def test_crowded_buckets_lose_no_link(spark):
    rng = random.Random(0)
    values = {rng.getrandbits(64)}
    for _ in range(250):
        v = rng.choice(sorted(values))
        for _ in range(rng.choice([1, 2])):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    values |= {rng.getrandbits(64) for _ in range(100)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    for crowd, bits in ((2, 2), (1000, 2), (2, 1)):
        found = {r.node: r.root for r in components(simhash.links(nodes, "fp", bits, crowd=crowd)).collect()}
        want = roots(signed, lambda a, b: near(a, b, bits))
        assert {v: found.get(v, v) for v in signed} == want


def test_components_of_a_chain_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (7, 7), (None, 3), (200, 201), (201, 200), (200, 201)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each(spark, odd, scratch):
    odd.write.parquet(scratch)
    docs = spark.read.parquet(scratch)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    # 1 and 5 are copies; 2, 3, 4 and a null id are empty
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "6", "7", "8", "None"]
