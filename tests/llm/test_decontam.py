"""Decontamination: the masks, planted substitutions, and DuckDB's brute force."""

import itertools
import math
import random

import duckdb

from tessera.llm import decontam


def test_masks_find_every_way_of_replacing():
    for size in range(1, decontam.WINDOW + 1):
        masks = [(len(m), [i for i, c in enumerate(m) if c == "1"]) for m in decontam.masks_of(size)]
        spared = 0 if size < decontam.SHORT else size - math.ceil(decontam.SHARE * size - 1e-9)
        assert spared == {6: 1, 9: 1, 10: 2, 14: 2, 15: 3}.get(size, spared)
        for gone in itertools.combinations(range(size), spared):
            assert any(all(at + i not in gone for i in mask) for span, mask in masks for at in range(size - span + 1)), (size, gone)


def _words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(4)) for _ in range(n)]


def _case(spark):
    rng = random.Random(3)
    items = [(i, " ".join(_words(rng, n))) for i, n in enumerate([15, 20, 40, 8, 6, 5, 30])]
    items += [(100, items[1][1]), (101, None), (102, ""), (0, items[0][1])]
    text = dict(items)
    docs, want = [], set()
    for k in range(60):
        item = rng.choice([0, 1, 2, 3, 4, 6])
        words = text[item].split()
        kind = k % 6
        size = len(words)
        if kind == 0:
            part, hit = words, True
        elif kind == 1 and size >= 15:  # three of fifteen replaced
            part = words[:15]
            for i in rng.sample(range(15), 3):
                part[i] = "zzz"
            hit = True
        elif kind == 2:  # every third replaced: 10 of 15
            part, hit = [w if i % 3 else "zzz" for i, w in enumerate(words)], False
        elif kind == 3 and size >= 15:  # eleven words only
            part, hit = words[:11], False
        elif kind == 4 and size > 20:
            part, hit = words[10:27], True
        elif kind == 5 and size < 15:  # of six and eight words one may be replaced, of fewer none
            part, hit = words[:-1] + ["zzz"], size >= 6
        elif kind == 1:
            part, hit = ["zzz", "zzz"] + words[2:], False
        else:
            part, hit = _words(rng, 20), False
        around = _words(rng, rng.randint(0, 60)), _words(rng, rng.randint(0, 60))
        body = " ".join([*around[0], *part, *around[1]])
        docs.append((k, body.upper() if k % 2 else body.replace(" ", ",  ")))
        if hit:
            want |= {(k, i) for i in text if text[i] == text[item]}
    docs += [(70, None), (71, ""), (72, "short"), (None, text[0]), (None, text[2]), (0, "again " + text[6])]
    want |= {(None, 0), (None, 2), (0, 6)}
    return (
        spark.createDataFrame([(i, t, "x", i) for i, t in docs], "doc_id long, text string, item_id string, n_equal long"),
        spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int"),
        want,
    )


def test_planted(spark, tmp_path):
    docs, items, want = _case(spark)
    rows = decontam.contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    assert len(rows) == len(want)
    blocks = decontam.contaminated(docs, items, seeds_at_once=40).collect()
    assert sorted(map(str, blocks)) == sorted(map(str, rows))
    con = duckdb.connect()
    con.register("docs_", docs.select("doc_id", "text").toArrow())
    con.register("items_", items.select("item_id", "text").toArrow())
    con.execute("create table documents as select distinct * from docs_ where doc_id is not null and doc_id <> 0")
    con.execute("create table benchmark as select distinct * from items_")
    brute = con.sql(decontam.CONTAMINATED_SQL).fetchall()
    assert sorted(brute) == sorted(tuple(r) for r in rows if r.doc_id)


def _against_duckdb(docs, items, rows):
    con = duckdb.connect()
    con.register("docs_", docs.select("doc_id", "text").toArrow())
    con.register("items_", items.select("item_id", "text").toArrow())
    con.execute("create table documents as select * from docs_")
    con.execute("create table benchmark as select * from items_")
    assert sorted(con.sql(decontam.CONTAMINATED_SQL).fetchall()) == sorted(map(tuple, rows))


def test_short_items_at_every_number_of_replaced_words(spark):
    """Items of 1 to 16 words with 0 to 4 replaced, at the begin, in the midst and at the end of documents."""
    rng = random.Random(9)
    items = [(n, " ".join(_words(rng, n))) for n in range(1, 17)]
    docs = []
    for n, text in items:
        for gone in range(min(n, 4) + 1):
            for _ in range(4):
                words = text.split()
                for i in rng.sample(range(n), gone):
                    words[i] = "zzz"
                left, right = _words(rng, rng.choice([0, 0, 5])), _words(rng, rng.choice([0, 0, 5]))
                docs.append((len(docs), n, gone, " ".join([*left, *words, *right])))
    frame = spark.createDataFrame(docs, "doc_id long, n int, gone int, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.contaminated(frame, bench).collect()
    own = {(r.doc_id, r.item_id): r.n_equal for r in rows}
    for i, n, gone, _ in docs:
        spared = 0 if n < 6 else min(n, 15) - math.ceil(0.8 * min(n, 15) - 1e-9)
        if n <= 15:
            assert ((i, n) in own) == (gone <= spared), (n, gone)
    _against_duckdb(frame, bench, rows)


def test_more_seeds_than_are_broadcast(spark):
    """The sieve and the shuffle find what the broadcast finds; the documents are read in one pass."""
    rng = random.Random(10)
    shared = " ".join(_words(rng, 30))
    items = [(i, " ".join(_words(rng, rng.choice([3, 8, 14, 15, 40])))) for i in range(200)] + [(1000 + i, f"{shared} tail{i}") for i in range(50)]
    docs = [(i, " ".join([*_words(rng, 50), *rng.choice(items)[1].split(), *_words(rng, 30)])) for i in range(150)]
    docs += [(500, " ".join(_words(rng, 5000) + shared.split() + _words(rng, 3000)))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    near = decontam.contaminated(frame, bench)
    far = decontam.contaminated(frame, bench, seeds_at_once=10)
    want, got = near.collect(), far.collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 200
    _against_duckdb(frame, bench, want)


def test_shared_passages_are_one_context(spark):
    rng = random.Random(11)
    shared = " ".join(_words(rng, 40))
    bench = spark.createDataFrame([(i, shared) for i in range(300)], "item_id long, text string")
    seeds, _ = decontam.seeds_of(bench, "item_id", "text", decontam.WINDOW, decontam.SHARE)
    assert seeds.select("context").distinct().count() == 70  # 35 places, two masks
    rows = decontam.contaminated(spark.createDataFrame([(1, "x " + shared)], "doc_id long, text string"), bench).collect()
    assert sorted(r.item_id for r in rows) == list(range(300))


def test_empty_tables(spark):
    docs, items, _ = _case(spark)
    assert decontam.contaminated(docs.limit(0), items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0


def test_clean_keeps_the_rest(spark, scratch):
    docs, items, _ = _case(spark)
    docs.write.parquet(scratch)
    docs = spark.read.parquet(scratch)
    left = decontam.clean(docs, items)
    assert left.columns == docs.columns
    hit = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    ids = sorted(str(r.doc_id) for r in left.collect())
    # rows are judged by themselves: of the two rows of id 0 each only if it is contaminated
    per_row = [r for r in docs.collect() if r.doc_id not in {d for d, _ in hit}]
    assert ids == sorted(str(r.doc_id) for r in per_row)


def test_no_python_in_the_plan(spark):
    docs, items, _ = _case(spark)
    plan = decontam.contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
