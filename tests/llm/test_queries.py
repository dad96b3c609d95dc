"""The registered queries: columns, whole tables, and DuckDB where SQL can express them."""

import hashlib
import zlib

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF0001
from tests.llm.test_secrets import every as spans_of
from tests.llm.test_simhash import brute as components_of
from tessera.llm import decontam, queries, secrets, toxicity

COLUMNS = {
    "op1_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op2_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op4_lattice": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op5_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_decontam": "doc_id bigint, item_id bigint, n_window int, n_equal int",
    "op7_langid": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op8_vptree": "query_id bigint, rank int, vec_id bigint, score double",
    "op9_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op10_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op11_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    "op12_fim": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string",
    "op13_pieces": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
}
FOLDS = {"op2_quality": (3, 1), "op4_lattice": (10, 0), "op5_toxicity": (5, 0), "op7_langid": (3, 1)}


def test_all_thirteen_are_there():
    assert {int(q[2:].split("_")[0]) for q in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF0001)
    assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == COLUMNS[name]
    rows = df.collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    if name not in ("op6_decontam", "op8_vptree", "op11_whitening"):
        assert sorted(r.doc_id for r in rows) == sorted(docs)
    if name in FOLDS:
        folds, fold = FOLDS[name]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in rows)
    if name == "op10_secrets":
        kinds = secrets.KINDS
        for r in rows:
            spans = spans_of(docs[r.doc_id].text)
            tell = lambda xs: ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in xs)
            assert r.spans == tell(spans)
            assert r.base_sha256 == hashlib.sha256(tell([s for s in spans if s[1] < 3]).encode()).hexdigest()
            assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
    if name in queries.ORACLE_SQL:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "embeddings"):
            con.execute(f"create view {t} as select * from '{SF0001}/{t}.parquet'")
        rel = con.sql(queries.ORACLE_SQL[name])
        assert rel.columns == df.columns
        assert sorted(rel.fetchall()) == sorted(map(tuple, rows))


def test_pipeline_against_brute_force(spark, tokenizer):
    """Each stage decided anew in plain Python, on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF0001}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, model).collect() if r.score >= 0.5}
    left = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in toxic}
    assert toxic and len(left) > 100
    left = {int(i): left[int(i)] for i, _, c in components_of(list(left.items())) if int(i) == c}
    con = duckdb.connect()
    con.execute(f"create view benchmark as select * from '{SF0001}/benchmark.parquet'")
    con.register("left_", spark.createDataFrame(list(left.items()), "doc_id long, text string").toArrow())
    con.execute("create table documents as select * from left_")
    bad = {r[0] for r in con.sql(decontam.CONTAMINATED_SQL).fetchall()}
    left = {i: t for i, t in left.items() if i not in bad}
    for i, text in left.items():
        out, at = "", 0
        for a, _, b in spans_of(text):
            if a >= at:
                out += text[at:a] + "[SECRET]"
            at = max(at, b)
        left[i] = out + text[at:]
    library = Tokenizer.from_file(tokenizer)
    rows = corpus_pipeline.run(spark, SF0001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(left)
    for r in rows:
        assert r.n_tokens == len(library.encode(left[r.doc_id], add_special_tokens=False).ids)
        assert r.decoded_sha256 == hashlib.sha256(left[r.doc_id].encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(r.ids).hexdigest()


def test_stages_keep_odd_rows_whole(spark, odd, scratch):
    """Null ids and texts, repeats and extra columns go through every stage."""
    odd.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the kind is said in any of these documents at all, I do believe it")], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, scratch)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{scratch}/{i}")
        docs = spark.read.parquet(f"{scratch}/{i}")
    assert docs.count() == 6
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_pipeline_of_nothing(spark, empty, scratch):
    empty.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0
