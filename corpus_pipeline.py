"""The training-data pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and calls one operator of
``tessera.llm``; what it returns is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents. Rows are
told apart by themselves, not by doc_id, so null and repeated ids do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontam, secrets, simhash, toxicity
from tessera.llm.queries import encoded, table
from tessera.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, learned from these documents' labels, doesn't reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), folds=5, fold=0)
    scored = toxicity.score(docs, model, tuple(docs.columns), out="__score", predicted="__toxic")
    return scored.where("__toxic = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (that of the smallest doc_id) of each group linked by SimHash fingerprints."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced and n_chars brought up to date."""
    return secrets.redact(docs, n_chars="n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens, the digests of ids and decoded text, and the ids of every document."""
    return encoded(docs, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", encode),
]

#: The classifier, the fingerprints and the tokenizer aren't for SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the intermediate tables go to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
