"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontam, fim, langid, lattice, pieces, quality, secrets, simhash, token_counts, toxicity, vptree, whitening
from tessera.llm.frames import held_out


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files lie (a parameter of the operators; the queries use the installed ones)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digests(done: DataFrame) -> list[Column]:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return [
        done["doc_id"],
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    ]


def encoded(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, the digests of ids and decoded text, and the ids if asked for."""
    done = bpe.encode_decode(docs, tokenizer_path("byte_bpe_50k.json"))
    return done.select(*digests(done), *(["ids"] if with_ids else []))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), folds=3, fold=1)
    return quality.score(docs, model).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op4_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.text_scores(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), folds=10, fold=0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), folds=5, fold=0)
    return toxicity.score(docs, model).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, folds=3, fold=1)
    return langid.predict(docs, model).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op8_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = secrets.ordered("found.assign", "found.access", "found.hex")
    return found.select(
        "doc_id",
        *[F.size(f"found.{k}").cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(secrets.ordered("found.assign", "found.access", "found.hex", "found.added")).alias("spans"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    done = whitening.whiten(vectors, whitening.fit(vectors))
    return done.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fim.restore(fim.fill_in_middle(table(spark, sf_dir, "documents")))
    return done.select(
        *["doc_id", "n", "form", "prefix_chars", "middle_chars"],
        *[F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")],
    )


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pieces.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return done.select(*digests(done))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_token_counts": op3_token_counts,
    "op4_lattice": op4_lattice,
    "op5_toxicity": op5_toxicity,
    "op6_decontam": op6_decontam,
    "op7_langid": op7_langid,
    "op8_vptree": op8_vptree,
    "op9_simhash": op9_simhash,
    "op10_secrets": op10_secrets,
    "op11_whitening": op11_whitening,
    "op12_fim": op12_fim,
    "op13_pieces": op13_pieces,
}

ORACLE_SQL: dict[str, str] = {
    "op6_decontam": decontam.CONTAMINATED_SQL,
    "op8_vptree": vptree.NEAREST_SQL,
    "op12_fim": fim.FIM_SQL,
}
