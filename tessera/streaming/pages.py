"""Incremental ingestion of a layer's pages as they land.

A bulk read waits for every page; here pages are picked up as they arrive in
``<root>/pages`` (written by any fetcher, e.g. ``land_pages``): a Structured
Streaming query over the ``binaryFile`` source turns each new page file into a
page-table row, and every micro-batch is decoded with the same DataFrame
operators as the bulk read and appended to a feature table.

Exactly-once output: a micro-batch writes to ``<sink>/batch=<id>`` in
overwrite mode, so a replayed batch (after a failure, the checkpoint makes
Spark replay the last uncommitted batch) replaces its own output instead of
duplicating it. ``ingest_progress`` compares what was ingested with the page
plan of the layer (count document and page size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.sources.feature_source import read_layer_docs
from tessera.sources.layer import decode_pages
from tessera.sources.pages import plan_pages


def _layer_docs(root: str) -> tuple[int, int]:
    total, info = read_layer_docs(root)
    chunk = int((info.get("standardMaxRecordCount") or 2000) * (info.get("maxRecordCountFactor") or 1.0))
    return total, chunk


def page_stream(
    spark: SparkSession,
    root: str,
    fmt: str = "json",
    layer: str = "layer",
    max_pages_per_batch: int = 1000,
) -> DataFrame:
    """Streaming page table over the page files of a landed layer; a
    micro-batch takes at most ``max_pages_per_batch`` new pages, so a large
    backlog is ingested in bounded batches."""
    if fmt not in ("json", "pbf"):
        raise ValueError(f"invalid response format {fmt!r} (expected 'json' or 'pbf')")
    total, chunk = _layer_docs(root)
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", f"*.{fmt}")
        .option("maxFilesPerTrigger", str(int(max_pages_per_batch)))
        .load(f"{root.rstrip('/')}/pages")
    )
    offset = F.regexp_extract("path", r"/(\d+)\.[a-z]+$", 1).cast("bigint")
    return files.select(
        F.lit(layer).alias("layer"),
        (offset / F.lit(chunk)).cast("bigint").alias("page"),
        offset.alias("offset"),
        F.lit(chunk).cast("bigint").alias("chunk_size"),
        F.lit(fmt).alias("format"),
        F.col("content").alias("body"),
        F.lit("ok").alias("status"),
        F.least(F.lit(chunk).cast("bigint"), F.lit(total) - offset).alias("expected_rows"),
    )


def ingest_pages(
    spark: SparkSession,
    root: str,
    attributes: T.StructType,
    sink: str,
    checkpoint: str,
    fmt: str = "json",
    with_geometry: bool = False,
    available_now: bool = True,
    processing_time: str | None = None,
    max_pages_per_batch: int = 1000,
) -> StreamingQuery:
    """Start the ingestion query; rows land under ``sink`` with ``page``."""
    pages = page_stream(spark, root, fmt, max_pages_per_batch=max_pages_per_batch)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        feats = decode_pages(
            batch.select("layer", "page", "offset", "chunk_size", "format", "body", "status", "expected_rows"),
            attributes,
            with_geometry,
            fmt,
            strict=True,  # a page at fault stops the query; it is read again when it has been mended
        )
        feats.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={batch_id}")

    w = pages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_ingested(spark: SparkSession, sink: str, attributes: T.StructType) -> DataFrame:
    return spark.read.schema(attributes).parquet(sink)


def ingest_progress(spark: SparkSession, root: str, checkpoint: str | None = None) -> DataFrame:
    """(pages_planned, pages_landed, fraction): landed page files against the plan."""
    total, chunk = _layer_docs(root)
    plan = plan_pages(spark, total, chunk)
    landed = (
        spark.read.format("binaryFile")
        .load(f"{root.rstrip('/')}/pages")
        .select(F.regexp_extract("path", r"/(\d+)\.[a-z]+$", 1).cast("bigint").alias("offset"))
    )
    j = plan.join(landed.withColumn("_l", F.lit(1)), "offset", "left")
    return j.agg(
        F.count(F.lit(1)).alias("pages_planned"),
        F.count("_l").alias("pages_landed"),
    ).withColumn(
        "fraction",
        F.when(F.col("pages_planned") > 0, F.col("pages_landed") / F.col("pages_planned")).otherwise(
            F.lit(1.0)
        ),
    )
