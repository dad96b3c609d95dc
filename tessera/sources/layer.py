"""Reading a whole layer: page table -> decoded feature rows.

``read_layer`` is the bulk read of a layer: the ``feature_pages`` source gives
the page table, whose bodies the JSON or the binary decoder turns into rows in
one pass. The binary decoder reads a body that looks like JSON as that: servers
answer errors in JSON whatever was asked for. Rows come in no particular order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path
from tessera.sources import feature_source
from tessera.sources.binary import attribute_names_pbf, decode_pbf_pages
from tessera.sources.pages import AUDIT, FEATURE, attribute_names_json, audited_pages, decode_json_pages, route


def read_pages(spark: SparkSession, path: str | None = None, url: str | None = None, **options):
    """The page table of a landed (``path``) or live (``url``) layer."""
    feature_source.register(spark)
    r = spark.read.format("feature_pages")
    if "prune_pages" not in options:
        # Page pruning needs Python filter pushdown; use it when the session has it on.
        on = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower() == "true"
        options = {**options, "prune_pages": on}
    if path:
        r = r.option("path", path)
    if url:
        r = r.option("url", url)
    for k, v in options.items():
        if v is not None:
            r = r.option(k, str(v).lower() if isinstance(v, bool) else str(v))
    return r.load()


def decode_pages(
    pages: DataFrame,
    attributes: T.StructType,
    with_geometry: bool = False,
    requested: str = "json",
    strict: bool = False,
    names: str | None = None,
    audited: bool = False,
) -> DataFrame:
    """Page table -> feature rows (attribute columns [+ geometry] [+ names] [+ ``_audit``, ``_feature``]).

    strict: every planned page must be there and hold what was planned, else
    the read raises, naming the page and what is wrong with it. names: a column
    with the attribute names met, on some rows of each page. audited: no page
    raises; each has a row that tells what was met.
    """
    met = pages if strict or audited else pages.where(F.col("body").isNotNull())
    decode = decode_pbf_pages if requested == "pbf" else decode_json_pages
    return decode(met, attributes, with_geometry, strict, names, audited)


@dataclass(frozen=True)
class LayerRead:
    rows: DataFrame  # features of the readable pages
    audit: DataFrame  # (page, offset, expected_rows, actual_rows, exceeded, status), one row a planned page


def read_layer(
    spark: SparkSession,
    attributes: T.StructType,
    path: str | None = None,
    url: str | None = None,
    where: str = "1=1",
    fields: str = "*",
    with_geometry: bool = False,
    response_format: str = "json",
    chunk_size: int | None = None,
    max_partitions: int | None = None,
    max_retries: int = 4,
    order_by: str | None = None,
    mode: str = "strict",
) -> DataFrame | LayerRead:
    """Every feature of a layer as typed rows (the bulk layer read).

    mode "strict" raises when a page is missing, corrupt, an error, overflows
    or holds another number of rows than planned; "split" gives the rows of the
    readable pages, JSON or binary, and the audit of all pages (a
    :class:`LayerRead`): each page is fetched and decoded once, at the call, and
    its rows and what was met are written to the shared folder, so that the audit
    is of the very pages that the rows come from. ``fields`` is cut
    before decoding. ``where`` goes to a live server; of a landed layer, which
    is whole, the decoded rows are filtered by it.
    """
    if response_format not in ("json", "pbf"):
        raise ValueError(
            f"invalid response format {response_format!r} (expected 'json' or 'pbf')"
        )
    if mode not in ("strict", "split"):
        raise ValueError(f"mode must be 'strict' or 'split', got {mode!r}")
    filtered = where.strip() not in ("", "1=1")
    keep = None if fields.strip() == "*" else [f.strip() for f in fields.split(",") if f.strip()]
    wanted = attributes
    if keep is not None and not (path and filtered):
        wanted = T.StructType([attributes[f] for f in keep])
    pages = read_pages(
        spark,
        path=path,
        url=url,
        format=response_format,
        where="1=1" if path else where,
        fields=fields,
        returnGeometry=with_geometry,
        chunk_size=chunk_size,
        max_partitions=max_partitions,
        max_retries=max_retries,
        order_by=order_by,
    )
    rows = decode_pages(pages, wanted, with_geometry, response_format, mode == "strict", audited=mode == "split")
    if mode == "split":
        stored = scratch_path(spark, "layer-split")
        rows.write.parquet(stored)
        kept = spark.read.parquet(stored)
        rows = kept.where(FEATURE).drop(AUDIT, FEATURE)
    if path and filtered:
        rows = rows.where(where)
    if keep is not None:
        rows = rows.select(*keep, *(["geometry"] if with_geometry else []))
    if mode == "strict":
        return rows
    return LayerRead(rows, audited_pages(kept))


def attribute_names(pages: DataFrame, requested: str = "json") -> DataFrame:
    """Distinct attribute names that the pages hold (``name``), for the column contract."""
    routed = route(pages.where(F.col("body").isNotNull()), requested)
    names = attribute_names_json(routed.where(F.col("route") == "json"))
    if requested == "pbf":
        names = names.unionByName(attribute_names_pbf(routed.where(F.col("route") == "pbf"))).distinct()
    return names
