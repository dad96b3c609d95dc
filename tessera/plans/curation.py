"""Curation of raw layer rows into validated readings, and the wide table.

``curate`` is one lazy lineage: column contract (on names) -> transform ->
keep-latest (the only shuffle, on egid, annee) -> rules -> split. All outputs
are DataFrames branching from it; nothing is collected except in strict mode,
which runs one bounded probe and raises when any row failed a rule.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.contract import require_contract
from tessera.operators.dedup import dedup_counts, keep_latest
from tessera.operators.keys import key_scan, missing_keys
from tessera.operators.pivot import pivot_years, valid_years
from tessera.operators.rules import (
    FAILED,
    check_raw_types,
    rule_counts,
    split,
    with_failed_rules,
)
from tessera.operators.transform import transform
from tessera.schemas import API_COLUMNS, CURATED_COLUMNS, RAW_SCHEMA
from tessera.session import checkpoint_root, scratch_path
from tessera.sources.layer import decode_pages, read_pages


class InvalidRows(ValueError):
    pass


class NoData(RuntimeError):
    pass


@dataclass(frozen=True)
class Curated:
    deduped: DataFrame  # curated columns + objectid, one row per (egid, annee)
    checked: DataFrame  # deduped + failed_rules
    valid: DataFrame  # curated columns only
    invalid: DataFrame  # curated columns + failed_rules
    rule_counts: DataFrame  # (rule, n)
    dedup_counts: DataFrame  # (n_before, n_after, n_removed)
    missing_keys: DataFrame | None  # requested keys without a row (egid)
    keys: DataFrame | None

    def summary(self) -> DataFrame:
        """(n_valid, n_egid, n_requested): one aggregation, no join.

        Valid rows and requested keys are tagged and unioned, then counted
        together; ``n_requested`` is NULL when no keys were given.
        """
        v = self.valid.select("egid", F.lit(1).alias("_v"))
        if self.keys is not None:
            v = v.unionByName(self.keys.select("egid", F.lit(0).alias("_v")))
        req = F.sum(1 - F.col("_v")).cast("bigint") if self.keys is not None else F.lit(None)
        return v.agg(
            F.coalesce(F.sum("_v"), F.lit(0)).cast("bigint").alias("n_valid"),
            F.countDistinct(F.when(F.col("_v") == 1, F.col("egid"))).alias("n_egid"),
            req.cast("bigint").alias("n_requested"),
        )


def curate(
    raw: DataFrame,
    keys: DataFrame | None = None,
    annee_max: int | None = None,
    mode: str = "split",
    nulls: str = "first",
    check_contract: bool = True,
    returned: DataFrame | None = None,
    store: bool = False,
) -> Curated:
    """Raw layer rows (upper-case attributes) -> :class:`Curated`.

    ``keys`` (column ``egid``) restricts the rows to requested buildings and
    enables the coverage report. ``mode="strict"`` raises
    :class:`InvalidRows` when any row fails a rule; what it probes is computed
    once and written to the shared folder. ``store=True`` writes the checked
    rows there too, so that valid and invalid rows, counts, coverage and
    summary together compute them once. The column contract is checked on
    ``returned`` (column ``name``: the attribute names that the layer's pages
    hold), or without it on the columns of ``raw``.
    """
    if mode not in ("split", "strict"):
        raise ValueError(f"mode must be 'split' or 'strict', got {mode!r}")
    if check_contract:
        if returned is None:
            returned = raw.sparkSession.createDataFrame([(c,) for c in raw.columns], "name string")
        require_contract(returned.where(F.col("name") != "OBJECTID"), API_COLUMNS)
    bad_types = check_raw_types(raw)
    if bad_types:
        raise TypeError("; ".join(bad_types))
    if keys is not None:
        raw = key_scan(raw, keys, "EGID")
    t = transform(raw)
    checked = with_failed_rules(keep_latest(t, nulls=nulls), annee_max)
    if mode == "strict" or store:
        checkpoint_root(raw.sparkSession)
        checked = checked.checkpoint(eager=True)
    deduped = checked.drop(FAILED)
    parts = split(checked)
    valid = parts.valid.select(*CURATED_COLUMNS)
    invalid = parts.invalid.select(*CURATED_COLUMNS, FAILED)
    result = Curated(
        deduped=deduped,
        checked=checked,
        valid=valid,
        invalid=invalid,
        rule_counts=rule_counts(checked),
        dedup_counts=dedup_counts(t),
        missing_keys=missing_keys(keys, deduped) if keys is not None else None,
        keys=keys,
    )
    if mode == "strict":
        if keys is not None and not deduped.limit(1).collect():
            raise NoData("no data for the requested keys")
        if invalid.limit(1).collect():
            raise InvalidRows("rows failed validation; see Curated.invalid / rule_counts")
    return result


def curated_wide(
    raw: DataFrame,
    keys: DataFrame | None = None,
    annee_max: int | None = None,
    years: Iterable[int] | None = None,
) -> DataFrame:
    """Strict curation, then the (variable, year) wide table."""
    valid = curate(raw, keys, annee_max, mode="strict").valid
    return pivot_years(valid, years=valid_years(annee_max) if years is None else years)


#: The column in which a layer's rows carry the attribute names of their page.
_NAMES = "__names"


def curate_layer(
    spark: SparkSession, path: str | None = None, url: str | None = None, response_format: str = "json", **options
) -> Curated:
    """Read the readings layer and curate it: contract on the names its pages hold, strict read, strict casts.

    Each page is fetched and decoded once: its typed rows, with the names of
    its attributes beside them, are written to the shared folder; the contract
    and everything curated is read from there. ``options`` are those of
    :func:`curate`.
    """
    pages = read_pages(spark, path=path, url=url, format=response_format)
    rows = decode_pages(pages, RAW_SCHEMA, requested=response_format, strict=True, names=_NAMES)
    stored = scratch_path(spark, "layer-rows")
    rows.write.parquet(stored)
    kept = spark.read.parquet(stored)
    names = kept.select(F.explode(_NAMES).alias("name")).distinct()  # a partial distinct: a row a name and task
    return curate(kept.drop(_NAMES), returned=names, **options)
