"""Keep-latest deduplication and the count of removed rows.

One row per key survives: the one with the greatest ``order`` column. By
default a NULL ``order`` value sorts first and therefore wins, as the curated
dataset's rule does; ``nulls="last"`` makes dated rows win instead. Ties are
broken by ``tie`` descending so the result is deterministic.

Plan: ``row_number() = 1`` is rewritten by Catalyst into a partial
``WindowGroupLimit`` that runs before the shuffle, so a hot key is cut to one
row per map partition before it is exchanged; the final window then sees at
most one row per key and map partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(
    df: DataFrame,
    keys: Sequence[str] = ("egid", "annee"),
    order: str = "date_saisie",
    tie: str | None = "objectid",
    nulls: str = "first",
) -> DataFrame:
    if nulls not in ("first", "last"):
        raise ValueError(f"nulls must be 'first' or 'last', got {nulls!r}")
    o = F.col(order)
    first = o.desc_nulls_first() if nulls == "first" else o.desc_nulls_last()
    ordering = [first] + ([F.col(tie).desc_nulls_last()] if tie and tie in df.columns else [])
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedup_counts(df: DataFrame, keys: Sequence[str] = ("egid", "annee")) -> DataFrame:
    """One row: rows before, rows after keep-latest, rows removed.

    A single partial+final aggregation on the keys (map-side combine, so a
    hot key costs one row per map partition in the shuffle).
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").alias("n_before"),
        F.count(F.lit(1)).alias("n_after"),
        F.sum(F.col("_n") - 1).alias("n_removed"),
    )
