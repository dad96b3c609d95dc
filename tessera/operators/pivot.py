"""Wide table: one row per building, one column per (variable, year).

The readings of a building are gathered as one array of structs (after
keep-latest there is one row per (egid, annee), so it has an entry a year at
most), the array is put in the order of the years once, and every column is a
field of an entry: no aggregate for each column, and no pivot that sorts. The
years are given, or all those that the ``annee_valide`` rule admits, so the
input is read once and the columns don't depend on the data. Columns are
ordered by variable name, then year, as ``<variable>_<year>``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.rules import default_annee_max
from tessera.schemas import ANNEE_MIN, PIVOT_VALUE_COLUMNS


def valid_years(annee_max: int | None = None) -> range:
    """The years that the ``annee_valide`` rule admits."""
    return range(ANNEE_MIN, (default_annee_max() if annee_max is None else annee_max) + 1)


def pivot_years(
    df: DataFrame,
    values: Sequence[str] = PIVOT_VALUE_COLUMNS,
    years: Iterable[int] | None = None,
    index: str = "egid",
    on: str = "annee",
) -> DataFrame:
    """One row for each value of index; of several rows of one year, one counts for each value column as a whole.

    Rows with several readings of a year must be deduplicated first
    (``keep_latest``): what a group gathers is bounded by the years then.
    """
    ys = sorted(set(valid_years() if years is None else years))
    if not ys or not values:
        return df.select(index).distinct()
    # rows of other years keep their building in the table, without an entry
    entry = F.when(F.col(on).isin(ys), F.struct(F.col(on).alias("y"), F.struct(*values).alias("v")))
    rows = df.groupBy(index).agg(F.collect_list(entry).alias("_rows"))
    first, last = ys[0], ys[-1]
    by_year = F.transform(F.sequence(F.lit(first), F.lit(last)), lambda y: F.get(F.filter("_rows", lambda r: r["y"] == y), 0)["v"])
    wide = rows.select(index, by_year.alias("_years"))
    pairs = sorted((v, y) for v in values for y in ys)
    return wide.select(index, *[F.get("_years", F.lit(y - first))[v].alias(f"{v}_{y}") for v, y in pairs])
