"""Two encodings of one layer compared feature by feature.

A layer read once as JSON pages and once as binary pages must give the same
features: same keys on both sides, equal attributes (NULL-safe), the same
vertex count and coordinates within a tolerance (binary pages carry
quantized coordinates). One full outer join on the key; vertex comparison
stays inside each joined row (``zip_with`` over the flattened parts).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _vertices(geometry: Column) -> Column:
    pts = F.when(geometry["type"] == "point", F.array(F.struct(geometry["x"].alias("x"), geometry["y"].alias("y"))))
    return F.coalesce(pts, F.flatten(geometry["parts"]), F.array().cast("array<struct<x:double,y:double>>"))


def compare_encodings(
    left: DataFrame,
    right: DataFrame,
    key: str,
    attributes: Sequence[str],
    tolerance: float = 0.01,
    geometry: str = "geometry",
) -> DataFrame:
    """(key, in_json, in_pbf, same_attributes, n_vertices_json, n_vertices_pbf,
    coords_within_tol) per key of either side."""
    others = [a for a in attributes if a != key]
    a = left.select(F.col(key).alias("_k"), F.struct(*others).alias("_a"), _vertices(F.col(geometry)).alias("_v"))
    b = right.select(F.col(key).alias("_k"), F.struct(*others).alias("_a"), _vertices(F.col(geometry)).alias("_v"))
    j = a.alias("l").join(b.alias("r"), F.col("l._k") == F.col("r._k"), "full_outer")
    lv, rv = F.col("l._v"), F.col("r._v")
    same = F.lit(True)
    for c in others:
        same = same & F.col(f"l._a.`{c}`").eqNullSafe(F.col(f"r._a.`{c}`"))
    gaps = F.zip_with(
        lv, rv, lambda u, v: F.greatest(F.abs(u["x"] - v["x"]), F.abs(u["y"] - v["y"]))
    )
    within = (F.size(lv) == F.size(rv)) & F.coalesce(
        F.array_max(gaps) <= F.lit(tolerance), F.size(lv) == 0
    )
    both = F.col("l._k").isNotNull() & F.col("r._k").isNotNull()
    return j.select(
        F.coalesce(F.col("l._k"), F.col("r._k")).alias(key),
        F.col("l._k").isNotNull().alias("in_json"),
        F.col("r._k").isNotNull().alias("in_pbf"),
        (both & same).alias("same_attributes"),
        F.size(lv).alias("n_vertices_json"),
        F.size(rv).alias("n_vertices_pbf"),
        F.coalesce(both & within, F.lit(False)).alias("coords_within_tol"),
    )
