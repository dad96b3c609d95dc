"""Geometry decoding in long form: one row per vertex.

* ``decode_deltas``: running sums of integer x/y deltas per feature, ordered
  by vertex position, then dequantized. The sums run across parts (they are
  not reset per ring), as the binary format specifies. The running sum lets
  a feature with a huge vertex count lie on many tasks.
* ``assign_parts``: part number of each vertex from the feature's part
  lengths. Part ends become marker rows placed just before the vertex at the
  same position; the running count of markers is the part number, so the
  vertices are joined with nothing. Vertices past the sum of the lengths are
  dropped; no lengths means one part.
* ``assemble``: vertices back into the nested geometry struct. A geometry is
  rebuilt only from vertices that came out of one geometry value, so its
  size is bounded by that value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.geometry import dequantize_x, dequantize_y
from tessera.functions.indexing import running_sum
from tessera.schemas import GEOMETRY


def decode_deltas(
    vertices: DataFrame,
    feature: Sequence[str],
    position: str,
    dx: str = "dx",
    dy: str = "dy",
    x_scale=1.0,
    y_scale=1.0,
    x_translate=0.0,
    y_translate=0.0,
    origin=0,
) -> DataFrame:
    """Add ``x``, ``y``: dequantized running sums of ``dx``, ``dy``."""
    cum = running_sum(vertices, feature, position, [dx, dy], suffix="_cum")
    return cum.withColumn("x", dequantize_x(F.col(f"{dx}_cum"), x_scale, x_translate)).withColumn(
        "y", dequantize_y(F.col(f"{dy}_cum"), y_scale, y_translate, origin)
    ).drop(f"{dx}_cum", f"{dy}_cum")


#: More than any number of parts.
_CLOSED = 1 << 40


def assign_parts(
    vertices: DataFrame,
    lengths: DataFrame,
    feature: Sequence[str],
    index: str,
    part: str = "part",
    length: str = "length",
) -> DataFrame:
    """Add ``part`` (0-based) to vertices; ``index`` is the 0-based vertex index.

    ``lengths`` holds (feature..., part, length) with ``part`` giving the
    order of the parts of a feature.
    """
    f = list(feature)
    cols = list(vertices.columns)
    payload = [c for c in cols if c not in f]
    ends = running_sum(lengths.select(*f, part, length), f, part, [length], suffix="_end")
    # the marker of a feature's last part adds so much that what comes after it can be told
    last = lengths.groupBy(*f).agg(F.max(part).alias("_last"))
    last = last.select(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(f)], "_last")
    ends = ends.join(last, [F.col(c).eqNullSafe(F.col(f"_f{i}")) for i, c in enumerate(f)])
    markers = ends.select(
        *f,
        *[F.lit(None).cast(vertices.schema[c].dataType).alias(c) for c in payload],
        (F.col(f"{length}_end") * 2).alias("_pos"),
        F.when(F.col(part) == F.col("_last"), F.lit(1 + _CLOSED)).otherwise(F.lit(1)).cast("bigint").alias("_m"),
    )
    points = vertices.select(*f, *payload, (F.col(index) * 2 + 1).alias("_pos"), F.lit(0).cast("bigint").alias("_m"))
    counted = running_sum(points.unionByName(markers), f, "_pos", ["_m"], suffix="_cum")
    out = counted.where((F.col("_m") == 0) & (F.col("_m_cum") < _CLOSED))
    return out.select(*cols, F.col("_m_cum").alias(part))


def assemble(
    vertices: DataFrame,
    feature: Sequence[str],
    index: str,
    part: str = "part",
    kind: str | None = "type",
    wkid: str | None = "wkid",
) -> DataFrame:
    """Vertices (feature, part, index, x, y [, type, wkid]) -> (feature..., geometry).

    Points take their first vertex; other kinds keep parts in part order
    (a multipoint keeps one part).
    """
    f = list(feature)
    extra = [c for c in (kind, wkid) if c]
    per_part = vertices.groupBy(*f, part).agg(
        F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), "x", "y"))).alias("_v"),
        *[F.first(c).alias(c) for c in extra],
    )
    per_feature = per_part.groupBy(*f).agg(
        F.array_sort(
            F.collect_list(
                F.struct(F.col(part).alias("p"), F.transform("_v", lambda v: F.struct(v["x"], v["y"])).alias("v"))
            )
        ).alias("_parts"),
        *[F.first(c).alias(c) for c in extra],
    )
    parts = F.transform("_parts", lambda p: p["v"])
    t = F.col(kind) if kind else F.lit("polygon")
    first = F.get(F.get(parts, 0), 0)
    geom = F.struct(
        t.alias("type"),
        F.when(t == "point", first["x"]).alias("x"),
        F.when(t == "point", first["y"]).alias("y"),
        F.when(t == "multipoint", F.array(F.flatten(parts)))
        .when(t != "point", parts)
        .alias("parts"),
        (F.col(wkid) if wkid else F.lit(None)).cast("int").alias("wkid"),
    ).cast(GEOMETRY)
    return per_feature.select(*f, geom.alias("geometry"))
