"""Column functions for quantized, delta-coded coordinates and geometry text."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER_LEFT, LOWER_LEFT = 0, 1


def zigzag(n: Column) -> Column:
    """Zigzag-decode an unsigned varint held in a BIGINT: ``(n >>> 1) ^ -(n & 1)``."""
    return F.shiftrightunsigned(n, 1).bitwiseXOR(-(n.bitwiseAND(F.lit(1))))


def dequantize_x(cum: Column, scale: Column | float = 1.0, translate: Column | float = 0.0) -> Column:
    s = scale if isinstance(scale, Column) else F.lit(float(scale))
    t = translate if isinstance(translate, Column) else F.lit(float(translate))
    return t + cum.cast("double") * s


def dequantize_y(
    cum: Column,
    scale: Column | float = 1.0,
    translate: Column | float = 0.0,
    origin: Column | int = UPPER_LEFT,
) -> Column:
    """``ty + sign * cum * sy``; sign is +1 for a lower-left origin, else -1."""
    s = scale if isinstance(scale, Column) else F.lit(float(scale))
    t = translate if isinstance(translate, Column) else F.lit(float(translate))
    o = origin if isinstance(origin, Column) else F.lit(int(origin))
    sign = F.when(o == LOWER_LEFT, F.lit(1.0)).otherwise(F.lit(-1.0))
    return t + sign * (cum.cast("double") * s)


def geometry_type_name(code: Column) -> Column:
    """Type code -> name; unknown codes are treated as polygons."""
    expr = F.when(code == 0, "point").when(code == 1, "multipoint").when(code == 2, "polyline")
    return expr.otherwise("polygon")


def ring_wkt(ring: Column, digits: int = 3) -> Column:
    """``POLYGON ((x y, ...))`` of one ring (array of {x, y})."""
    fmt = f"%.{digits}f %.{digits}f"
    coords = F.array_join(F.transform(ring, lambda v: F.format_string(fmt, v["x"], v["y"])), ", ")
    return F.when(F.size(ring) > 0, F.concat(F.lit("POLYGON (("), coords, F.lit("))")))


def outer_ring_wkt(geometry: Column, digits: int = 3) -> Column:
    """WKT polygon of the first ring only (holes dropped), for polygon geometries."""
    first = F.get(geometry["parts"], 0)
    return F.when(geometry["type"] == "polygon", ring_wkt(first, digits))


# ---------------------------------------------------------------------------
# Running sums inside one array (a feature's coordinates arrive in one row)
# ---------------------------------------------------------------------------


def _cumsum_lists(arr, stride: int):
    """Running sums within each list of a pyarrow ``list<int64>`` array.

    With ``stride`` 2 the even and odd positions (interleaved x, y) are summed
    separately. Every list length must be a multiple of ``stride``. One
    ``numpy.cumsum`` over the whole batch, then each list's start is
    subtracted: linear in the batch, no per-row Python. Sums wrap like a
    BIGINT.
    """
    import numpy as np
    import pyarrow.compute as pc

    arr = arr.cast(pa.list_(pa.int64()))
    lengths = pc.fill_null(pc.list_value_length(arr), 0).to_numpy().astype(np.int64)
    flat = pc.list_flatten(arr).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    m = flat.reshape(-1, stride)
    cs = np.cumsum(m, axis=0)
    cnt = lengths // stride
    ends = np.cumsum(cnt)
    starts = ends - cnt
    base = np.zeros((len(cnt), stride), dtype=np.int64)
    nz = starts > 0
    base[nz] = cs[starts[nz] - 1]
    cs -= np.repeat(base, cnt, axis=0)
    last = int(ends[-1]) * stride if len(ends) else 0
    if last > np.iinfo(np.int32).max:
        raise ValueError(f"{last} coordinates in one batch; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    offsets = pa.array(np.concatenate([[0], ends * stride]).astype(np.int32), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(cs.reshape(-1), pa.int64()), mask=arr.is_null())


def _pair_sums(a: pa.Array) -> pa.Array:
    return _cumsum_lists(a, 2)


def _sums(a: pa.Array) -> pa.Array:
    return _cumsum_lists(a, 1)


_PAIR_SUMS = None
_SUMS = None


def pair_running_sums(deltas: Column) -> Column:
    """Interleaved ``x, y`` deltas -> absolute ``x, y`` (per-array running sums
    of the even and of the odd positions); the array length must be even."""
    global _PAIR_SUMS
    if _PAIR_SUMS is None:
        _PAIR_SUMS = F.arrow_udf(_pair_sums, "array<bigint>")
    return _PAIR_SUMS(deltas)


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an integer array, per array."""
    global _SUMS
    if _SUMS is None:
        _SUMS = F.arrow_udf(_sums, "array<bigint>")
    return _SUMS(values)
