"""Pages made from tables, as a layer server would return them: input for the queries and tests."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.indexing import dense_index_with_count
from tessera.schemas import field_type
from tessera.sources import feature_source
from tessera.sources import page_codes as W
from tessera.sources.feature_source import PAGE_ARROW, PAGE_DDL

# --- Numbers and fields of the binary format ---------------------------------


_SMALL = [bytes([i]) for i in range(128)]


def varint(n: int) -> bytes:
    if 0 <= n < 128:
        return _SMALL[n]
    n &= (1 << 64) - 1
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        if n:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def zigzag_encode(n: int) -> int:
    return (n << 1) ^ (n >> 63) if n < 0 else n << 1


_TAGS: dict[tuple[int, int], bytes] = {}


def tag(num: int, wt: int) -> bytes:
    t = _TAGS.get((num, wt))
    if t is None:
        t = _TAGS[(num, wt)] = varint((num << 3) | wt)
    return t


def field_varint(num: int, v: int) -> bytes:
    return tag(num, 0) + varint(v)


def field_bytes(num: int, payload: bytes) -> bytes:
    return tag(num, 2) + varint(len(payload)) + payload


def field_double(num: int, v: float) -> bytes:
    return tag(num, 1) + struct.pack("<d", v)


def field_packed(num: int, values) -> bytes:
    return field_bytes(num, b"".join(varint(v) for v in values))


# --- Rows by page --------------------------------------------------------------

#: Rows of the pages that one task packs: what it holds of rows and bodies at once, however many rows there are.
ROWS_EACH = 16_000


def _by_page(features: DataFrame, key: str, chunk_size: int) -> tuple[DataFrame, int]:
    """(the rows with ``_idx``, their place in ``key`` order, and ``_page``, dealt out by page; their number).

    The number of tasks follows that of the rows: Arrow batches hold up to
    10,000 pages, so a task's pages are one batch.
    """
    idx, total = dense_index_with_count(features, [key], "_idx")
    pages, parallel = -(-total // chunk_size), features.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-total // max(ROWS_EACH, chunk_size)), min(pages, 2 * parallel), 1)
    return idx.withColumn("_page", F.floor(F.col("_idx") / chunk_size).cast("bigint")).repartition(tasks, "_page"), total


# --- JSON pages ---------------------------------------------------------------


def json_geometry(g: Column) -> Column:
    """GEOMETRY struct -> the layer's JSON geometry: ``{x, y}`` for a point,
    ``{points}`` / ``{paths}`` / ``{rings}`` of ``[x, y]`` pairs otherwise,
    with ``spatialReference: {wkid}`` when known. NULL stays NULL."""
    pairs = F.transform(g["parts"], lambda p: F.transform(p, lambda v: F.array(v["x"], v["y"])))
    t = g["type"]
    sr = F.when(g["wkid"].isNotNull(), F.struct(g["wkid"].alias("wkid")))
    return F.when(
        g.isNotNull(),
        F.struct(
            F.when(t == "point", g["x"]).alias("x"),
            F.when(t == "point", g["y"]).alias("y"),
            F.when(t == "multipoint", F.get(pairs, 0)).alias("points"),
            F.when(t == "polyline", pairs).alias("paths"),
            F.when(t == "polygon", pairs).alias("rings"),
            sr.alias("spatialReference"),
        ),
    )


def _feature_struct(df: DataFrame, geometry: str | None) -> Column:
    attrs = F.struct(*[F.col(c) for c in df.columns if c not in ("_idx", "_page", geometry)])
    if geometry:
        return F.struct(attrs.alias("attributes"), json_geometry(F.col(geometry)).alias("geometry"))
    return F.struct(attrs.alias("attributes"))


def pack_json_pages(
    features: DataFrame,
    chunk_size: int,
    key: str = "OBJECTID",
    layer: str = "layer",
    geometry: str | None = None,
) -> DataFrame:
    """Offset pages of ``chunk_size`` features in ``key`` order, as JSON bodies.

    Every page but the last carries ``exceededTransferLimit: true`` (more
    rows remain), as a server paging by offset does. NULL attributes are
    written as JSON ``null``. The per-page ``collect_list`` is bounded by
    ``chunk_size``.
    """
    idx, total = _by_page(features, key, chunk_size)
    grouped = idx.groupBy(F.col("_page").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_idx"), _feature_struct(idx, geometry).alias("f")))).alias("_fs")
    )
    offset = F.col("page") * F.lit(chunk_size)
    doc = F.struct(
        F.transform("_fs", lambda s: s["f"]).alias("features"),
        (offset + F.lit(chunk_size) < F.lit(total)).alias("exceededTransferLimit"),
    )
    body = F.to_json(doc, {"ignoreNullFields": "false"})
    return grouped.select(
        F.lit(layer).alias("layer"),
        "page",
        offset.alias("offset"),
        F.lit(chunk_size).cast("bigint").alias("chunk_size"),
        F.lit("json").alias("format"),
        F.encode(body, "UTF-8").alias("body"),
        F.lit("ok").alias("status"),
        F.least(F.lit(chunk_size).cast("bigint"), F.lit(total) - offset).alias("expected_rows"),
    )


# --- Binary pages -------------------------------------------------------------

_GEOMETRY_CODES = {"point": 0, "multipoint": 1, "polyline": 2, "polygon": 3}


def _encode_value(v, slot: str, index: int | None) -> bytes:
    if v is None:
        body = field_varint(W.VALUE_NULL, 1)
    elif slot == "string":
        body = field_bytes(W.VALUE_STRING, str(v).encode("utf-8"))
    elif slot == "double":
        body = field_double(W.VALUE_DOUBLE, float(v))
    elif slot == "sint64":
        body = field_varint(W.VALUE_SINT64, zigzag_encode(int(v)))
    elif slot == "sint32":
        body = field_varint(W.VALUE_SINT32, zigzag_encode(int(v)))
    elif slot == "uint32":
        body = field_varint(W.VALUE_UINT32, int(v))
    elif slot == "bool":
        body = field_varint(W.VALUE_BOOL, int(bool(v)))
    else:  # int64, two's complement
        body = field_varint(W.VALUE_INT64, int(v))
    if index is not None:
        body += field_varint(W.VALUE_INDEX, index)
    return body


def _encode_geometry(g: dict, q: dict) -> bytes:
    code = _GEOMETRY_CODES.get(g.get("type") or "polygon", 3)
    if code == 0:
        parts = [[{"x": g["x"], "y": g["y"]}]]
    else:
        parts = g.get("parts") or []
    sx, sy, tx, ty = q["sx"], q["sy"], q["tx"], q["ty"]
    sign = 1 if q["origin"] == 1 else -1
    deltas, px, py = [], 0, 0
    for part in parts:
        for v in part:
            cx = round((v["x"] - tx) / sx)
            cy = round(sign * (v["y"] - ty) / sy)
            deltas += [zigzag_encode(cx - px), zigzag_encode(cy - py)]
            px, py = cx, cy
    msg = field_varint(W.GEOM_TYPE, code) if code else b""
    if code not in (0, 1):
        msg += field_packed(W.GEOM_LENGTHS, [len(p) for p in parts])
    msg += field_packed(W.GEOM_COORDS, deltas)
    return msg


def encode_page(
    values: list[list],
    geometries: list[dict | None] | None,
    columns: list[tuple[str, str]],
    exceeded: bool,
    quantize: dict,
    wkid: int | None,
    default_type: int,
) -> bytes:
    """A FeatureCollection message for one page.

    ``values[i][n]`` is attribute ``columns[i]`` (name, slot) of feature
    ``n``; ``geometries[n]`` its GEOMETRY value (or None).
    """
    out = [field_varint(W.FR_GEOMETRY_TYPE, default_type) if default_type else b""]
    if wkid:
        out.append(field_bytes(W.FR_SPATIAL_REFERENCE, field_varint(W.SR_WKID, wkid)))
    if exceeded:
        out.append(field_varint(W.FR_EXCEEDED, 1))
    scale = field_double(W.XY_X, quantize["sx"]) + field_double(W.XY_Y, quantize["sy"])
    trans = field_double(W.XY_X, quantize["tx"]) + field_double(W.XY_Y, quantize["ty"])
    tf = (field_varint(W.TF_ORIGIN, quantize["origin"]) if quantize["origin"] else b"")
    tf += field_bytes(W.TF_SCALE, scale) + field_bytes(W.TF_TRANSLATE, trans)
    out.append(field_bytes(W.FR_TRANSFORM, tf))
    for name, _slot in columns:
        out.append(field_bytes(W.FR_FIELDS, field_bytes(W.FIELD_NAME, name.encode("utf-8"))))
    forward = list(range(len(columns)))
    backward = forward[::-1]
    slots = [slot for _name, slot in columns]
    n_features = len(values[0]) if values else len(geometries or [])
    for n in range(n_features):
        # every other feature names its fields by explicit index, in reverse order
        explicit = n % 2 == 1
        msg = [
            field_bytes(
                W.FEAT_ATTRIBUTES, _encode_value(values[i][n], slots[i], i if explicit else None)
            )
            for i in (backward if explicit else forward)
        ]
        g = geometries[n] if geometries is not None else None
        if g is not None:
            msg.append(field_bytes(W.FEAT_GEOMETRY, _encode_geometry(g, quantize)))
        out.append(field_bytes(W.FR_FEATURES, b"".join(msg)))
    return field_bytes(W.FC_QUERY_RESULT, field_bytes(W.QR_FEATURE_RESULT, b"".join(out)))


def _slot_for(dtype: T.DataType, name: str, slots: dict[str, str]) -> str:
    if name in slots:
        return slots[name]
    if isinstance(dtype, T.StringType):
        return "string"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    return "int64"


def pack_pbf_pages(
    features: DataFrame,
    chunk_size: int,
    key: str = "OBJECTID",
    layer: str = "layer",
    geometry: str | None = None,
    slots: dict[str, str] | None = None,
    quantize: dict | None = None,
    wkid: int | None = 2056,
    default_type: int = 3,
) -> DataFrame:
    """Offset pages of ``chunk_size`` features in ``key`` order, binary encoded.

    Pages are grouped by Spark (bounded by ``chunk_size``) and encoded one
    after the other by Arrow batch tasks.
    """
    slots = slots or {}
    q = {"origin": 0, "sx": 1.0, "sy": 1.0, "tx": 0.0, "ty": 0.0, **(quantize or {})}
    attr_cols = [c for c in features.columns if c != geometry]
    columns = [(c, _slot_for(features.schema[c].dataType, c, slots)) for c in attr_cols]
    idx, total = _by_page(features, key, chunk_size)
    entry = [F.col("_idx"), F.struct(*attr_cols).alias("a")]
    if geometry:
        entry.append(F.col(geometry).alias("g"))
    grouped = idx.groupBy(F.col("_page").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(*entry))).alias("fs")
    )

    def encode(batches):
        for batch in batches:
            for p, page in enumerate(batch.column("page").to_pylist()):
                # Column-wise conversion: primitive child arrays, not per-feature dicts; a page's at a time.
                items = batch.column("fs").slice(p, 1).flatten()
                a = items.field("a")
                offset = page * chunk_size
                body = encode_page(
                    [a.field(i).to_pylist() for i in range(len(columns))],
                    items.field("g").to_pylist() if geometry else None,
                    columns,
                    offset + chunk_size < total,
                    q,
                    wkid,
                    default_type,
                )
                row = {"layer": layer, "page": page, "offset": offset, "chunk_size": chunk_size,
                       "format": "pbf", "body": body, "status": "ok",
                       "expected_rows": min(chunk_size, total - offset)}
                yield pa.RecordBatch.from_pylist([row], schema=PAGE_ARROW)

    return grouped.mapInArrow(encode, PAGE_DDL)


# --- Landing ------------------------------------------------------------------


def land_layer(
    features: DataFrame,
    root: str,
    chunk_size: int,
    key: str = "OBJECTID",
    layer: str = "layer",
    fmt: str = "json",
    geometry: str | None = None,
    quantize: dict | None = None,
) -> int:
    """Pack ``features`` into offset pages and land them under ``root``.

    quantize: the transform of binary pages' coordinates. Returns the row count. ``root`` must be shared by all executors.
    """
    if fmt == "json":
        pages = pack_json_pages(features, chunk_size, key=key, layer=layer, geometry=geometry)
    else:
        pages = pack_pbf_pages(features, chunk_size, key=key, layer=layer, geometry=geometry, quantize=quantize)
    total = feature_source.land_counted(pages, root)[1]
    info = {
        "name": layer,
        "standardMaxRecordCount": chunk_size,
        "maxRecordCountFactor": 1.0,
        "maxRecordCount": chunk_size,
        "fields": [{"name": f.name, "type": field_type(f.dataType)} for f in features.schema if f.name != geometry],
    }
    feature_source.write_layer_docs(root, total, info)
    return total


# --- Faults -------------------------------------------------------------------


def broken_pages(pages: DataFrame) -> DataFrame:
    """The pages with faults by their number modulo 7: 1 an error body, 2 not there, 3 an overflow, 4 too
    short, 5 cut off, 6 (JSON) with its first feature twice; 0 as it was."""
    text, kind = F.make_valid_utf8(F.col("body").cast("string")), F.col("page") % 7
    first = F.get_json_object(text, "$.features[0]")
    utf8 = lambda c: F.encode(c, "UTF-8")
    as_json = F.col("format") == "json"
    flagged = field_bytes(W.FC_QUERY_RESULT, field_bytes(W.QR_FEATURE_RESULT, field_varint(W.FR_EXCEEDED, 1)))
    body = (
        F.when(kind == 1, utf8(F.lit('  {"error": {"code": 400, "message": "bad request"}}')))
        .when(kind == 2, F.lit(None).cast("binary"))
        .when(kind == 3, F.when(as_json, utf8(F.lit('{"features": [], "exceededTransferLimit": true}'))).otherwise(F.lit(flagged)))
        .when(kind == 4, F.when(as_json, utf8(F.concat(F.lit('{"features": ['), first, F.lit("]}")))).otherwise(F.lit(b"")))
        .when(kind == 5, F.substring("body", F.lit(1), F.octet_length("body") - 10))
        .when((kind == 6) & as_json, utf8(F.concat(F.lit('{"features":['), first, F.lit(","), F.substring(text, F.lit(14), F.length(text)))))
        .otherwise(F.col("body"))
    )
    return pages.withColumn("body", body).withColumn("status", F.when(F.col("body").isNull(), "missing").otherwise("ok"))
