"""Binary pages built by hand (wire helpers), decoded by the Spark plan."""

import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from tessera.functions.geometry import zigzag
from tessera.sources import fixture_pages as E
from tessera.sources import page_codes as W
from tessera.sources.binary import BROKEN, Cursor, Page, decode_pbf_pages, packed_numbers

ATTRS = T.StructType([T.StructField("ID_DOSSIER", T.StringType())])


def _wrap(feature_result: bytes) -> bytes:
    return E.field_bytes(W.FC_QUERY_RESULT, E.field_bytes(W.QR_FEATURE_RESULT, feature_result))


def _point_page() -> bytes:
    value = E.field_bytes(W.VALUE_STRING, b"PORTE") + E.field_varint(W.VALUE_INDEX, 0)
    geom = E.field_packed(W.GEOM_COORDS, [20, 40])  # zigzag(10), zigzag(20)
    feature = E.field_bytes(W.FEAT_ATTRIBUTES, value) + E.field_bytes(W.FEAT_GEOMETRY, geom)
    scale = E.field_double(W.XY_X, 1.0) + E.field_double(W.XY_Y, 1.0)
    trans = E.field_double(W.XY_X, 0.0) + E.field_double(W.XY_Y, 0.0)
    tf = E.field_varint(W.TF_ORIGIN, 1) + E.field_bytes(W.TF_SCALE, scale) + E.field_bytes(W.TF_TRANSLATE, trans)
    fr = (
        E.field_varint(W.FR_GEOMETRY_TYPE, 0)
        + E.field_bytes(W.FR_SPATIAL_REFERENCE, E.field_varint(W.SR_WKID, 2056))
        + E.field_bytes(W.FR_TRANSFORM, tf)
        + E.field_bytes(W.FR_FIELDS, E.field_bytes(W.FIELD_NAME, b"ID_DOSSIER"))
        + E.field_bytes(W.FR_FEATURES, feature)
    )
    return _wrap(fr)


def _polygon_page() -> bytes:
    deltas = [1, 1, 1, 1, 3, 3, 1, 1]
    geom = (
        E.field_varint(W.GEOM_TYPE, 3)
        + E.field_packed(W.GEOM_LENGTHS, [2, 2])
        + E.field_packed(W.GEOM_COORDS, [d * 2 for d in deltas])
    )
    return _wrap(E.field_bytes(W.FR_FEATURES, E.field_bytes(W.FEAT_GEOMETRY, geom)))


def _pages(spark, bodies):
    rows = [("L", i, i, 1, "pbf", b, "ok") for i, b in enumerate(bodies)]
    return spark.createDataFrame(
        rows,
        "layer string, page bigint, offset bigint, chunk_size bigint, format string, "
        "body binary, status string",
    )


def test_point_with_spatial_reference(spark):
    out = decode_pbf_pages(_pages(spark, [_point_page()]), ATTRS, with_geometry=True).collect()
    assert len(out) == 1
    assert out[0].ID_DOSSIER == "PORTE"
    g = out[0].geometry
    assert (g.type, g.x, g.y, g.wkid) == ("point", 10.0, 20.0, 2056)


def test_two_ring_polygon_upper_left_flips_y(spark):
    out = decode_pbf_pages(_pages(spark, [_polygon_page()]), T.StructType([]), with_geometry=True)
    g = out.collect()[0].geometry
    assert g.type == "polygon" and g.wkid is None
    rings = [[(v.x, v.y) for v in ring] for ring in g.parts]
    assert rings == [[(1.0, -1.0), (2.0, -2.0)], [(5.0, -5.0), (6.0, -6.0)]]


def test_flag_only_empty_and_count_only_pages():
    flag = Page(_wrap(E.field_varint(W.FR_EXCEEDED, 1)))
    assert flag.spots == [] and flag.exceeded is True
    empty = Page(b"")
    assert empty.spots == [] and empty.exceeded is False
    assert Page(None).spots == []
    assert Page(E.field_bytes(W.FC_QUERY_RESULT, E.field_varint(3, 42))).spots == []


def test_attribute_naming_by_position_index_and_overflow():
    names = E.field_bytes(W.FR_FIELDS, E.field_bytes(W.FIELD_NAME, b"A")) + E.field_bytes(
        W.FR_FIELDS, E.field_bytes(W.FIELD_NAME, b"B")
    )
    vals = (
        E.field_bytes(W.FEAT_ATTRIBUTES, E.field_varint(W.VALUE_SINT64, E.zigzag_encode(-5)))
        + E.field_bytes(W.FEAT_ATTRIBUTES, E.field_varint(W.VALUE_INT64, (1 << 64) - 1))
        + E.field_bytes(W.FEAT_ATTRIBUTES, E.field_bytes(W.VALUE_STRING, b"z") + E.field_varint(W.VALUE_INDEX, 7))
        + E.field_bytes(W.FEAT_ATTRIBUTES, E.field_varint(W.VALUE_BOOL, 1) + E.field_varint(W.VALUE_INDEX, 0))
    )
    page = Page(_wrap(names + E.field_bytes(W.FR_FEATURES, vals)))
    assert page.attribute_names() == {"A", "B", "7"}
    values, _ = page.features({"7": 0, "A": 1, "B": 2}, False)
    # of a repeated name the last one counts; int64 is two's complement; past the header the number is the name
    assert values == [["z"], ["true"], ["-1"]]


def test_typed_attributes_through_spark(spark):
    names = b"".join(E.field_bytes(W.FR_FIELDS, E.field_bytes(W.FIELD_NAME, n)) for n in (b"N", b"S", b"D"))
    vals = (
        E.field_bytes(W.FEAT_ATTRIBUTES, E.field_varint(W.VALUE_SINT32, E.zigzag_encode(-7)))
        + E.field_bytes(W.FEAT_ATTRIBUTES, E.field_varint(W.VALUE_NULL, 1))
        + E.field_bytes(W.FEAT_ATTRIBUTES, E.field_double(W.VALUE_DOUBLE, 2.5))
    )
    schema = T.StructType(
        [T.StructField("N", T.LongType()), T.StructField("S", T.StringType()), T.StructField("D", T.DoubleType())]
    )
    out = decode_pbf_pages(_pages(spark, [_wrap(names + E.field_bytes(W.FR_FEATURES, vals))]), schema)
    r = out.collect()[0]
    assert (r.N, r.S, r.D) == (-7, None, 2.5)


def test_zigzag_column(spark):
    df = spark.createDataFrame([(0,), (20,), (1,), (19,)], "n long")
    assert [r.z for r in df.select(zigzag(F.col("n")).alias("z")).collect()] == [0, 10, -1, -10]


def test_z_ordinates_rejected():
    with pytest.raises(ValueError, match="z/m"):
        Page(_wrap(E.field_varint(W.FR_HAS_Z, 1)))


def test_unsigned_numbers_keep_their_size():
    value = E.field_bytes(W.FEAT_ATTRIBUTES, E.field_varint(W.VALUE_UINT64, (1 << 64) - 1))
    page = Page(_wrap(E.field_bytes(W.FR_FIELDS, E.field_bytes(W.FIELD_NAME, b"U")) + E.field_bytes(W.FR_FEATURES, value)))
    assert page.features({"U": 0}, False)[0] == [["18446744073709551615"]]


@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=40))
def test_numbers_round_trip(numbers):
    body = b"".join(E.varint(n) for n in numbers)
    assert [int(x) & ((1 << 64) - 1) for x in packed_numbers(b"ab" + body, 2, 2 + len(body))] == numbers
    fields = b"".join(E.field_varint(i + 1, n) for i, n in enumerate(numbers))
    c, got = Cursor(fields), []
    while c.step():
        got.append((c.field, c.number))
    assert got == [(i + 1, n) for i, n in enumerate(numbers)]


@given(st.binary(max_size=60))
def test_any_bytes_are_a_page_or_an_error(body):
    try:
        assert isinstance(Page(body).spots, list)
    except (ValueError, UnicodeDecodeError):
        pass
    assert packed_numbers(body, 0, len(body)).dtype == np.int64


def _geometry_page(gtype, lengths, deltas, default_type=None) -> bytes:
    geom = b""
    if gtype is not None:
        geom += E.field_varint(W.GEOM_TYPE, gtype)
    if lengths:
        geom += E.field_packed(W.GEOM_LENGTHS, lengths)
    if deltas:
        geom += E.field_packed(W.GEOM_COORDS, [E.zigzag_encode(d) for d in deltas])
    fr = E.field_varint(W.FR_GEOMETRY_TYPE, default_type) if default_type is not None else b""
    return _wrap(fr + E.field_bytes(W.FR_FEATURES, E.field_bytes(W.FEAT_GEOMETRY, geom)))


def _geoms(spark, bodies):
    out = decode_pbf_pages(_pages(spark, bodies), T.StructType([]), with_geometry=True)
    return [r.geometry for r in out.orderBy(F.spark_partition_id()).collect()]


def test_parts_cut_by_lengths_running_sums_across_parts(spark):
    # lengths 1, 2, 2 over 4 vertices: the last part runs past the vertices;
    # a fifth unpaired delta is ignored.
    page = _geometry_page(2, [1, 2, 2], [1, 2, 1, 2, -1, -1, 5, 5, 9])
    (g,) = _geoms(spark, [page])
    assert g.type == "polyline"
    got = [[(v.x, v.y) for v in p] for p in g.parts]
    assert got == [[(1.0, -2.0)], [(2.0, -4.0), (1.0, -3.0)], [(6.0, -8.0)]]


def test_surplus_vertices_dropped_and_empty_part_kept(spark):
    page = _geometry_page(3, [1, 0], [1, 1, 2, 2])
    (g,) = _geoms(spark, [page])
    assert [[(v.x, v.y) for v in p] for p in g.parts] == [[(1.0, -1.0)], []]


def test_multipoint_layer_default_type_and_missing_coordinates(spark):
    multi = _geometry_page(None, [1, 1], [1, 1, 1, 1], default_type=1)
    no_coords = _geometry_page(3, [], [])
    g1, g2 = _geoms(spark, [multi, no_coords])
    assert g1.type == "multipoint"
    assert [[(v.x, v.y) for v in p] for p in g1.parts] == [[(1.0, -1.0), (2.0, -2.0)]]
    assert g2 is None


_SLOTS = {
    W.VALUE_STRING: lambda v: E.field_bytes(W.VALUE_STRING, v[0].encode()),
    W.VALUE_DOUBLE: lambda v: E.field_double(W.VALUE_DOUBLE, v[1]),
    W.VALUE_FLOAT: lambda v: E.tag(W.VALUE_FLOAT, 5) + struct.pack("<f", 0.1),
    **{s: lambda v, s=s: E.field_varint(s, v[2]) for s in (W.VALUE_SINT32, W.VALUE_UINT32, W.VALUE_INT64, W.VALUE_UINT64, W.VALUE_SINT64, W.VALUE_BOOL, W.VALUE_NULL)},
}
_VALUE = st.tuples(st.text(max_size=200), st.floats(), st.integers(0, (1 << 64) - 1))
_MESSAGE = st.tuples(st.lists(st.tuples(st.sampled_from(sorted(_SLOTS)), _VALUE), max_size=3), st.none() | st.integers(0, 5) | st.just(1 << 63))
_FEATURE = st.tuples(st.lists(_MESSAGE, max_size=5), st.none() | st.tuples(st.integers(0, 4), st.lists(st.integers(0, 300), max_size=3), st.lists(st.integers(0, (1 << 64) - 1), max_size=6)))


def _plain_text(slots):
    """The text of (slot, value) pairs: the lowest slot, of it the last."""
    if not slots:
        return None
    slot = min(s for s, _ in slots)
    text, double, number = [v for s, v in slots if s == slot][-1]
    signed = number - (1 << 64) if number >> 63 else number
    zigzagged = -(number + 1 >> 1) if number & 1 else number >> 1
    return {
        W.VALUE_STRING: text, W.VALUE_DOUBLE: repr(double), W.VALUE_FLOAT: repr(float(np.float32(0.1))), W.VALUE_SINT32: str(zigzagged),
        W.VALUE_SINT64: str(zigzagged), W.VALUE_INT64: str(signed), W.VALUE_UINT32: str(number), W.VALUE_UINT64: str(number),
        W.VALUE_BOOL: "true" if number else "false", W.VALUE_NULL: None,
    }[slot]


@given(st.lists(_FEATURE, max_size=5))
def test_columns_against_a_plain_reading(features):
    """Any slots, repeated slots, explicit and too large places, long texts, packed and single numbers: as read one by one."""
    body = b"".join(E.field_bytes(W.FR_FIELDS, E.field_bytes(W.FIELD_NAME, n)) for n in (b"A", b"B", b"A"))
    wanted = {"A": 0, "B": 1, "4": 2, str(1 << 63): 3}
    want, shapes, past = [[] for _ in wanted], [], set()
    for messages, geometry in features:
        inner = b""
        for column in want:
            column.append(None)
        for place, (slots, index) in enumerate(messages):
            value = b"".join(_SLOTS[s](v) for s, v in slots) + (E.field_varint(W.VALUE_INDEX, index) if index is not None else b"")
            inner += E.field_bytes(W.FEAT_ATTRIBUTES, value)
            spot = place if index is None else index
            name = ("A", "B", "A")[spot] if spot < 3 else str(spot)
            past |= {name} if spot >= 3 else set()
            if name in wanted:
                want[wanted[name]][-1] = _plain_text(slots)
        shape = (False, None, [], [])
        if geometry:
            kind, lengths, coords = geometry
            # the first coordinate by itself, the others packed
            single = b"".join(E.field_varint(W.GEOM_COORDS, n) for n in coords[:1])
            inner += E.field_bytes(W.FEAT_GEOMETRY, E.field_varint(W.GEOM_TYPE, kind) + E.field_packed(W.GEOM_LENGTHS, lengths) + single + E.field_packed(W.GEOM_COORDS, coords[1:]))
            shape = (True, kind, lengths, [n - (1 << 64) if n >> 63 else n for n in coords])
        shapes.append(shape)
        body += E.field_bytes(W.FR_FEATURES, inner)
    page = Page(_wrap(body))
    values, got = page.features(wanted, True)
    assert values == want
    assert list(zip(*got)) == shapes
    assert page.past == past and page.attribute_names() == {"A", "B", *past}
    assert page.features({}, False) == ([], [])


@given(st.binary(max_size=40), st.integers(0, 200))
def test_a_damaged_page_is_read_or_refused(noise, at):
    """Bytes overwritten anywhere in a page: rows or one of the errors that mark a page as broken."""
    body = bytearray(_point_page() * 2)
    body[at : at + len(noise)] = noise
    try:
        page = Page(bytes(body))
        values, shapes = page.columns({"ID_DOSSIER": 0}, True)
        assert all(len(c) == len(page.spots) for c in [*values, *shapes])
    except BROKEN:
        pass
