"""The typed layer source: schema from metadata, strict values, filters in requests and pages, key chunks."""

import json
import shutil

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    EqualNullSafe, EqualTo, GreaterThan, In, IsNotNull, IsNull, LessThanOrEqual, Not, StringContains, StringStartsWith,
)

from tessera.operators.keys import key_chunks, normalize_keys
from tessera.schemas import GEOMETRY
from tessera.sources import feature_layer as L
from tessera.sources import feature_source as S
from tessera.sources.fixture_pages import land_layer, pack_json_pages
from tessera.sources.fixtures import raw_readings, readings_with_footprint
from tessera.sources.layer import read_layer, read_pages

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The readings as JSON and as binary pages of 100, with a summary of some attributes."""
    raw = raw_readings(spark, SF)
    roots = {}
    for fmt in ("json", "pbf"):
        roots[fmt] = str(tmp_path_factory.mktemp(fmt))
        land_layer(raw, roots[fmt], 100, fmt=fmt)
        L.summarize_pages(read_pages(spark, path=roots[fmt], format=fmt), roots[fmt], ["OBJECTID", "EGID", "SRE", "COMMUNE"])
    return roots


class Counting(S.DirectoryTransport):
    opened: list = []

    def page(self, offset, chunk_size, fmt):
        Counting.opened.append(offset)
        return super().page(offset, chunk_size, fmt)


@pytest.fixture()
def counting(monkeypatch):
    Counting.opened = []
    monkeypatch.setattr(S, "DirectoryTransport", Counting)
    return Counting


def _rows(reader):
    return [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]


def _reader(filters=(), **options):
    source = L.FeatureLayer({**options, "push_filters": "true"})
    reader = source.reader(source.schema())
    handed_back = list(reader.pushFilters(list(filters)))
    assert handed_back == list(filters)
    return reader


@pytest.mark.parametrize("fmt", ["json", "pbf"])
def test_schema_and_rows_are_the_layers_own(spark, landed, fmt):
    raw = raw_readings(spark, SF)
    df = L.load_layer(spark, path=landed[fmt], format=fmt)
    assert df.dtypes == raw.dtypes
    assert sorted(map(str, df.collect())) == sorted(map(str, raw.collect()))
    some = L.load_layer(spark, path=landed[fmt], format=fmt, fields="EGID,COMMUNE")
    assert some.columns == ["EGID", "COMMUNE"] and some.count() == raw.count()


@pytest.mark.parametrize("fmt", ["json", "pbf"])
@pytest.mark.parametrize(
    "where",
    ["SRE > 100", "COMMUNE = 'BUILDING' AND SRE <= 50", "COMMUNE IS NULL", "EGID IN (10001, 10020, 99)", "NOT (COMMUNE = 'BUILDING')",
     "NBRE_PRENEUR <=> NULL", "ADRESSE LIKE '%0001'", "COMMUNE LIKE 'BUI%' OR SRE = 7", "SRE < -5"],
)
def test_where_gives_the_same_rows(spark, landed, fmt, where):
    raw = raw_readings(spark, SF)
    df = L.load_layer(spark, path=landed[fmt], format=fmt)
    got = df.where(where).select("OBJECTID", "COMMUNE").collect()
    assert sorted(map(str, got)) == sorted(map(str, raw.where(where).select("OBJECTID", "COMMUNE").collect()))


def test_filters_reach_the_source(spark, landed, tmp_path):
    """With its pages gone, a layer still answers what its summary rules out, and nothing else."""
    for name in ("layer.json", "count.json", "summary"):
        (shutil.copytree if name == "summary" else shutil.copy)(f"{landed['json']}/{name}", f"{tmp_path}/{name}")
    df = L.load_layer(spark, path=str(tmp_path))
    assert df.where("SRE > 1000000").count() == 0
    with pytest.raises(Exception, match="missing"):
        df.where("SRE > 100").count()


def test_without_pushdown_spark_filters(spark, landed):
    """A session with filter pushdown off, Spark's default, reads the same rows."""
    key = "spark.sql.python.filterPushdown.enabled"
    kept = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        raw = raw_readings(spark, SF)
        assert L.load_layer(spark, path=landed["json"]).where("SRE > 100").count() == raw.where("SRE > 100").count()
        one = int(raw.first().EGID)
        chunks = spark.createDataFrame([(0, f"EGID={one}")], "chunk long, predicate string")
        assert L.load_keys(spark, chunks, path=landed["json"]).count() == raw.where(F.col("EGID") == one).count()
    finally:
        spark.conf.set(key, kept)


@pytest.mark.parametrize("fmt", ["json", "pbf"])
def test_pages_without_a_match_are_not_opened(spark, landed, counting, fmt):
    read = lambda filters=(), **o: _rows(_reader(filters, path=landed[fmt], format=fmt, **o))
    assert read([GreaterThan(("SRE",), 10**6)]) == [] and counting.opened == []
    total = len(read())
    every = len(counting.opened)
    assert every == -(-total // 100)
    counting.opened.clear()
    ids = [r["OBJECTID"] for r in read(fields="OBJECTID")]
    for filters, n in (([EqualTo(("OBJECTID",), ids[250])], 1), ([In(("OBJECTID",), (ids[5], ids[1250]))], 2), ([LessThanOrEqual(("OBJECTID",), ids[110])], 111)):
        counting.opened.clear()
        assert len(read(filters)) == n
        assert len(counting.opened) == min(n, 2)


def test_other_attributes_are_typed_for_matching_rows_only(landed, monkeypatch):
    sizes = {}
    real = L.typed_values
    monkeypatch.setattr(L, "typed_values", lambda v, t, n: sizes.__setitem__(n, sizes.get(n, 0) + len(v)) or real(v, t, n))
    for fmt in ("json", "pbf"):
        sizes.clear()
        rows = _rows(_reader([EqualTo(("COMMUNE",), "BUILDING")], path=landed[fmt], format=fmt))
        assert sizes["COMMUNE"] > sizes["ADRESSE"] == len(rows) > 0


def test_key_chunks_of_a_landed_layer(spark, landed, counting):
    raw = raw_readings(spark, SF)
    asked = [int(r.EGID) for r in raw.select("EGID").distinct().orderBy("EGID").limit(30).collect()] + [77, 5]
    keys = normalize_keys(spark.createDataFrame([(k,) for k in asked], "egid long"))
    chunks = key_chunks(keys, 7)
    want = sorted(map(str, raw.where(F.col("EGID").isin(asked)).collect()))
    for fmt in ("json", "pbf"):
        df = L.load_keys(spark, chunks, path=landed[fmt], format=fmt)
        assert sorted(map(str, df.collect())) == want
    # two keys that no page has open none; one that few pages have opens these
    reader = _reader(path=landed["json"], predicates=json.dumps(["EGID IN (5,77)"]))
    assert _rows(reader) == [] and counting.opened == []
    one = asked[0]
    holding = {r.page * 100 for r in pack_json_pages(raw, 100).select("page", F.expr(f"decode(body, 'UTF-8') like '%\"EGID\":{float(one)},%'").alias("has")).where("has").collect()}
    rows = _rows(_reader(path=landed["json"], predicates=json.dumps([f"EGID={one}"])))
    assert rows and holding <= set(counting.opened) and len(counting.opened) <= len(holding) + 2
    # many chunks open a page no more often than one
    counting.opened.clear()
    rows = _rows(_reader(path=landed["json"], predicates=json.dumps([r.predicate for r in chunks.collect()])))
    assert sorted(r["OBJECTID"] for r in rows) == sorted(r.OBJECTID for r in raw.where(F.col("EGID").isin(asked)).collect())
    assert len(counting.opened) == len(set(counting.opened)) <= 15
    assert _rows(_reader(path=landed["json"], predicates="[]")) == []
    with pytest.raises(ValueError, match="several fields"):
        _rows(_reader(path=landed["json"], predicates=json.dumps(["EGID=5", "SRE=5"])))
    with pytest.raises(ValueError, match="predicate"):
        _rows(_reader(path=landed["json"], predicates=json.dumps(["EGID > 5"])))


def test_without_summary_all_pages_are_read(spark, tmp_path, counting):
    raw = raw_readings(spark, SF)
    land_layer(raw, str(tmp_path), 500)
    rows = _rows(_reader([GreaterThan(("SRE",), 100)], path=str(tmp_path)))
    assert len(rows) == raw.where("SRE > 100").count() and len(counting.opened) == -(-raw.count() // 500)


def test_a_task_opens_the_summaries_of_its_pages_alone(spark, tmp_path, monkeypatch):
    import pyarrow.dataset as ds

    root = str(tmp_path)
    land_layer(spark.range(40).select(F.col("id").alias("OBJECTID")), root, 2)
    monkeypatch.setattr(L, "SUMMARY_RUN", 4)
    L.summarize_pages(read_pages(spark, path=root), root, ["OBJECTID"])
    opened, real = [], ds.dataset
    monkeypatch.setattr(ds, "dataset", lambda where, **o: opened.append(where) or real(where, **o))
    only = [L.Test("OBJECTID", "in", (9, 12, 39))]
    assert L.pages_to_read(root, only, 3, 7) == [4, 6]
    assert [w.rsplit("/", 1)[1] for w in opened] == ["run=0", "run=1"]
    assert L.pages_to_read(root, only, 0, 20) == [4, 6, 19]
    # pages whose run has no summary are read
    shutil.move(f"{root}/summary/run=2", tmp_path / "aside")
    assert L.pages_to_read(root, only, 0, 20) == [4, 6, 8, 9, 10, 11, 19]


def test_key_lookups_of_a_page_are_bounded_by_its_rows(monkeypatch):
    held = L.key_filter({1, 500_000})
    summary = {"rows": 2, "nulls": 0, "low": 1.0, "high": 500_000.0, "keys": held}
    assert not L.Test("K", "in", tuple(range(10, 14))).possible(summary) and L.Test("K", "in", (2, 500_000)).possible(summary)
    looked = []
    monkeypatch.setattr(L, "_cached_hash", lambda k: looked.append(k) or L._hash(k))
    many = L.Test("K", "in", tuple(range(100_000)))
    assert many.possible(summary) and not looked  # more keys than the filter has bits: the page is opened
    assert many.passing([1, -1, None, 99_999]).tolist() == [True, False, False, True] and many._known is many._known
    assert not many.possible(summary | {"low": 200_000.0})


# --- geometry ----------------------------------------------------------------


@pytest.fixture(scope="module")
def shaped(spark, tmp_path_factory):
    """The readings with footprints (every seventh without) as JSON and as binary pages of 100, with a summary of SRE."""
    rows = readings_with_footprint(spark, SF)
    rows = rows.withColumn("geometry", F.when(F.col("OBJECTID") % 7 != 0, F.col("geometry")))
    roots = {}
    for fmt in ("json", "pbf"):
        roots[fmt] = str(tmp_path_factory.mktemp(f"shaped-{fmt}"))
        land_layer(rows, roots[fmt], 100, fmt=fmt, geometry="geometry", quantize={"sx": 0.001, "sy": 0.001, "tx": 2480000.0, "ty": 1200000.0})
        L.summarize_pages(read_pages(spark, path=roots[fmt], format=fmt), roots[fmt], ["SRE"])
    return roots


@pytest.mark.parametrize("fmt", ["json", "pbf"])
def test_geometry_is_that_of_the_bulk_read(spark, shaped, fmt):
    raw = raw_readings(spark, SF)
    want = read_layer(spark, raw.schema, path=shaped[fmt], with_geometry=True, response_format=fmt)
    df = L.load_layer(spark, path=shaped[fmt], with_geometry=True, format=fmt)
    assert df.dtypes == [*raw.dtypes, ("geometry", GEOMETRY.simpleString())]
    rows = df.collect()
    assert sorted(map(str, rows)) == sorted(map(str, want.collect()))
    assert all((r.geometry is None) == (r.OBJECTID % 7 == 0) for r in rows) and any(r.geometry is None for r in rows)
    some = L.load_layer(spark, path=shaped[fmt], with_geometry=True, format=fmt, fields="OBJECTID").where("OBJECTID < 40").orderBy("OBJECTID")
    assert some.columns == ["OBJECTID", "geometry"]
    assert some.collect() == want.where("OBJECTID < 40").select("OBJECTID", "geometry").orderBy("OBJECTID").collect()


@pytest.mark.parametrize("fmt", ["json", "pbf"])
def test_filters_pass_the_geometry(spark, shaped, tmp_path, fmt):
    """A filter on an attribute goes below the projection that makes the geometry: pages ruled out aren't missed."""
    for name in ("layer.json", "count.json"):
        shutil.copy(f"{shaped[fmt]}/{name}", f"{tmp_path}/{name}")
    shutil.copytree(f"{shaped[fmt]}/summary", f"{tmp_path}/summary")
    df = L.load_layer(spark, path=str(tmp_path), with_geometry=True, format=fmt)
    assert df.where("SRE > 1000000").count() == 0
    with pytest.raises(Exception, match="missing"):
        df.where("SRE > 100").collect()


@pytest.mark.parametrize("fmt", ["json", "pbf"])
def test_key_chunks_and_tests_of_the_geometry(spark, shaped, fmt):
    raw = raw_readings(spark, SF)
    asked = [int(r.EGID) for r in raw.select("EGID").distinct().orderBy("EGID").limit(5).collect()]
    chunks = key_chunks(normalize_keys(spark.createDataFrame([(k,) for k in asked], "egid long")), 2)
    got = L.load_keys(spark, chunks, path=shaped[fmt], with_geometry=True, format=fmt)
    want = read_layer(spark, raw.schema, path=shaped[fmt], with_geometry=True, response_format=fmt).where(F.col("EGID").isin(asked))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    df = L.load_layer(spark, path=shaped[fmt], with_geometry=True, format=fmt)
    assert df.where("geometry is null").count() == raw.where("OBJECTID % 7 = 0").count()
    assert df.where("size(geometry.parts) = 2").count() == raw.where("AGENT_ENERGETIQUE_1 = '1-URGENT' and OBJECTID % 7 <> 0").count()


def test_geometries_of_matching_rows_only(shaped, monkeypatch):
    sizes = []
    for kind in (L.JsonPage, L.BinaryPage):
        real = kind.shapes
        monkeypatch.setattr(kind, "shapes", lambda self, rows, real=real: sizes.append(0 if rows is None else len(rows)) or real(self, rows))
    for fmt in ("json", "pbf"):
        sizes.clear()
        rows = _rows(_reader([EqualTo(("COMMUNE",), "BUILDING")], path=shaped[fmt], format=fmt, returnGeometry="true"))
        assert rows and sum(sizes) == len(rows)
        assert {r["OBJECTID"] for r in rows if r[L.RAW]["text"] is None and not r[L.RAW]["coords"]} == {r["OBJECTID"] for r in rows if r["OBJECTID"] % 7 == 0}


SHAPES = [
    ({"x": 1.5, "y": 2.5, "spatialReference": {"wkid": 2056}}, ("point", 1.5, 2.5, None, 2056)),
    ({"points": [[1, 2], [3, 4]]}, ("multipoint", None, None, [[(1.0, 2.0), (3.0, 4.0)]], None)),
    ({"paths": [[[0, 0], [1, 1]], [[5, 5], [6, 6.5]]], "spatialReference": {"latestWkid": 4326}}, ("polyline", None, None, [[(0.0, 0.0), (1.0, 1.0)], [(5.0, 5.0), (6.0, 6.5)]], 4326)),
    ({"rings": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}, ("polygon", None, None, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]], None)),
    ({"rings": []}, ("polygon", None, None, [], None)),
    ({}, None),
    (None, None),
]


def test_kinds_of_geometry_and_clashing_names(spark, tmp_path):
    """Points, lines, none; attributes named like parts of a binary geometry keep their values; a clash is refused."""
    names = ["A", "wkid", "coords", "origin", "has_geometry"]
    fields = [{"name": n, "type": "esriFieldTypeInteger"} for n in names] + [{"name": "Geometry", "type": "esriFieldTypeString"}]
    features = [{"attributes": {n: i * 10 + k for k, n in enumerate(names)}, "geometry": g} for i, (g, _) in enumerate(SHAPES)]
    features.append({"attributes": {"A": 70}})
    root = _land(tmp_path, features, fields)
    for fmt in ("json", "pbf"):  # a JSON page is told by its looks, whatever was asked for
        if fmt == "pbf":
            shutil.copy(tmp_path / "pages" / "0.json", tmp_path / "pages" / "0.pbf")
        rows = L.load_layer(spark, path=root, with_geometry=True, format=fmt, fields=",".join(names)).orderBy("A").collect()
        assert [tuple(r)[:5] for r in rows] == [*[tuple(i * 10 + k for k in range(5)) for i in range(7)], (70, None, None, None, None)]
        for r, (_, want) in zip(rows, [*SHAPES, (None, None)]):
            g = r.geometry
            assert (None if g is None else (g.type, g.x, g.y, None if g.parts is None else [[tuple(v) for v in p] for p in g.parts], g.wkid)) == want
    with pytest.raises(Exception, match="clash"):
        L.load_layer(spark, path=root, with_geometry=True)


@pytest.mark.parametrize("geometry, message", [({"curveRings": [[[0, 0], {"c": [[1, 1], [2, 2]]}]]}, "curve"), ({"rings": "none"}, "MALFORMED|malformed"), ([1, 2], "MALFORMED|malformed")])
def test_a_geometry_that_is_none_raises(spark, tmp_path, geometry, message):
    root = _land(tmp_path, [{"attributes": {"A": 1}, "geometry": geometry}], FIELDS)
    with pytest.raises(Exception, match=message):
        L.load_layer(spark, path=root, with_geometry=True).collect()
    assert L.load_layer(spark, path=root).count() == 1


def test_geometry_is_asked_of_a_live_layer(live):
    rows = _rows(_reader(url="http://h/services/L/FeatureServer/0/query", returnGeometry="true"))
    assert [r[L.RAW]["text"] for r in rows] == [None] * 3
    assert {p["returnGeometry"] for _, p in live if "resultOffset" in p} == {"true"}


# --- live requests -----------------------------------------------------------

FIELDS = [{"name": "A", "type": "esriFieldTypeInteger"}, {"name": "B", "type": "esriFieldTypeString"}, {"name": "D", "type": "esriFieldTypeDouble"}, {"name": "SHAPE", "type": "esriFieldTypeGeometry"}]


@pytest.fixture()
def live(monkeypatch):
    """A layer behind HTTP whose answers are made up; requests are kept."""
    asked = []

    def get(self, url, params):
        asked.append((url, params))
        if params.get("returnCountOnly"):
            return json.dumps({"count": 3}).encode()
        if "resultOffset" in params:
            rows = [{"attributes": {"A": params["resultOffset"] + i, "B": "x"}} for i in range(min(2, 3 - params["resultOffset"]))]
            return json.dumps({"features": rows}).encode()
        return json.dumps({"fields": FIELDS, "standardMaxRecordCount": 2}).encode()

    monkeypatch.setattr(S.HttpTransport, "_get", get)
    return asked


def test_filters_are_sent_with_the_request(live):
    filters = [
        EqualTo(("B",), "it's"), In(("A",), (1, 2)), Not(GreaterThan(("A",), 7)), IsNotNull(("B",)), Not(IsNull(("A",))),
        LessThanOrEqual(("D",), 2.5), StringStartsWith(("B",), "ab"), EqualNullSafe(("A",), None),
        # these stay with Spark: an unknown attribute, wildcards in text, null in a list, a null-safe test turned round
        EqualTo(("Z",), 1), StringContains(("B",), "50%"), In(("A",), (1, None)), Not(EqualNullSafe(("A",), 1)), EqualTo(("D",), float("nan")),
    ]
    reader = _reader(filters, url="http://h/services/L/FeatureServer/0/query", where="C > 1")
    want = "(C > 1) AND (B = 'it''s') AND (A IN (1,2)) AND (NOT (A > 7)) AND (B IS NOT NULL) AND (A IS NOT NULL) AND (D <= 2.5) AND (B LIKE 'ab%') AND (A IS NULL)"
    rows = _rows(reader)
    assert [r["A"] for r in rows] == [0, 1, 2]
    sent = [p["where"] for _, p in live if "where" in p]
    assert len(sent) == 3 and set(sent) == {want}


def test_key_chunks_and_filters_of_a_live_layer(live):
    reader = _reader([EqualTo(("B",), "x")], url="http://h/services/L/FeatureServer/0/query", predicates=json.dumps(["A IN (0,1)", "A=2"]))
    assert len(reader.partitions()) == 2
    assert len(_rows(reader)) == 6
    sent = {p["where"] for _, p in live if "where" in p}
    assert sent == {"(A IN (0,1)) AND (B = 'x')", "(A=2) AND (B = 'x')"}


# --- strictness --------------------------------------------------------------


def _land(root, features, fields, count=None, **page):
    (root / "pages").mkdir()
    (root / "layer.json").write_text(json.dumps({"fields": fields, "standardMaxRecordCount": 10}))
    (root / "count.json").write_text(json.dumps({"count": len(features) if count is None else count}))
    (root / "pages" / "0.json").write_text(json.dumps({"features": features, **page}))
    return str(root)


@pytest.mark.parametrize("attributes", [{"A": "five"}, {"A": 1.5}, {"A": 1 << 31}, {"A": True}, {"B": 7}, {"D": "x"}, {"D": [1]}, {"A": {"x": 1}}])
def test_a_value_of_another_type_raises(tmp_path, attributes):
    root = _land(tmp_path, [{"attributes": {"A": 1, "B": "b", "D": 1.0}}, {"attributes": attributes}], FIELDS)
    with pytest.raises(ValueError, match="page 0: attribute"):
        _rows(_reader(path=root))


def test_values_that_say_the_type_otherwise(tmp_path):
    root = _land(tmp_path, [{"attributes": {"A": 5.0, "D": 3}}, {"attributes": {"A": "7", "B": "é", "D": "2.5"}}, None, {"x": 1}], FIELDS)
    assert _rows(_reader(path=root)) == [{"A": 5, "B": None, "D": 3.0}, {"A": 7, "B": "é", "D": 2.5}]


@pytest.mark.parametrize(
    "features, count, page, status",
    [([], 1, {}, "short"), ([{"attributes": {}}] * 2, 1, {}, "extra"), ([], 1, {"exceededTransferLimit": True}, "overflow"), ([], 1, {"error": {"code": 400}}, "error")],
)
def test_a_page_at_fault_raises(tmp_path, features, count, page, status):
    root = _land(tmp_path, features, FIELDS, count, **page)
    with pytest.raises(ValueError, match=f"page 0: {status}"):
        _rows(_reader(path=root))
    (tmp_path / "pages" / "0.json").write_text('{"features": [')
    with pytest.raises(ValueError, match="page 0: corrupt"):
        _rows(_reader(path=root))
    (tmp_path / "pages" / "0.json").unlink()
    with pytest.raises(ValueError, match="page 0: missing"):
        _rows(_reader(path=root))


def test_a_cut_binary_page_is_named(shaped, tmp_path):
    """A page cut anywhere raises with its number, and isn't summarized."""
    shutil.copytree(shaped["pbf"], tmp_path / "cut", ignore=shutil.ignore_patterns("summary"))
    first = tmp_path / "cut" / "pages" / "0.pbf"
    body = first.read_bytes()
    for size in range(1, len(body), len(body) // 40):
        first.write_bytes(body[:size])
        with pytest.raises(ValueError, match="page 0: "):
            _rows(_reader(path=str(tmp_path / "cut"), format="pbf", returnGeometry="true"))


def test_layers_that_cannot_be_typed_are_refused(tmp_path):
    root = _land(tmp_path, [], [{"name": "A", "type": "esriFieldTypeBlob"}, {"name": "B", "type": "esriFieldTypeString"}])
    with pytest.raises(ValueError, match="field A"):
        _reader(path=root)
    assert _rows(_reader(path=root, fields="B")) == []
    with pytest.raises(ValueError, match="no field"):
        _reader(path=root, fields="C")
    (tmp_path / "layer.json").write_text("{}")
    with pytest.raises(ValueError, match="declares no fields"):
        _reader(path=root)


def test_spark_raises_for_drift(spark, tmp_path):
    root = _land(tmp_path, [{"attributes": {"A": "five"}}], FIELDS)
    with pytest.raises(Exception, match="not a int"):
        L.load_layer(spark, path=root).collect()


def test_dates_and_small_numbers():
    assert L.typed_values(["2024-02-29", None], T.DateType(), "d").type == pa.date32()
    assert L.typed_values([1, "2"], T.ShortType(), "s").to_pylist() == [1, 2]
    for bad in (["2024-02-30"], [5]):
        with pytest.raises(L.NotOfType):
            L.typed_values(bad, T.DateType(), "d")
    assert L.typed_values([1 << 53, float("nan")], T.DoubleType(), "x").to_pylist()[0] == float(1 << 53)
