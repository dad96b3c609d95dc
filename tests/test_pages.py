import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schemas import GEOMETRY
from tessera.sources import feature_source
from tessera.sources.fixture_pages import broken_pages, land_layer, pack_json_pages, pack_pbf_pages
from tessera.sources.layer import attribute_names, decode_pages, read_layer, read_pages
from tessera.sources.pages import (
    audit_pages,
    decode_json_pages,
    layer_label,
    looks_like_json,
    page_stats,
    page_stats_json,
    plan_pages,
    route,
)

ATTRS = T.StructType([T.StructField("A", T.LongType()), T.StructField("OBJECTID", T.LongType())])


def _pages(spark, bodies):
    rows = [("L", i, i * 2, 2, "json", b, "ok") for i, b in enumerate(bodies)]
    return spark.createDataFrame(
        rows,
        "layer string, page bigint, offset bigint, chunk_size bigint, format string, "
        "body binary, status string",
    )


@pytest.mark.parametrize(
    "body, expected",
    [
        (b'{"error": {"code": 400}}', True),
        (b"[1, 2, 3]", True),
        (b'  \n {"a": 1}', True),
        (b" " * 5000 + b'{"error": {}}', True),
        (b"\x0a\x03foo", False),
        (b"", False),
        (None, False),
    ],
)
def test_format_sniff(spark, body, expected):
    df = spark.createDataFrame([(body,)], "body binary")
    assert df.select(looks_like_json(F.col("body")).alias("j")).collect()[0].j is expected


def test_layer_label(spark):
    df = spark.createDataFrame(
        [(".../rest/services/HEAT_INDEX/FeatureServer/0/query",), ("https://x/query",)],
        "url string",
    )
    got = [r.l for r in df.select(layer_label(F.col("url")).alias("l")).collect()]
    assert got == ["HEAT_INDEX", "ArcGIS"]


def test_json_page_cases(spark):
    bodies = [
        json.dumps({"features": [{"attributes": {"A": 1}}]}).encode(),  # normal
        json.dumps({"features": [{"attributes": {"A": 2}}], "exceededTransferLimit": True}).encode(),
        json.dumps({"features": [], "exceededTransferLimit": True}).encode(),  # overflow
        json.dumps({"error": {"code": 400, "message": "bad"}}).encode(),  # error body
        json.dumps({"features": [None, {"x": 1}, {"attributes": {"A": 3}}]}).encode(),
    ]
    pages = _pages(spark, bodies)
    feats = sorted(r.A for r in decode_json_pages(pages, ATTRS).collect())
    assert feats == [1, 2, 3]  # NULL features and features without attributes are skipped
    stats = page_stats_json(pages)
    plan = plan_pages(spark, 12, 2)  # 6 pages planned; page 5 never arrives
    got = {r.page: r.status for r in audit_pages(plan, stats).collect()}
    assert got == {0: "short", 1: "short", 2: "overflow", 3: "error", 4: "extra", 5: "missing"}


def test_route_rejects_unknown_format(spark):
    with pytest.raises(ValueError, match="response format"):
        route(_pages(spark, [b"{}"]), "xml")


def test_paging_five_rows_pages_of_two(spark, scratch):
    df = spark.createDataFrame([(i, i * 10) for i in range(5)], "OBJECTID long, A long")
    total = land_layer(df, scratch, 2, key="OBJECTID", layer="T")
    assert total == 5
    pages = read_pages(spark, path=scratch, format="json")
    assert pages.rdd.getNumPartitions() == 3
    out = read_layer(spark, ATTRS, path=scratch)
    assert sorted(r.OBJECTID for r in out.collect()) == [0, 1, 2, 3, 4]
    flags = {r.page: json.loads(bytes(r.body))["exceededTransferLimit"] for r in pages.collect()}
    assert flags == {0: True, 1: True, 2: False}
    assert sorted(out.columns) == ["A", "OBJECTID"]
    proj = read_layer(spark, ATTRS, path=scratch, fields="OBJECTID")
    assert proj.columns == ["OBJECTID"]


def test_missing_page_is_reported(spark, scratch):
    df = spark.createDataFrame([(i, i) for i in range(5)], "OBJECTID long, A long")
    land_layer(df, scratch, 2, key="OBJECTID")
    fs, base = feature_source.open_fs(scratch)
    fs.delete_file(f"{base}/pages/2.json")
    pages = read_pages(spark, path=scratch, format="json")
    status = {r.page: r.status for r in pages.collect()}
    assert status == {0: "ok", 1: "missing", 2: "ok"}
    audit = audit_pages(
        plan_pages(spark, 5, 2), page_stats_json(pages)
    )
    assert {r.page: r.status for r in audit.collect()} == {0: "full", 1: "missing", 2: "ok"}


def test_empty_layer_has_schema_and_no_partitions(spark, scratch):
    feature_source.write_layer_docs(scratch, 0, {"standardMaxRecordCount": 2})
    out = read_layer(spark, ATTRS, path=scratch)
    assert out.count() == 0
    assert out.columns == ["A", "OBJECTID"]


def test_invalid_format_fails_before_any_read(spark):
    with pytest.raises(Exception, match="response format"):
        read_layer(spark, ATTRS, path="/nonexistent/never/read", response_format="xml")
    with pytest.raises(Exception, match="response format"):
        read_pages(spark, path="/nonexistent/never/read", format="xml").schema


def test_page_size_from_metadata_defaults(spark, scratch):
    df = spark.createDataFrame([(i, i) for i in range(7)], "OBJECTID long, A long")
    land_layer(df, scratch, 3, key="OBJECTID")
    # metadata without the fields -> 2000 x 1.0, but pages were landed by 3: only page 0 exists
    feature_source.write_layer_docs(scratch, 7, {})
    pages = read_pages(spark, path=scratch, format="json")
    r = pages.collect()
    assert len(r) == 1 and r[0].chunk_size == 2000 and r[0].expected_rows == 7
    with pytest.raises(Exception, match="page 0: short"):  # never the rows of one page for the whole layer
        read_layer(spark, ATTRS, path=scratch).collect()
    feature_source.write_layer_docs(scratch, 7, {"error": {"code": 500}})
    with pytest.raises(Exception, match="metadata is an error"):
        read_pages(spark, path=scratch, format="json").collect()


def test_http_transport_request_parameters(monkeypatch):
    from tessera.sources.feature_source import _options, make_transport

    t = make_transport(
        _options({"url": "https://gis.example.org/x/FeatureServer/0/query", "where": "A=1",
                  "fields": "A,B", "returnGeometry": "true", "order_by": "OBJECTID", "format": "pbf"})
    )
    seen = []
    monkeypatch.setattr(t, "_get", lambda url, params: seen.append((url, params)) or b"{}")
    t.page(2000, 1000, "pbf")
    url, params = seen[0]
    assert url.endswith("/query")
    assert params["where"] == "A=1" and params["outFields"] == "A,B" and params["f"] == "pbf"
    assert params["returnGeometry"] == "true" and params["orderByFields"] == "OBJECTID"
    assert (params["resultOffset"], params["resultRecordCount"]) == (2000, 1000)
    monkeypatch.setattr(t, "_get", lambda url, params: b'{"error": {"code": 400}}')
    with pytest.raises(ValueError, match="no count"):
        t.count("1=1")


def test_page_filters_prune_the_pages_fetched(spark, scratch):
    df = spark.createDataFrame([(i, i) for i in range(11)], "OBJECTID long, A long")
    land_layer(df, scratch, 2, key="OBJECTID")
    assert spark.conf.get("spark.sql.python.filterPushdown.enabled") == "true"
    all_pages = read_pages(spark, path=scratch)
    assert all_pages.rdd.getNumPartitions() == 6
    tail = read_pages(spark, path=scratch).where("page >= 4")
    assert tail.rdd.getNumPartitions() == 2
    assert sorted(r.page for r in tail.collect()) == [4, 5]
    picked = read_pages(spark, path=scratch).where("page in (0, 5, 9) and page < 5")
    assert picked.rdd.getNumPartitions() == 1
    assert [r.page for r in picked.collect()] == [0]
    none = read_pages(spark, path=scratch).where("page > 7")
    assert none.collect() == []
    # without pruning every page is planned; the rows are the same
    unpruned = read_pages(spark, path=scratch, prune_pages=False).where("page >= 4")
    assert unpruned.rdd.getNumPartitions() == 6
    assert sorted(r.page for r in unpruned.collect()) == [4, 5]


BODIES = {
    "error": b'{"error": {"code": 400, "message": "no"}}',
    "overflow": b'{"features": [], "exceededTransferLimit": true}',
    "missing": None,
    "short": b'{"features": [{"attributes": {"A": 1, "OBJECTID": 9}}]}',
    "extra": b'{"features": [{"attributes": {"A": 1}}, {"attributes": {"A": 2}}, {"attributes": {"A": 3}}]}',
    "corrupt": b'{"features": [{"attributes": {"A": 1, "OBJ',
}


@pytest.mark.parametrize("fmt", ["json", "pbf"])
@pytest.mark.parametrize("kind", BODIES)
def test_a_page_at_fault_fails_the_read(spark, scratch, kind, fmt):
    df = spark.createDataFrame([(i, i) for i in range(6)], "OBJECTID long, A long")
    land_layer(df, scratch, 2, key="OBJECTID", fmt=fmt)
    assert read_layer(spark, ATTRS, path=scratch, response_format=fmt).count() == 6
    fs, base = feature_source.open_fs(scratch)
    fs.delete_file(f"{base}/pages/2.{fmt}")
    if BODIES[kind] is not None:
        with fs.open_output_stream(f"{base}/pages/2.{fmt}") as f:
            f.write(BODIES[kind])
    with pytest.raises(Exception, match=f"page 1: {kind}"):
        read_layer(spark, ATTRS, path=scratch, response_format=fmt).count()
    both = read_layer(spark, ATTRS, path=scratch, response_format=fmt, mode="split")
    assert {r.page: r.status for r in both.audit.collect()} == {0: "full", 1: kind, 2: "ok"}
    assert both.rows.count() == 4 + {"short": 1, "extra": 3}.get(kind, 0)


def test_a_broken_binary_page_fails_the_read(spark, scratch):
    df = spark.createDataFrame([(i, i) for i in range(6)], "OBJECTID long, A long")
    land_layer(df, scratch, 2, key="OBJECTID", fmt="pbf")
    fs, base = feature_source.open_fs(scratch)
    with fs.open_input_stream(f"{base}/pages/2.pbf") as f:
        body = f.read()
    with fs.open_output_stream(f"{base}/pages/2.pbf") as f:
        f.write(body[:-3])
    with pytest.raises(Exception, match="page 1: field"):
        read_layer(spark, ATTRS, path=scratch, response_format="pbf").count()


def test_audits_of_both_encodings(spark):
    df = spark.createDataFrame([(i, i) for i in range(16)], "OBJECTID long, A long")
    want = {0: "full", 1: "error", 2: "missing", 3: "overflow", 4: "short", 5: "corrupt", 6: "extra", 7: "ok"}
    pages = broken_pages(pack_json_pages(df, 2))
    got = {r.page: r.status for r in audit_pages(plan_pages(spark, 16, 2), page_stats(pages)).collect()}
    assert got == want
    pages = broken_pages(pack_pbf_pages(df, 2))
    got = {r.page: r.status for r in audit_pages(plan_pages(spark, 16, 2), page_stats(pages, "pbf")).collect()}
    assert got == want | {6: "full"}


@pytest.mark.parametrize(
    "value, dtype, expected",
    [("5.0", "long", 5), ('"7"', "long", 7), ("1e3", "int", 1000), ("5.5", "long", None), ('"abc"', "long", None),
     ("18446744073709551615", "long", None), ("18446744073709551615", "decimal(20,0)", 18446744073709551615),
     ("2.5", "double", 2.5), ('"x"', "double", None), ("true", "boolean", True), ("12", "string", "12")],
)
def test_values_are_read_loosely_and_cast_strictly(spark, value, dtype, expected):
    schema = T._parse_datatype_string(f"A {dtype}")
    pages = _pages(spark, [b'{"features": [{"attributes": {"A": %s}}, {"attributes": {"A": null}}]}' % value.encode()])
    rows = decode_json_pages(pages, schema)
    if expected is None:
        with pytest.raises(Exception, match="attribute A: not a"):
            rows.collect()
    else:
        assert {r.A for r in rows.collect()} == {expected, None}


def test_fields_and_where_on_a_landed_layer(spark, scratch):
    df = spark.createDataFrame([(i, i * 10) for i in range(7)], "OBJECTID long, A long")
    land_layer(df, scratch, 3, key="OBJECTID")
    out = read_layer(spark, ATTRS, path=scratch, where="A > 30", fields="OBJECTID")
    assert out.columns == ["OBJECTID"] and sorted(r.OBJECTID for r in out.collect()) == [4, 5, 6]
    plan = read_layer(spark, ATTRS, path=scratch, fields="OBJECTID")._jdf.queryExecution().executedPlan().toString()
    assert "StructField(A," not in plan  # A isn't decoded


def test_names_come_from_the_pages(spark):
    df = spark.createDataFrame([(1, 2)], "OBJECTID long, EXTRA long")
    for fmt, pack in (("json", pack_json_pages), ("pbf", pack_pbf_pages)):
        assert {r.name for r in attribute_names(pack(df, 2), fmt).collect()} == {"OBJECTID", "EXTRA"}


def test_partitions_follow_the_page_count():
    from tessera.sources.feature_source import PrunedPagesReader

    def runs(n, most=None, only=None):
        r = PrunedPagesReader.__new__(PrunedPagesReader)
        r.o, r.n_pages, r.first, r.last, r.only = {"max_partitions": most}, n, 0, n, only
        return [(p.first, p.last) for p in r.partitions()]

    assert runs(3) == [(0, 1), (1, 2), (2, 3)]
    assert len(runs(80_000)) == 10_000
    assert runs(10, most=4) == [(0, 3), (3, 6), (6, 9), (9, 10)]
    assert runs(10, most=1, only=[1, 2, 7]) == [(1, 3), (7, 8)]
    assert len(runs(1000, only=list(range(100, 900)))) == 100
    assert runs(0) == [(0, 0)]


def test_a_broken_connection_is_tried_again():
    import http.client

    from tessera.sources.feature_source import patiently

    waits, calls = [], iter([http.client.IncompleteRead(b""), OSError("reset"), b"page"])

    def read():
        got = next(calls)
        if isinstance(got, Exception):
            raise got
        return got

    assert patiently(read, 4, waits.append) == b"page" and waits == [1.0, 3.0]
    with pytest.raises(OSError):
        patiently(lambda: (_ for _ in ()).throw(OSError("down")), 2, waits.append)


def test_layer_types_become_a_schema():
    from tessera.schemas import field_type, schema_from_fields

    schema = T._parse_datatype_string("A long, B double, C string, D int, E date")
    fields = [{"name": f.name, "type": field_type(f.dataType)} for f in schema]
    assert schema_from_fields(fields) == schema


def test_key_chunks_are_read_a_partition_each(monkeypatch):
    """Over a transport that answers filters like a server: every chunk is counted and paged by its own task."""
    from tessera.sources import feature_source as fs

    rows = {"K IN (1,2)": [1, 1, 2, 2, 2], "K=9": [], "K=5": [5]}

    class Server(fs.Transport):
        def __init__(self, where):
            self.where = where

        def layer_info(self):
            return {"standardMaxRecordCount": 2}

        def count(self, where):
            return len(rows[where])

        def page(self, offset, chunk_size, fmt):
            return json.dumps({"features": [{"attributes": {"K": k}} for k in rows[self.where][offset : offset + chunk_size]]}).encode()

    monkeypatch.setattr(fs, "make_transport", lambda o, where=None: Server(where))
    reader = fs.FeaturePages({"url": "https://gis.example.org/x/query", "predicates": json.dumps(list(rows))}).reader(None)
    parts = reader.partitions()
    assert [p.predicate for p in parts] == list(rows)
    got = [[r for batch in reader.read(p) for r in batch.to_pylist()] for p in parts]
    assert [[len(json.loads(r["body"])["features"]) for r in g] for g in got] == [[2, 2, 1], [], [1]]
    assert [r["expected_rows"] for r in got[0]] == [2, 2, 1]
    assert len({r["page"] for g in got for r in g}) == 4
    with pytest.raises(ValueError, match="landed layer"):
        fs.FeaturePages({"path": "/x", "predicates": "[]"}).reader(None)


@pytest.mark.parametrize("fmt", ["json", "pbf"])
@pytest.mark.parametrize("geometry", [False, True])
def test_split_mode_opens_each_page_once(spark, scratch, fmt, geometry):
    """Rows and audit come of one fetch: pages that change afterwards don't matter, and the audit is that of the page table."""
    shape = F.expr("named_struct('type', 'point', 'x', OBJECTID + 0.5D, 'y', 2D, 'parts', null, 'wkid', 2056)").cast(GEOMETRY)
    df = spark.range(32).select(F.col("id").alias("OBJECTID"), F.col("id").alias("A"), shape.alias("geometry"))
    pack = pack_json_pages if fmt == "json" else pack_pbf_pages
    packed = pack(df, 2, geometry="geometry")
    pages = broken_pages(packed)
    feature_source.land_pages(pages, scratch)
    feature_source.write_layer_docs(scratch, 32, {"standardMaxRecordCount": 2})
    want = audit_pages(plan_pages(spark, 32, 2), page_stats(pages, fmt)).orderBy("page").collect()
    both = read_layer(spark, ATTRS, path=scratch, response_format=fmt, mode="split", with_geometry=geometry)
    fs, base = feature_source.open_fs(scratch)
    for page in range(16):
        with fs.open_output_stream(f"{base}/pages/{page * 2}.{fmt}") as f:
            f.write(b"changed meanwhile")
    assert both.audit.orderBy("page").collect() == want and len({r.status for r in want}) >= 6
    rows = both.rows.collect()
    assert both.rows.columns == ["A", "OBJECTID", *(["geometry"] if geometry else [])]
    whole = [i for i in range(32) if i // 2 % 7 in (0, 6)]
    more = [i for i in range(32) if i // 2 % 7 == 4 and i % 2 == 0] + [i for i in range(32) if i // 2 % 7 == 6 and i % 2 == 0]
    assert sorted(r.OBJECTID for r in rows) == sorted(whole + (more if fmt == "json" else []))
    if geometry:
        plain = {r.OBJECTID: r.geometry for r in decode_pages(packed, ATTRS, True, fmt).collect()}
        assert all(r.geometry == plain[r.OBJECTID] and r.geometry is not None for r in rows)


def test_json_pages_among_binary_ones(spark, scratch):
    """They are read in the same pass over the pages, with the same rows, geometries and names."""
    shape = F.expr("named_struct('type', 'polygon', 'x', null, 'y', null, 'parts', array(array(named_struct('x', double(OBJECTID), 'y', 1D), named_struct('x', 4D, 'y', 5D))), 'wkid', 2056)")
    shape = F.when(F.col("OBJECTID") % 3 != 0, shape).cast(GEOMETRY)
    df = spark.range(20).select(F.col("id").alias("OBJECTID"), F.expr("if(id % 5 = 0, null, id * 7)").alias("A"), shape.alias("geometry"))
    binary, text = pack_pbf_pages(df, 2, geometry="geometry"), pack_json_pages(df, 2, geometry="geometry")
    mixed = binary.where("page % 2 = 0").unionByName(text.where("page % 2 = 1").withColumn("format", F.lit("pbf")))
    want = sorted(map(str, decode_pages(binary, ATTRS, True, "pbf").collect()))
    assert sorted(map(str, decode_pages(mixed, ATTRS, True, "pbf").collect())) == want
    names = decode_pages(mixed, ATTRS, requested="pbf", names="n").select(F.explode("n")).distinct().collect()
    assert {r[0] for r in names} == {"OBJECTID", "A"}
    feature_source.land_pages(mixed, scratch)
    feature_source.write_layer_docs(scratch, 20, {"standardMaxRecordCount": 2})
    rows = read_layer(spark, ATTRS, path=scratch, response_format="pbf", with_geometry=True)
    assert sorted(map(str, rows.collect())) == want
    assert rows._jdf.queryExecution().executedPlan().toString().count("BatchScan") == 1
    assert sorted(map(str, read_layer(spark, ATTRS, path=scratch, response_format="pbf", with_geometry=True, mode="split").rows.collect())) == want


@pytest.mark.parametrize("body, status", [(b' {"features": [', "corrupt"), (b'[1]', "not a page"), (b'{"error": {"code": 500}}', "error"), (b'\n{"features": [null, {"x": 1}]}', "ok")])
def test_a_json_body_where_binary_was_asked_for(spark, body, status):
    pages = spark.createDataFrame([("L", 0, 0, 2, "pbf", bytearray(body), "ok", 2)], feature_source.PAGE_DDL)
    if status == "ok":
        assert decode_pages(pages, ATTRS, requested="pbf", strict=True).collect() == []
    else:
        with pytest.raises(Exception, match=f"page 0: {status}"):
            decode_pages(pages, ATTRS, requested="pbf", strict=True).collect()
    (told,) = decode_pages(pages, ATTRS, requested="pbf", audited=True).collect()
    assert not told._feature and (told._audit.corrupt, told._audit.error_code) == (status in ("corrupt", "not a page"), 500 if status == "error" else None)


def test_split_mode_reads_around_broken_binary_pages(spark, scratch):
    """Cut anywhere, a binary page gives no rows and is listed; the rows of the others are all there."""
    df = spark.createDataFrame([(i, f"n{i}", i * 0.5) for i in range(40)], "OBJECTID long, A string, B double")
    attributes = T.StructType([T.StructField("OBJECTID", T.LongType()), T.StructField("A", T.StringType()), T.StructField("B", T.DoubleType())])
    pages, broken = [], []
    for r in pack_pbf_pages(df, 4).collect():
        body = bytes(r.body)
        if r.page % 2:
            cut = 1 + (r.page * 7) % (len(body) - 1)
            body = body[:cut] if r.page < 8 else body[:-9] + b"\xff" * 9
            broken.append(r.page)
        pages.append((r.layer, r.page, r.offset, r.chunk_size, r.format, body, r.status, r.expected_rows))
    feature_source.land_pages(spark.createDataFrame(pages, feature_source.PAGE_DDL), scratch)
    feature_source.write_layer_docs(scratch, 40, {"standardMaxRecordCount": 4})
    both = read_layer(spark, attributes, path=scratch, response_format="pbf", mode="split")
    assert sorted(r.OBJECTID for r in both.rows.collect()) == [i for i in range(40) if i // 4 not in broken]
    status = {r.page: r.status for r in both.audit.collect()}
    assert len(status) == 10 and all((status[p] == "corrupt") == (p in broken) for p in status)
    with pytest.raises(Exception, match="page [1357]: "):
        read_layer(spark, attributes, path=scratch, response_format="pbf").collect()


@pytest.mark.parametrize("fmt", ["json", "pbf"])
def test_a_task_packs_a_bounded_number_of_rows(spark, monkeypatch, fmt):
    """Tasks follow the rows, whatever the session would join small partitions to; the pages are the same."""
    from tessera.sources import fixture_pages

    pack = pack_json_pages if fmt == "json" else pack_pbf_pages
    df = spark.range(400).select(F.col("id").alias("OBJECTID"), (F.col("id") * 3).alias("A"))
    want = sorted((r.page, bytes(r.body)) for r in pack(df, 10).collect())
    monkeypatch.setattr(fixture_pages, "ROWS_EACH", 20)
    pages = pack(df, 10)
    assert sorted((r.page, bytes(r.body)) for r in pages.collect()) == want and len(want) == 40
    per_task = pages.groupBy(F.spark_partition_id().alias("t")).agg(F.count("page").alias("n")).collect()
    assert len(per_task) > 10 and max(r.n for r in per_task) <= 8


def test_landing_counts_rows_in_its_one_pass(spark, scratch):
    passes = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            passes.add(b.num_rows)
            yield b

    df = spark.range(23).select(F.col("id").alias("OBJECTID"))
    pages = pack_json_pages(df, 5).mapInArrow(seen, feature_source.PAGE_DDL)
    assert feature_source.land_counted(pages, scratch) == (5, 23) and passes.value == 5
    assert land_layer(df, scratch + "-2", 5) == 23


def test_a_partition_reads_the_pages_of_so_many_rows():
    assert feature_source.pages_each(90_000, 100, None) == 160
    assert feature_source.pages_each(9_000, 1_000, None) == 16
    assert feature_source.pages_each(9_000, 50_000, None) == 1
    assert feature_source.pages_each(64, 100, None) == 1 and feature_source.pages_each(10, 100, 4) == 3


def test_binary_and_json_bodies_are_audited_in_one_pass(spark):
    """What makes the pages runs once a page, whichever way their bodies are encoded."""
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.range(14).select(F.col("id").alias("OBJECTID"))
    bodies = {7: b'{"features": [{"attributes": {"OBJECTID": 1}}, null]}', 8: b'{"error": {"code": {"a": 1}}}', 9: b' {"error": "no"}', 10: None, 11: b"[1]"}
    odd = spark.createDataFrame([("T", p, p * 2, 2, "pbf", b, "ok", 2) for p, b in bodies.items()], feature_source.PAGE_DDL)
    pages = pack_pbf_pages(df, 2).unionByName(odd).coalesce(2).mapInArrow(seen, feature_source.PAGE_DDL)
    got = {r.page: (r.actual_rows, r.error_code, r.corrupt) for r in page_stats(pages, "pbf").collect()}
    assert made.value == 12
    assert {p: got[p] for p in range(7)} == {p: (2, None, False) for p in range(7)}
    assert {p: got[p] for p in bodies} == {7: (2, None, False), 8: (0, None, True), 9: (0, 0, False), 10: (None, None, None), 11: (0, None, True)}
