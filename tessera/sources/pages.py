"""Tables of pages: routing, JSON decoding and the page audit.

A *page table* has one row per planned page of a layer:
``layer STRING, page BIGINT, offset BIGINT, chunk_size BIGINT, format STRING,
body BINARY, status STRING, expected_rows BIGINT``, as the ``feature_pages``
source returns it; a page that isn't there has a NULL body. Pages are
independent, so decoding is per row with no shuffle; a page holds at most
``chunk_size`` features, which bounds every per-page collection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.strict import typed
from tessera.schemas import DEFAULT_RECORD_FACTOR, DEFAULT_STANDARD_MAX_RECORDS, GEOMETRY

# Layer metadata document (only the fields page planning reads, plus fields[]).
LAYER_META_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("maxRecordCount", T.LongType()),
        T.StructField("standardMaxRecordCount", T.LongType()),
        T.StructField("tileMaxRecordCount", T.LongType()),
        T.StructField("maxRecordCountFactor", T.DoubleType()),
        T.StructField(
            "fields",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("type", T.StringType()),
                        T.StructField("alias", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

_JSON_GEOMETRY = T.StructType(
    [
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("points", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("paths", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))),
        T.StructField("rings", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))),
        T.StructField("curvePaths", T.StringType()),
        T.StructField("curveRings", T.StringType()),
        T.StructField(
            "spatialReference",
            T.StructType(
                [
                    T.StructField("wkid", T.IntegerType()),
                    T.StructField("latestWkid", T.IntegerType()),
                ]
            ),
        ),
    ]
)

_ERROR = T.StructType(
    [
        T.StructField("code", T.IntegerType()),
        T.StructField("message", T.StringType()),
    ]
)


_BROKEN = "_broken"


def json_page_schema(attributes: T.StructType, with_geometry: bool = True, every: bool = False) -> T.StructType:
    """A page with its attributes as text (every: whatever their names); what isn't JSON is kept in ``_broken``."""
    named = T.StructType([T.StructField(a.name, T.StringType()) for a in attributes.fields])
    loose = T.MapType(T.StringType(), T.StringType()) if every else named
    feature = [T.StructField("attributes", loose)]
    if with_geometry:
        feature.append(T.StructField("geometry", _JSON_GEOMETRY))
    return _page_of(T.StructType(feature))


def _page_of(feature: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("features", T.ArrayType(feature)),
            T.StructField("exceededTransferLimit", T.BooleanType()),
            T.StructField("error", _ERROR),
            T.StructField(_BROKEN, T.StringType()),
        ]
    )


def _parsed(body: Column, schema: T.StructType) -> Column:
    # bytes that aren't UTF-8 are replaced, not an error: the body may turn out to be binary
    return F.from_json(F.make_valid_utf8(body.cast("string")), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})


# ---------------------------------------------------------------------------
# Layer metadata and page planning
# ---------------------------------------------------------------------------


def page_size(meta: Column) -> Column:
    """``int(standardMaxRecordCount * maxRecordCountFactor)`` with defaults."""
    std = F.coalesce(meta["standardMaxRecordCount"], F.lit(DEFAULT_STANDARD_MAX_RECORDS))
    factor = F.coalesce(meta["maxRecordCountFactor"], F.lit(DEFAULT_RECORD_FACTOR))
    return (std * factor).cast("bigint")


def parse_layer_meta(docs: DataFrame, column: str = "doc") -> DataFrame:
    """Parse metadata JSON documents and resolve each layer's page size."""
    m = F.from_json(F.col(column), LAYER_META_SCHEMA)
    return docs.withColumn("_m", m).select(
        "*",
        F.col("_m.name").alias("name"),
        F.col("_m.maxRecordCount").alias("max_record_count"),
        F.col("_m.standardMaxRecordCount").alias("standard_max_record_count"),
        F.col("_m.maxRecordCountFactor").alias("max_record_count_factor"),
        page_size(F.col("_m")).alias("chunk_size"),
    ).drop("_m", column)


def plan_pages(spark: SparkSession, total: int, chunk_size: int, partitions: int | None = None):
    """(page, offset, expected_rows) for a layer of ``total`` rows.

    Built with ``spark.range`` so the plan itself is distributed; the only
    driver value is the row count. Zero rows give zero pages.
    """
    if chunk_size < 1:
        raise ValueError("chunk_size must be >= 1")
    n_pages = -(-int(total) // int(chunk_size))
    r = spark.range(0, n_pages, numPartitions=partitions) if partitions else spark.range(0, n_pages)
    off = F.col("id") * F.lit(chunk_size)
    return r.select(
        F.col("id").alias("page"),
        off.alias("offset"),
        F.least(F.lit(chunk_size).cast("bigint"), F.lit(int(total)) - off).alias("expected_rows"),
    )


# ---------------------------------------------------------------------------
# Routing and decoding
# ---------------------------------------------------------------------------


def looks_like_json(body: Column) -> Column:
    """First non-blank byte is ``{`` or ``[`` (bytes read as Latin-1), however many blanks there are."""
    return F.coalesce(F.regexp_like(F.decode(body, "ISO-8859-1"), F.lit(r"^\s*+[\[{]")), F.lit(False))


def layer_label(url: Column) -> Column:
    """Service name from a layer URL (``/services/<name>/``), else ``ArcGIS``."""
    return F.coalesce(
        F.nullif(F.regexp_extract(url, r"/services/([^/]+)/", 1), F.lit("")), F.lit("ArcGIS")
    )


def route(pages: DataFrame, requested: str = "pbf") -> DataFrame:
    """Add ``route``: a body goes to the JSON decoder when JSON was requested or
    when it looks like JSON anyway (errors come back as JSON); else binary."""
    if requested not in ("json", "pbf"):
        raise ValueError(f"invalid response format {requested!r} (expected 'json' or 'pbf')")
    if requested == "json":
        return pages.withColumn("route", F.lit("json"))
    # a page that isn't there has nothing to sniff; the JSON side reports it
    as_json = F.col("body").isNull() | looks_like_json(F.col("body"))
    return pages.withColumn("route", F.when(as_json, "json").otherwise("pbf"))


def _geometry_from_json(g: Column) -> Column:
    def to_vertices(part: Column) -> Column:
        return F.transform(part, lambda v: F.struct(v[0].alias("x"), v[1].alias("y")))

    parts = F.coalesce(g["rings"], g["paths"], F.when(g["points"].isNotNull(), F.array(g["points"])))
    gtype = (
        F.when(g["x"].isNotNull(), "point")
        .when(g["points"].isNotNull(), "multipoint")
        .when(g["paths"].isNotNull(), "polyline")
        .when(g["rings"].isNotNull(), "polygon")
    )
    sr = g["spatialReference"]
    wkid = F.coalesce(F.nullif(sr["wkid"], F.lit(0)), F.nullif(sr["latestWkid"], F.lit(0)))
    shape = F.when(
        g.isNotNull() & gtype.isNotNull(),
        F.struct(
            gtype.alias("type"),
            g["x"].alias("x"),
            g["y"].alias("y"),
            F.transform(parts, to_vertices).alias("parts"),
            wkid.alias("wkid"),
        ),
    ).cast(GEOMETRY)
    curve = g["curvePaths"].isNotNull() | g["curveRings"].isNotNull()
    return F.when(curve, F.raise_error(F.lit("curve geometries are not supported")).cast(GEOMETRY)).otherwise(shape)


def geometry_from_text(text: Column) -> Column:
    """The JSON text of a geometry -> GEOMETRY; null stays null, what isn't a geometry raises."""
    return _geometry_from_json(F.from_json(text, _JSON_GEOMETRY, {"mode": "FAILFAST"}))


def fault(expected, actual, exceeded, error_code=None, corrupt=False, present=True):
    """What is wrong with a page, or None; of plain values (see ``page_status`` for columns)."""
    if not present:
        return "missing"
    if corrupt:
        return "corrupt"
    if error_code is not None:
        return "error"
    if exceeded and not actual:
        return "overflow"
    if expected is not None and actual != expected:
        return "short" if actual < expected else "extra"
    return None


def page_status(expected: Column, actual: Column, exceeded: Column, error_code: Column, corrupt: Column, present: Column) -> Column:
    """``missing`` (planned, no page), ``corrupt`` (not readable), ``error`` (error body), ``overflow``
    (flag set, no features), ``short`` or ``extra`` (fewer or more rows than planned), ``full`` (flag
    set, rows as planned: normal for offset paging), ``ok``."""
    return (
        F.when(~present, "missing")
        .when(corrupt, "corrupt")
        .when(error_code.isNotNull(), "error")
        .when(exceeded & (actual == 0), "overflow")
        .when(actual < expected, "short")
        .when(actual > expected, "extra")
        .when(exceeded, "full")
        .otherwise("ok")
    )


def _expected(pages: DataFrame) -> Column:
    return F.col("expected_rows") if "expected_rows" in pages.columns else F.lit(None).cast("bigint")


def _doc_stats(doc: Column) -> dict[str, Column]:
    return {
        "actual_rows": F.coalesce(F.size(doc["features"]), F.lit(0)).cast("bigint"),
        "exceeded": F.coalesce(doc["exceededTransferLimit"], F.lit(False)),
        "error_code": F.when(doc["error"].isNotNull(), F.coalesce(doc["error"]["code"], F.lit(0))),
        "corrupt": doc.isNull() | doc[_BROKEN].isNotNull(),
    }


#: What an audited read tells of a page, on the first row that comes of it; FEATURE: whether the row is a feature.
AUDIT, FEATURE = "_audit", "_feature"
AUDIT_DDL = "page bigint, offset bigint, expected_rows bigint, actual_rows bigint, exceeded boolean, error_code int, corrupt boolean, present boolean"


def decode_json_pages(
    pages: DataFrame,
    attributes: T.StructType,
    with_geometry: bool = False,
    strict: bool = False,
    names: str | None = None,
    audited: bool = False,
) -> DataFrame:
    """JSON page table -> one row per feature: attribute columns (+ geometry).

    NULL features and features without ``attributes`` are skipped. A value
    that isn't of its declared type raises. strict: so does a page that
    ``page_status`` finds at fault; else its readable features are returned.
    names: a column with the names of the feature's attributes, declared or not.
    audited: columns ``_audit`` and ``_feature`` too; a page without features,
    or without a body, gives a row that isn't a feature.
    """
    schema = json_page_schema(attributes, with_geometry, names is not None)
    place = [F.col(c) for c in ("layer", "page", "offset", "body") if c in pages.columns]
    parsed = pages.select(*place, _expected(pages).alias("_expected"), _parsed(F.col("body"), schema).alias("doc"))
    features = F.col("doc.features")
    if audited:
        present = F.col("body").isNotNull()
        stats = {k: F.when(present, c) for k, c in _doc_stats(F.col("doc")).items()}
        told = {"page": F.col("page"), "offset": F.col("offset"), "expected_rows": F.col("_expected"), **stats, "present": present}
        told = F.struct(*[told[c.split()[0]].alias(c.split()[0]) for c in AUDIT_DDL.split(", ")]).cast(f"struct<{AUDIT_DDL}>")
        f = parsed.select(told.alias("_told"), features.alias("_features")).select("_told", F.posexplode_outer("_features").alias("_at", "f"))
        cols = [typed(F.col(f"f.attributes.`{a.name}`"), a.dataType, a.name).alias(a.name) for a in attributes.fields]
        if with_geometry:
            cols.append(_geometry_from_json(F.col("f.geometry")).alias("geometry"))
        first = F.coalesce(F.col("_at"), F.lit(0)) == 0
        marked = f.where(first | F.col("f.attributes").isNotNull())
        return marked.select(*cols, F.when(first, F.col("_told")).alias(AUDIT), F.col("f.attributes").isNotNull().alias(FEATURE))
    if strict:
        stats = _doc_stats(F.col("doc"))
        status = page_status(F.col("_expected"), present=F.col("body").isNotNull(), **{k.replace("_rows", ""): v for k, v in stats.items()})
        wrong = F.raise_error(F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(": "), status))
        features = F.when(status.isin("ok", "full"), features).otherwise(wrong.cast(parsed.select(features).schema[0].dataType))
    f = parsed.select("layer", "page", F.explode(features).alias("f")).where(
        F.col("f").isNotNull() & F.col("f.attributes").isNotNull()
    )
    if names:
        # a map is searched for each name: its fields are taken once, not again for each use of a value
        texts = [F.try_element_at("f.attributes", F.lit(a.name)) for a in attributes.fields]
        taken = F.struct(*[t.alias(f"a{i}") for i, t in enumerate(texts)])
        f = f.select("f", F.explode(F.array(taken)).alias("_v"))
        values = [F.col(f"_v.a{i}") for i in range(len(texts))]
    else:
        values = [F.col(f"f.attributes.`{a.name}`") for a in attributes.fields]
    cols = [typed(v, a.dataType, a.name).alias(a.name) for v, a in zip(values, attributes.fields)]
    if with_geometry:
        cols.append(_geometry_from_json(F.col("f.geometry")).alias("geometry"))
    if names:
        cols.append(F.map_keys("f.attributes").alias(names))
    return f.select(*cols)


def attribute_names_json(pages: DataFrame) -> DataFrame:
    """Distinct attribute names (``name``) over every feature of JSON pages.

    The attributes are parsed as a string map, so names outside any declared
    schema are kept (a declared struct would drop them silently).
    """
    loose = T.StructType(
        [
            T.StructField(
                "features",
                T.ArrayType(
                    T.StructType(
                        [T.StructField("attributes", T.MapType(T.StringType(), T.StringType()))]
                    )
                ),
            )
        ]
    )
    doc = F.from_json(F.make_valid_utf8(F.col("body").cast("string")), loose)
    feats = pages.select(F.explode(doc["features"]).alias("f")).where(
        F.col("f.attributes").isNotNull()
    )
    return feats.select(F.explode(F.map_keys("f.attributes")).alias("name")).distinct()


def page_stats_json(pages: DataFrame) -> DataFrame:
    """(page, offset, actual_rows, exceeded, error_code, corrupt) per JSON page; a NULL body has NULL rows."""
    parsed = pages.select("page", "offset", "body", _parsed(F.col("body"), _page_of(T.StringType())).alias("doc"))
    present = F.col("body").isNotNull()
    return parsed.select("page", "offset", *[F.when(present, c).alias(k) for k, c in _doc_stats(F.col("doc")).items()])


def page_stats(pages: DataFrame, requested: str = "json") -> DataFrame:
    """What each page of a table holds, whichever way it is encoded."""
    if requested == "json":
        return page_stats_json(pages)
    from tessera.sources.binary import page_stats_pbf

    return page_stats_pbf(pages)


def audited_pages(rows: DataFrame) -> DataFrame:
    """The audit of the pages that an audited read met: one row a planned page, as ``audit_pages`` gives it."""
    a = rows.where(F.col(AUDIT).isNotNull()).select(f"{AUDIT}.*")
    act, exceeded = F.coalesce("actual_rows", F.lit(0)), F.coalesce("exceeded", F.lit(False))
    status = page_status(
        F.coalesce("expected_rows", F.lit(0)), act, exceeded, F.col("error_code"), F.coalesce("corrupt", F.lit(False)), F.col("present")
    )
    return a.select("page", "offset", "expected_rows", act.cast("bigint").alias("actual_rows"), exceeded.alias("exceeded"), status.alias("status"))


def audit_pages(plan: DataFrame, stats: DataFrame) -> DataFrame:
    """Compare the page plan with what the pages hold: one row a page, with its ``page_status``."""
    j = plan.join(stats.withColumnRenamed("offset", "_soff"), "page", "full_outer")
    exp, act = F.coalesce("expected_rows", F.lit(0)), F.coalesce(F.col("actual_rows"), F.lit(0))
    exceeded = F.coalesce(F.col("exceeded"), F.lit(False))
    status = page_status(
        exp, act, exceeded, F.col("error_code"), F.coalesce(F.col("corrupt"), F.lit(False)), F.col("actual_rows").isNotNull()
    )
    return j.select(
        "page",
        F.coalesce(F.col("offset"), F.col("_soff")).alias("offset"),
        F.col("expected_rows"),
        act.cast("bigint").alias("actual_rows"),
        exceeded.alias("exceeded"),
        status.alias("status"),
    )
