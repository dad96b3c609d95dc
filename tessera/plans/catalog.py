"""Registered queries: each a (spark, sf_dir) -> DataFrame builder and, where
SQL can say it, the equivalent DuckDB text over the same parquet tables.

Every query reads the given tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.dedup import dedup_counts, keep_latest
from tessera.operators.keys import key_chunks, key_scan, missing_keys, normalize_keys
from tessera.operators.pivot import pivot_years, valid_years
from tessera.operators.rules import FAILED, with_failed_rules
from tessera.operators.transform import transform
from tessera.plans.curation import curate, curate_layer, curated_wide
from tessera.functions.timestamps import ms_to_ntz, ntz_to_ms
from tessera.operators.contract import contract_diff
from tessera.schemas import API_COLUMNS, CURATED_COLUMNS, PIVOT_VALUE_COLUMNS, RAW_SCHEMA
from tessera.functions.geometry import UPPER_LEFT, outer_ring_wkt, zigzag
from tessera.sources.binary import decode_pbf_pages
from tessera.sources.feature_source import land_pages, write_layer_docs
from tessera.sources.fixture_pages import broken_pages, land_layer, pack_json_pages, pack_pbf_pages
from tessera.functions.indexing import running_sum
from tessera.operators.geometry import assign_parts, decode_deltas
from tessera.operators.agreement import compare_encodings
from tessera.session import scratch_path
from tessera.sources.feature_layer import load_keys, load_layer, summarize_pages
from tessera.sources.layer import read_layer, read_pages
from tessera.streaming.pages import ingest_pages, ingest_progress, read_ingested
from tessera.sources.pages import (
    attribute_names_json,
    audit_pages,
    decode_json_pages,
    layer_label,
    page_stats,
    parse_layer_meta,
    plan_pages,
    route,
)
from tessera.sources.fixtures import (
    BUILDING_REGISTRY_SQL,
    RAW_READINGS_SQL,
    REQUESTED_BUILDINGS_SQL,
    FOOTPRINT_SIDE,
    FOOTPRINT_X0,
    FOOTPRINT_Y0,
    building_registry,
    raw_readings,
    readings_with_footprint,
    requested_buildings,
    table,
)

# Pinned upper bound of valid years (the clock-derived default is next year).
ANNEE_MAX = 2027

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------------------
# SQL building blocks (DuckDB dialect)
# ---------------------------------------------------------------------------

_TRANSFORM_SQL = """
select cast(EGID as bigint) as egid, cast(ANNEE as bigint) as annee,
  cast(INDICE as bigint) as indice, cast(SRE as bigint) as sre,
  cast(ADRESSE as varchar) as adresse, cast(NPA as bigint) as npa,
  cast(COMMUNE as varchar) as commune, cast(DESTINATION as varchar) as destination,
  cast(AGENT_ENERGETIQUE_1 as varchar) as agent_energetique_1,
  cast(QUANTITE_AGENT_ENERGETIQUE_1 as double) as quantite_agent_energetique_1,
  cast(UNITE_AGENT_ENERGETIQUE_1 as varchar) as unite_agent_energetique_1,
  cast(AGENT_ENERGETIQUE_2 as varchar) as agent_energetique_2,
  cast(QUANTITE_AGENT_ENERGETIQUE_2 as double) as quantite_agent_energetique_2,
  cast(UNITE_AGENT_ENERGETIQUE_2 as varchar) as unite_agent_energetique_2,
  cast(AGENT_ENERGETIQUE_3 as varchar) as agent_energetique_3,
  cast(QUANTITE_AGENT_ENERGETIQUE_3 as double) as quantite_agent_energetique_3,
  cast(UNITE_AGENT_ENERGETIQUE_3 as varchar) as unite_agent_energetique_3,
  make_timestamp(DATE_DEBUT_PERIODE * 1000) as date_debut_periode,
  make_timestamp(DATE_FIN_PERIODE * 1000) as date_fin_periode,
  make_timestamp(DATE_SAISIE * 1000) as date_saisie,
  cast(INDICE_MOY2 as bigint) as indice_moy2,
  cast(ANNEES_CONCERNEES_MOY_2 as varchar) as annees_concernees_moy_2,
  cast(INDICE_MOY3 as bigint) as indice_moy3,
  cast(ANNEES_CONCERNEES_MOY_3 as varchar) as annees_concernees_moy_3,
  cast(NBRE_PRENEUR as bigint) as nbre_preneur,
  OBJECTID as objectid
from raw
"""

_DEDUP_SQL = """
select * exclude (rn) from (
  select *, row_number() over (partition by egid, annee
      order by date_saisie desc nulls first, objectid desc) as rn
  from transformed) where rn = 1
"""

_FAILED_SQL = f"""
select *, concat_ws(';',
  case when egid is null then 'egid|nullability' end,
  case when annee is null then 'annee|nullability' end,
  case when indice is null then 'indice|nullability' end,
  case when sre is null then 'sre|nullability' end,
  case when adresse is null then 'adresse|nullability' end,
  case when npa is null then 'npa|nullability' end,
  case when commune is null then 'commune|nullability' end,
  case when destination is null then 'destination|nullability' end,
  case when agent_energetique_1 is null then 'agent_energetique_1|nullability' end,
  case when quantite_agent_energetique_1 is null then 'quantite_agent_energetique_1|nullability' end,
  case when unite_agent_energetique_1 is null then 'unite_agent_energetique_1|nullability' end,
  case when date_debut_periode is null then 'date_debut_periode|nullability' end,
  case when date_fin_periode is null then 'date_fin_periode|nullability' end,
  case when date_saisie is null then 'date_saisie|nullability' end,
  case when not coalesce(egid between 10000 and 999999999, true) then 'egid_valide' end,
  case when not coalesce(indice > 0, true) then 'indice_positif' end,
  case when not coalesce(sre > 0, true) then 'sre_positive' end,
  case when not coalesce(annee between 2000 and {ANNEE_MAX}, true) then 'annee_valide' end,
  case when not coalesce(npa between 1000 and 9999, true) then 'npa_suisse' end,
  case when not coalesce(date_debut_periode < date_fin_periode, true) then 'periode_coherente' end
) as failed_rules
from deduped
"""


def _with(*ctes: tuple[str, str], body: str) -> str:
    return "with " + ",\n".join(f"{n} as ({s})" for n, s in ctes) + "\n" + body


_RAW = ("raw", RAW_READINGS_SQL)
_T = ("transformed", _TRANSFORM_SQL)
_D = ("deduped", _DEDUP_SQL)
_C = ("checked", _FAILED_SQL)
_V = ("valid", "select * exclude (failed_rules, objectid) from checked where failed_rules = ''")
_KEYS = ("keys", REQUESTED_BUILDINGS_SQL)
_CURATED_LIST = ", ".join(CURATED_COLUMNS)


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_failed_rules(keep_latest(transform(raw_readings(spark, sf_dir))), ANNEE_MAX)


# ---------------------------------------------------------------------------
# Curation
# ---------------------------------------------------------------------------


@register("transform", _with(_RAW, _T, body="select * from transformed"))
def q_transform(spark, sf_dir):
    return transform(raw_readings(spark, sf_dir))


@register("keep_latest", _with(_RAW, _T, _D, body="select * from deduped"))
def q_keep_latest(spark, sf_dir):
    return keep_latest(transform(raw_readings(spark, sf_dir)))


@register(
    "dedup_removed",
    _with(
        _RAW,
        _T,
        body="""select cast(count(*) as bigint) as n_before,
  cast(count(distinct (egid, annee)) as bigint) as n_after,
  cast(count(*) - count(distinct (egid, annee)) as bigint) as n_removed from transformed""",
    ),
)
def q_dedup_removed(spark, sf_dir):
    return dedup_counts(transform(raw_readings(spark, sf_dir)))


@register(
    "failed_rules",
    _with(
        _RAW,
        _T,
        _D,
        _C,
        body="""select egid, annee, objectid, failed_rules,
  cast(len(string_split(failed_rules, ';')) as integer) as n_failed
from checked where failed_rules <> ''""",
    ),
)
def q_failed_rules(spark, sf_dir):
    c = _checked(spark, sf_dir)
    return c.where(F.size(FAILED) > 0).select(
        "egid",
        "annee",
        "objectid",
        F.array_join(FAILED, ";").alias("failed_rules"),
        F.size(FAILED).alias("n_failed"),
    )


@register("valid_rows", _with(_RAW, _T, _D, _C, _V, body="select * from valid"))
def q_valid_rows(spark, sf_dir):
    return curate(raw_readings(spark, sf_dir), annee_max=ANNEE_MAX).valid


@register(
    "rule_counts",
    _with(
        _RAW,
        _T,
        _D,
        _C,
        body="""select rule, count(*) as n from
  (select unnest(string_split(failed_rules, ';')) as rule from checked where failed_rules <> '')
group by rule""",
    ),
)
def q_rule_counts(spark, sf_dir):
    return curate(raw_readings(spark, sf_dir), annee_max=ANNEE_MAX).rule_counts


@register(
    "run_summary",
    _with(
        _RAW,
        _T,
        _D,
        _C,
        _V,
        _KEYS,
        body="""select (select count(*) from valid where egid in (select egid from keys)) as n_valid,
  (select count(distinct egid) from valid where egid in (select egid from keys)) as n_egid,
  (select count(*) from keys) as n_requested""",
    ),
)
def q_run_summary(spark, sf_dir):
    keys = normalize_keys(requested_buildings(spark, sf_dir))
    return curate(raw_readings(spark, sf_dir), keys=keys, annee_max=ANNEE_MAX).summary()


_PIVOT_SQL = "select egid, " + ", ".join(
    f"max(case when annee = {y} then {v} end) as {v}_{y}" for v in sorted(PIVOT_VALUE_COLUMNS) for y in valid_years(ANNEE_MAX)
) + " from valid group by egid"


@register("pivot_years", _with(_RAW, _T, _D, _C, _V, body=_PIVOT_SQL))
def q_pivot_years(spark, sf_dir):
    valid = curate(raw_readings(spark, sf_dir), annee_max=ANNEE_MAX).valid
    return pivot_years(valid, years=valid_years(ANNEE_MAX))


@register("curated_wide", _with(_RAW, _T, _D, _C, _V, body=_PIVOT_SQL))
def q_curated_wide(spark, sf_dir):
    """Strict curation and the wide table, over those raw rows that are the valid latest ones."""
    raw = raw_readings(spark, sf_dir)
    good = _checked(spark, sf_dir).where(F.size(FAILED) == 0).select(F.col("objectid").alias("OBJECTID"))
    return curated_wide(raw.join(good, "OBJECTID", "left_semi").select(*raw.columns), annee_max=ANNEE_MAX)


# ---------------------------------------------------------------------------
# Keys and coverage
# ---------------------------------------------------------------------------


@register(
    "key_chunks",
    _with(
        ("every", "select 9990 + c_custkey as egid from customer"),
        ("ranked", "select egid, (row_number() over (order by egid) - 1) // 50 as chunk from every"),
        body="""select cast(chunk as bigint) as chunk, count(*) as n_keys,
  case when count(*) > 1
       then 'EGID IN (' || string_agg(cast(egid as varchar), ',' order by egid) || ')'
       else 'EGID=' || cast(min(egid) as varchar) end as predicate
from ranked group by chunk""",
    ),
)
def q_key_chunks(spark, sf_dir):
    every = table(spark, sf_dir, "customer").select((F.lit(9990) + F.col("c_custkey")).alias("egid"))
    return key_chunks(normalize_keys(every), 50)


@register(
    "key_scan",
    _with(_RAW, _KEYS, body="select * from raw where cast(EGID as bigint) in (select egid from keys)"),
)
def q_key_scan(spark, sf_dir):
    keys = normalize_keys(requested_buildings(spark, sf_dir))
    return key_scan(raw_readings(spark, sf_dir), keys, "EGID")


@register(
    "coverage_missing",
    _with(
        _RAW,
        _T,
        _D,
        ("registry", BUILDING_REGISTRY_SQL),
        body="select distinct egid from registry where egid not in (select egid from deduped)",
    ),
)
def q_coverage_missing(spark, sf_dir):
    keys = normalize_keys(building_registry(spark, sf_dir))
    return missing_keys(keys, keep_latest(transform(raw_readings(spark, sf_dir))))


# ---------------------------------------------------------------------------
# Layer reads (count with a filter)
# ---------------------------------------------------------------------------


@register(
    "filtered_count",
    _with(
        _RAW,
        body="""select count(*) as n_all,
  count(*) filter (where COMMUNE = 'BUILDING') as n_filtered from raw""",
    ),
)
def q_filtered_count(spark, sf_dir):
    r = raw_readings(spark, sf_dir)
    return r.agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count(F.when(F.col("COMMUNE") == "BUILDING", 1)).alias("n_filtered"),
    )



# ---------------------------------------------------------------------------
# Pages: metadata, plan, routing, JSON decoding, audit
# ---------------------------------------------------------------------------

READINGS_URL = "https://gis.example.org/arcgis/rest/services/HEAT_INDEX/FeatureServer/0/query"
PAGE = 1000  # curation page size


def _readings_json_pages(spark, sf_dir, chunk=PAGE):
    return pack_json_pages(raw_readings(spark, sf_dir), chunk, key="OBJECTID", layer="HEAT_INDEX")


@register(
    "layer_meta",
    _with(
        _RAW,
        ("per", "select coalesce(COMMUNE, 'UNKNOWN') as layer, count(*) as n from raw group by 1"),
        (
            "sized",
            """select layer, n, cast(coalesce(case when n >= 2000 then 1000 end, 2000)
       * coalesce(case when n >= 2500 then 1.5 end, 1.0) as bigint) as chunk_size from per""",
        ),
        body="select layer, n, chunk_size, cast(ceil(n / chunk_size) as bigint) as n_pages from sized",
    ),
)
def q_layer_meta(spark, sf_dir):
    """Metadata documents of per-commune layers, parsed; page size resolved
    with the server defaults where a document lacks the fields."""
    per = raw_readings(spark, sf_dir).groupBy(
        F.coalesce(F.col("COMMUNE"), F.lit("UNKNOWN")).alias("layer")
    ).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    doc = F.to_json(
        F.struct(
            F.col("layer").alias("name"),
            F.when(n >= 2000, F.lit(1000)).alias("standardMaxRecordCount"),
            F.when(n >= 2500, F.lit(1.5)).alias("maxRecordCountFactor"),
        )
    )
    meta = parse_layer_meta(per.select("layer", "n", doc.alias("doc")))
    return meta.select(
        "layer", "n", "chunk_size", F.ceil(F.col("n") / F.col("chunk_size")).alias("n_pages")
    )


@register(
    "page_plan",
    _with(
        _RAW,
        ("c", "select count(*) as n from raw"),
        body=f"""select cast(off // {PAGE} as bigint) as page, cast(off as bigint) as offset,
  cast(least({PAGE}, n - off) as bigint) as expected_rows
from (select n, unnest(range(0, n, {PAGE})) as off from c)""",
    ),
)
def q_page_plan(spark, sf_dir):
    total = raw_readings(spark, sf_dir).count()
    return plan_pages(spark, total, PAGE)


@register(
    "page_route",
    _with(
        _RAW,
        ("c", "select count(*) as n from raw"),
        body=f"""select 'readings' as source, cast(off // {PAGE} as bigint) as page_id,
  'json' as route, 'HEAT_INDEX' as layer
from (select unnest(range(0, n, {PAGE})) as off from c)
union all
select 'pages' as source, page_id,
  case when regexp_matches(html, '^\\s*[\\[{{]') then 'json' else 'pbf' end as route,
  coalesce(nullif(regexp_extract(url, '/services/([^/]+)/', 1), ''), 'ArcGIS') as layer
from pages""",
    ),
)
def q_page_route(spark, sf_dir):
    readings = _readings_json_pages(spark, sf_dir).select(
        F.lit("readings").alias("source"),
        F.col("page").alias("page_id"),
        F.lit(READINGS_URL).alias("url"),
        "body",
    )
    html = table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("source"),
        "page_id",
        "url",
        F.encode(F.col("html"), "UTF-8").alias("body"),
    )
    routed = route(readings.unionByName(html), requested="pbf")
    return routed.select("source", "page_id", "route", layer_label(F.col("url")).alias("layer"))


@register("json_features", _with(_RAW, body="select * from raw"))
def q_json_features(spark, sf_dir):
    return decode_json_pages(_readings_json_pages(spark, sf_dir), RAW_SCHEMA)


# A layer some of whose pages are at fault (see ``broken_pages``), in small pages so that every kind occurs.
SMALL_PAGE = 100
_PLAN = (
    "plan",
    f"""select off // {SMALL_PAGE} as page, off, least({SMALL_PAGE}, n - off) as expected, off + {SMALL_PAGE} < n as more
from (select n, unnest(range(0, n, {SMALL_PAGE})) as off from (select count(*) as n from raw))""",
)


def _audit_sql(short: str, extra: str, extra_flag: str, extra_status: str) -> str:
    return _with(
        _RAW,
        _PLAN,
        body=f"""select cast(page as bigint) as page, cast(off as bigint) as offset, cast(expected as bigint) as expected_rows,
  cast(case page % 7 when 0 then expected when 4 then {short} when 6 then {extra} else 0 end as bigint) as actual_rows,
  case page % 7 when 0 then more when 3 then true when 6 then {extra_flag} else false end as exceeded,
  case page % 7 when 0 then case when more then 'full' else 'ok' end when 1 then 'error' when 2 then 'missing'
    when 3 then 'overflow' when 4 then case when {short} < expected then 'short' else 'ok' end
    when 5 then 'corrupt' else {extra_status} end as status
from plan""",
    )


@register("page_audit", _audit_sql("1", "expected + 1", "more", "'extra'"))
def q_page_audit(spark, sf_dir):
    """Pages of the readings layer as JSON, some at fault, against the page plan."""
    pages = broken_pages(_readings_json_pages(spark, sf_dir, SMALL_PAGE))
    total = raw_readings(spark, sf_dir).count()
    return audit_pages(plan_pages(spark, total, SMALL_PAGE), page_stats(pages, "json"))


@register("pbf_page_audit", _audit_sql("0", "expected", "more", "case when more then 'full' else 'ok' end"))
def q_pbf_page_audit(spark, sf_dir):
    """The same audit over the layer served as binary pages (errors come as JSON all the same)."""
    pages = broken_pages(_readings_pbf_pages(spark, sf_dir, SMALL_PAGE))
    total = raw_readings(spark, sf_dir).count()
    return audit_pages(plan_pages(spark, total, SMALL_PAGE), page_stats(pages, "pbf"))


@register(
    "layer_scan_faulty",
    _with(
        _RAW,
        ("numbered", f"select *, row_number() over (order by OBJECTID) - 1 as i, (row_number() over (order by OBJECTID) - 1) // {SMALL_PAGE} as page from raw"),
        body=f"""select * exclude (i, page) from numbered where page % 7 in (0, 6) or page % 7 = 4 and i % {SMALL_PAGE} = 0
union all
select * exclude (i, page) from numbered where page % 7 = 6 and i % {SMALL_PAGE} = 0""",
    ),
)
def q_layer_scan_faulty(spark, sf_dir):
    """A landed layer with pages at fault, read with mode="split": the readable rows (strict mode raises)."""
    root = scratch_path(spark, "readings-faulty")
    land_pages(broken_pages(_readings_json_pages(spark, sf_dir, SMALL_PAGE)), root)
    write_layer_docs(root, raw_readings(spark, sf_dir).count(), {"standardMaxRecordCount": SMALL_PAGE})
    return read_layer(spark, RAW_SCHEMA, path=root, mode="split").rows


@register(
    "pbf_layer_scan_faulty",
    _with(
        _RAW,
        ("numbered", f"select *, (row_number() over (order by OBJECTID) - 1) // {SMALL_PAGE} as page from raw"),
        body="select * exclude (page) from numbered where page % 7 in (0, 6)",
    ),
)
def q_pbf_layer_scan_faulty(spark, sf_dir):
    """The same over binary pages: cut-off pages give no rows, the others all of theirs."""
    root = scratch_path(spark, "readings-faulty-pbf")
    land_pages(broken_pages(_readings_pbf_pages(spark, sf_dir, SMALL_PAGE)), root)
    write_layer_docs(root, raw_readings(spark, sf_dir).count(), {"standardMaxRecordCount": SMALL_PAGE})
    return read_layer(spark, RAW_SCHEMA, path=root, response_format="pbf", mode="split").rows


@register(
    "scan_audit",
    _with(
        _RAW,
        ("c", "select count(*) as n, count(distinct OBJECTID) as d from raw"),
        (
            "e",
            f"""select count(*) as again from (select unnest(range(0, n, {SMALL_PAGE})) as off from c)
where (off // {SMALL_PAGE}) % 7 = 6""",
        ),
        body=f"""select cast(ceil(n / {SMALL_PAGE}) as bigint) as n_pages, n + again as n_rows,
  d as n_distinct_ids, n + again - d as n_duplicate_rows from c, e""",
    ),
)
def q_scan_audit(spark, sf_dir):
    """Rows read against distinct object ids; every seventh page repeats a feature."""
    whole = _readings_json_pages(spark, sf_dir, SMALL_PAGE)
    pages = whole.where("page % 7 <> 6").unionByName(broken_pages(whole).where("page % 7 = 6"))
    feats = decode_json_pages(pages, RAW_SCHEMA)
    per_id = feats.groupBy("OBJECTID").agg(F.count(F.lit(1)).alias("_n"))
    tagged = per_id.select("_n", F.lit(0).alias("_p")).unionByName(
        pages.select(F.lit(None).cast("bigint").alias("_n"), F.lit(1).alias("_p"))
    )
    return tagged.agg(
        F.sum("_p").cast("bigint").alias("n_pages"),
        F.sum("_n").alias("n_rows"),
        F.count("_n").alias("n_distinct_ids"),
        F.sum(F.col("_n") - 1).alias("n_duplicate_rows"),
    )


def _landed(spark, sf_dir, name: str, fmt: str = "json") -> str:
    root = scratch_path(spark, name)
    land_layer(raw_readings(spark, sf_dir), root, PAGE, key="OBJECTID", layer="HEAT_INDEX", fmt=fmt)
    return root


@register("layer_curated", _with(_RAW, _T, _D, _C, _V, body="select * from valid"))
def q_layer_curated(spark, sf_dir):
    """Land the readings as binary pages, read them strictly, check the contract on them, curate."""
    return curate_layer(spark, path=_landed(spark, sf_dir, "readings-curated", "pbf"), response_format="pbf", annee_max=ANNEE_MAX).valid


@register("layer_fields", _with(_RAW, body="select OBJECTID, EGID, SRE from raw"))
def q_layer_fields(spark, sf_dir):
    """Some fields of a landed layer: only these are decoded."""
    return read_layer(spark, RAW_SCHEMA, path=_landed(spark, sf_dir, "readings-fields"), fields="OBJECTID,EGID,SRE")


@register("layer_where", _with(_RAW, body="select OBJECTID, COMMUNE from raw where COMMUNE = 'BUILDING' and SRE > 100"))
def q_layer_where(spark, sf_dir):
    """A filter on a landed layer."""
    root = _landed(spark, sf_dir, "readings-where")
    return read_layer(spark, RAW_SCHEMA, path=root, where="COMMUNE = 'BUILDING' and SRE > 100", fields="OBJECTID,COMMUNE")


@register("layer_typed", _with(_RAW, body="select * from raw"))
def q_layer_typed(spark, sf_dir):
    """A landed layer as typed rows, by its own metadata."""
    return load_layer(spark, path=_landed(spark, sf_dir, "readings-typed"))


@register("layer_pushed", _with(_RAW, body="select OBJECTID, COMMUNE, SRE from raw where COMMUNE in ('BUILDING', 'MACHINERY') and SRE > 100 and EGID < 10500"))
def q_layer_pushed(spark, sf_dir):
    """``where`` on the typed rows of a landed layer of binary pages reaches the read of its pages."""
    rows = load_layer(spark, path=_landed(spark, sf_dir, "readings-pushed", "pbf"), format="pbf")
    return rows.where("COMMUNE in ('BUILDING', 'MACHINERY') and SRE > 100 and EGID < 10500").select("OBJECTID", "COMMUNE", "SRE")


@register(
    "key_chunk_scan",
    _with(_RAW, _KEYS, body="select * from raw where cast(EGID as bigint) in (select egid from keys)"),
)
def q_key_chunk_scan(spark, sf_dir):
    """The requested buildings' rows of a landed layer, by key chunks; pages without them are skipped."""
    root = _landed(spark, sf_dir, "readings-keys")
    summarize_pages(read_pages(spark, path=root), root, ["EGID"])
    return load_keys(spark, key_chunks(normalize_keys(requested_buildings(spark, sf_dir))), path=root)


@register("layer_scan", _with(_RAW, body="select * from raw"))
def q_layer_scan(spark, sf_dir):
    """Land the readings layer as JSON page files in the shared folder, then
    read it back through the ``feature_pages`` source (bulk layer read)."""
    root = scratch_path(spark, "readings-layer")
    land_layer(raw_readings(spark, sf_dir), root, PAGE, key="OBJECTID", layer="HEAT_INDEX")
    return read_layer(spark, RAW_SCHEMA, path=root, response_format="json")


@register("streamed_features", _with(_RAW, body="select * from raw"))
def q_streamed_features(spark, sf_dir):
    """Land the readings layer's pages, ingest them with a Structured
    Streaming query (available-now trigger, one checkpoint, one folder per
    micro-batch) and read the ingested features back."""
    root = scratch_path(spark, "readings-stream")
    land_layer(raw_readings(spark, sf_dir), root, PAGE, key="OBJECTID", layer="HEAT_INDEX")
    sink = scratch_path(spark, "readings-stream-sink")
    q = ingest_pages(spark, root, RAW_SCHEMA, sink, scratch_path(spark, "readings-stream-ck"))
    q.awaitTermination()
    return read_ingested(spark, sink, RAW_SCHEMA).select(*RAW_SCHEMA.fieldNames())


@register(
    "ingest_progress",
    _with(
        _RAW,
        body=f"""select cast(ceil(count(*) / {PAGE}) as bigint) as pages_planned,
  cast(ceil(count(*) / {PAGE}) as bigint) as pages_landed,
  cast(1.0 as double) as fraction from raw""",
    ),
)
def q_ingest_progress(spark, sf_dir):
    """Pages of the landed readings layer against its page plan."""
    root = scratch_path(spark, "readings-progress")
    land_layer(raw_readings(spark, sf_dir), root, PAGE, key="OBJECTID", layer="HEAT_INDEX")
    return ingest_progress(spark, root)


# ---------------------------------------------------------------------------
# Coordinates: zigzag, running sums, dequantization, parts
# ---------------------------------------------------------------------------

# Quantization of the event track fixture: 1 unit = 1 mm, origin upper left.
TRACK_SCALE, TRACK_X0, TRACK_Y0 = 0.001, 2480000.0, 1110000.0

_TRACK_SQL = """
select user_id, event_id, cast(ts as date) as day,
  xor(zx >> 1, -(zx & 1)) as dx, xor(zy >> 1, -(zy & 1)) as dy
from (select user_id, event_id, ts, cast(round(value * 100) as bigint) as zx,
        cast(json_extract_string(props, '$.k') as bigint) as zy from events)
"""


def _track(spark, sf_dir):
    """Event track as zigzag-coded integer deltas: one vertex per event,
    feature = user, vertex order = event_id."""
    e = table(spark, sf_dir, "events")
    zx = F.round(F.col("value") * 100).cast("bigint")
    zy = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        "user_id",
        "event_id",
        F.to_date("ts").alias("day"),
        zigzag(zx).alias("dx"),
        zigzag(zy).alias("dy"),
    )


@register(
    "delta_dequantize",
    _with(
        ("t", _TRACK_SQL),
        body=f"""select user_id, event_id,
  {TRACK_X0}::double + cast(sum(dx) over w as double) * {TRACK_SCALE}::double as x,
  {TRACK_Y0}::double + (-1.0)::double * (cast(sum(dy) over w as double) * {TRACK_SCALE}::double) as y
from t window w as (partition by user_id order by event_id rows between unbounded preceding and current row)""",
    ),
)
def q_delta_dequantize(spark, sf_dir):
    v = decode_deltas(
        _track(spark, sf_dir),
        ["user_id"],
        "event_id",
        x_scale=TRACK_SCALE,
        y_scale=TRACK_SCALE,
        x_translate=TRACK_X0,
        y_translate=TRACK_Y0,
        origin=UPPER_LEFT,
    )
    return v.select("user_id", "event_id", "x", "y")


@register(
    "geometry_parts",
    _with(
        ("t", _TRACK_SQL),
        body="""select user_id, event_id,
  cast(row_number() over (partition by user_id order by event_id) - 1 as bigint) as vertex,
  cast(dense_rank() over (partition by user_id order by day) - 1 as bigint) as part
from t""",
    ),
)
def q_geometry_parts(spark, sf_dir):
    """Each user's track is one multi-part line, one part per day: part
    lengths are the per-day vertex counts; parts are assigned from them."""
    t = _track(spark, sf_dir)
    counted = running_sum(t.withColumn("_one", F.lit(1)), ["user_id"], "event_id", ["_one"])
    vertices = counted.select("user_id", "event_id", (F.col("_one_cum") - 1).alias("vertex"))
    lengths = t.groupBy(
        "user_id", F.unix_date("day").cast("bigint").alias("part")
    ).agg(F.count(F.lit(1)).alias("length"))
    return assign_parts(vertices, lengths, ["user_id"], "vertex").select(
        "user_id", "event_id", "vertex", F.col("part").cast("bigint").alias("part")
    )


# ---------------------------------------------------------------------------
# Binary pages and footprints
# ---------------------------------------------------------------------------

# Quantization of the binary readings pages: millimetres, origin upper left.
PBF_QUANTIZE = {"origin": 0, "sx": 0.001, "sy": 0.001, "tx": 2480000.0, "ty": 1200000.0}
# Integer attribute encodings used for the binary pages (others: int64).
PBF_SLOTS = {"ANNEE": "sint32", "INDICE": "sint64", "SRE": "uint32"}


def _readings_pbf_pages(spark, sf_dir, chunk=PAGE):
    return pack_pbf_pages(
        readings_with_footprint(spark, sf_dir),
        chunk,
        key="OBJECTID",
        layer="HEAT_INDEX",
        geometry="geometry",
        slots=PBF_SLOTS,
        quantize=PBF_QUANTIZE,
    )


@register("pbf_features", _with(_RAW, body="select * from raw"))
def q_pbf_features(spark, sf_dir):
    return decode_pbf_pages(_readings_pbf_pages(spark, sf_dir), RAW_SCHEMA)


def _ring_sql(x: str, y: str, side: float) -> str:
    pts = [(0, 0), (side, 0), (side, side), (0, side), (0, 0)]
    return " || ', ' || ".join(
        f"printf('%.3f %.3f', {x} + {dx}, {y} + {dy})" for dx, dy in pts
    )


@register(
    "outer_ring_wkt",
    _with(
        _RAW,
        (
            "g",
            f"""select OBJECTID, AGENT_ENERGETIQUE_1 as a,
  {FOOTPRINT_X0}::double + (EGID - 9990.0) * 7.0::double as x,
  {FOOTPRINT_Y0}::double + cast(OBJECTID as double) * 0.5::double as y from raw""",
        ),
        body=f"""select OBJECTID, case when a = '1-URGENT' then 2 else 1 end as n_parts,
  'POLYGON ((' || {_ring_sql("x", "y", FOOTPRINT_SIDE)} || '))' as wkt from g""",
    ),
)
def q_outer_ring_wkt(spark, sf_dir):
    """Binary pages -> decoded footprints -> WKT of the outer ring (holes dropped)."""
    feats = decode_pbf_pages(_readings_pbf_pages(spark, sf_dir), RAW_SCHEMA, with_geometry=True)
    return feats.select(
        "OBJECTID",
        F.size("geometry.parts").alias("n_parts"),
        outer_ring_wkt(F.col("geometry")).alias("wkt"),
    )


@register(
    "layer_geometry",
    _with(
        _RAW,
        (
            "g",
            f"""select OBJECTID, EGID, AGENT_ENERGETIQUE_1 as a,
  {FOOTPRINT_X0}::double + (EGID - 9990.0) * 7.0::double as x,
  {FOOTPRINT_Y0}::double + cast(OBJECTID as double) * 0.5::double as y from raw where SRE > 100""",
        ),
        body=f"""select OBJECTID, EGID, 2056 as wkid, case when a = '1-URGENT' then 2 else 1 end as n_parts,
  'POLYGON ((' || {_ring_sql("x", "y", FOOTPRINT_SIDE)} || '))' as wkt from g""",
    ),
)
def q_layer_geometry(spark, sf_dir):
    """A landed layer of binary pages as typed rows with footprints; the filter reaches the read of its pages."""
    root = scratch_path(spark, "readings-geometry")
    land_layer(
        readings_with_footprint(spark, sf_dir), root, PAGE, key="OBJECTID", layer="HEAT_INDEX", fmt="pbf", geometry="geometry", quantize=PBF_QUANTIZE
    )
    rows = load_layer(spark, path=root, format="pbf", fields="OBJECTID,EGID,SRE", with_geometry=True).where("SRE > 100")
    return rows.select(
        "OBJECTID", "EGID", "geometry.wkid", F.size("geometry.parts").alias("n_parts"), outer_ring_wkt(F.col("geometry")).alias("wkt")
    )


@register(
    "encoding_agreement",
    _with(
        _RAW,
        body="""select OBJECTID, true as in_json, true as in_pbf, true as same_attributes,
  cast(case when AGENT_ENERGETIQUE_1 = '1-URGENT' then 10 else 5 end as integer) as n_vertices_json,
  cast(case when AGENT_ENERGETIQUE_1 = '1-URGENT' then 10 else 5 end as integer) as n_vertices_pbf,
  true as coords_within_tol from raw""",
    ),
)
def q_encoding_agreement(spark, sf_dir):
    """The readings layer with footprints served as JSON pages and as binary
    pages: both decoded, compared feature by feature on OBJECTID."""
    wf = readings_with_footprint(spark, sf_dir)
    js = decode_json_pages(
        pack_json_pages(wf, PAGE, key="OBJECTID", layer="HEAT_INDEX", geometry="geometry"),
        RAW_SCHEMA,
        with_geometry=True,
    )
    pb = decode_pbf_pages(_readings_pbf_pages(spark, sf_dir), RAW_SCHEMA, with_geometry=True)
    return compare_encodings(js, pb, "OBJECTID", RAW_SCHEMA.fieldNames(), tolerance=0.01)


# ---------------------------------------------------------------------------
# Dates and the column contract
# ---------------------------------------------------------------------------


@register(
    "epoch_ms_cast",
    """select event_id, epoch_us(ts) // 1000 as ms,
  make_timestamp((epoch_us(ts) // 1000) * 1000) as ts_ms from events""",
)
def q_epoch_ms_cast(spark, sf_dir):
    """Zone-less timestamps -> epoch milliseconds -> timestamps (ms precision)."""
    e = table(spark, sf_dir, "events")
    ms = ntz_to_ms(F.col("ts"))
    return e.select("event_id", ms.alias("ms"), ms_to_ntz(ms).alias("ts_ms"))


_EXPECTED_SQL = " union all ".join(f"select '{c}' as name" for c in API_COLUMNS)


@register(
    "contract_diff",
    _with(
        _RAW,
        ("drifted", "select * rename (NBRE_PRENEUR as NB_PRENEURS) from raw"),
        ("got", "select distinct unnest(json_keys(to_json(d))) as name from drifted d"),
        ("expected", _EXPECTED_SQL),
        body="""select name as column_name, 'missing' as status from expected
  where name not in (select name from got)
union all
select name as column_name, 'unexpected' as status from got
  where name not in (select name from expected)""",
    ),
)
def q_contract_diff(spark, sf_dir):
    """Attribute names read from the layer's JSON pages against the contract;
    the layer served here has drifted (one attribute renamed)."""
    drifted = raw_readings(spark, sf_dir).withColumnRenamed("NBRE_PRENEUR", "NB_PRENEURS")
    pages = pack_json_pages(drifted, PAGE, key="OBJECTID", layer="HEAT_INDEX")
    return contract_diff(attribute_names_json(pages), API_COLUMNS)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["queries", "oracle_sql", "ANNEE_MAX", "table", "CURATED_COLUMNS"]
