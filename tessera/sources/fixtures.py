"""Layer-shaped views over the test tables (see FIXTURES.md).

``raw_readings`` turns ``orders`` joined to ``customer`` into rows shaped like
the heat-index layer's raw attributes (upper-case names, EGID as a double,
dates as epoch milliseconds, planted NULLs). The same view is written once in
DataFrame form for Spark and once as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970-01-01 of a zone-less timestamp (truncating)."""
    return F.timestamp_diff(
        "MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz")
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heat-index layer's raw rows, derived from orders and customer."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    k = F.col("o_orderkey")
    ms = epoch_ms(F.col("o_orderdate"))
    year = F.year("o_orderdate")
    every5 = k % 5 == 0
    every4 = k % 4 == 0
    return j.select(
        k.alias("OBJECTID"),
        (F.lit(9990) + F.col("o_custkey")).cast("double").alias("EGID"),
        (year + 4).cast("bigint").alias("ANNEE"),
        (F.floor(F.col("o_totalprice") / 1000).cast("bigint") - 20).alias("INDICE"),
        (k % 200).cast("bigint").alias("SRE"),
        F.col("c_name").alias("ADRESSE"),
        (F.lit(990) + F.col("o_custkey")).cast("bigint").alias("NPA"),
        F.when(k % 89 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("COMMUNE"),
        F.col("o_orderstatus").alias("DESTINATION"),
        F.col("o_orderpriority").alias("AGENT_ENERGETIQUE_1"),
        F.col("o_totalprice").alias("QUANTITE_AGENT_ENERGETIQUE_1"),
        F.when(k % 2 == 0, "kWh").otherwise("lt").alias("UNITE_AGENT_ENERGETIQUE_1"),
        F.when(every5, "Gaz").alias("AGENT_ENERGETIQUE_2"),
        F.when(every5, F.col("o_totalprice") / 2).alias("QUANTITE_AGENT_ENERGETIQUE_2"),
        F.when(every5, "kWh").alias("UNITE_AGENT_ENERGETIQUE_2"),
        F.lit(None).cast("string").alias("AGENT_ENERGETIQUE_3"),
        F.lit(None).cast("double").alias("QUANTITE_AGENT_ENERGETIQUE_3"),
        F.lit(None).cast("string").alias("UNITE_AGENT_ENERGETIQUE_3"),
        (ms - F.lit(31536000000)).alias("DATE_DEBUT_PERIODE"),
        F.when(k % 97 == 0, ms - F.lit(31536000000)).otherwise(ms).alias("DATE_FIN_PERIODE"),
        F.when(k % 101 == 0, F.lit(None)).otherwise(ms + k).alias("DATE_SAISIE"),
        F.when(every4, (k % 700).cast("bigint")).alias("INDICE_MOY2"),
        F.when(
            every4,
            F.concat((year + 4).cast("string"), F.lit(","), (year + 3).cast("string")),
        ).alias("ANNEES_CONCERNEES_MOY_2"),
        F.lit(None).cast("bigint").alias("INDICE_MOY3"),
        F.lit(None).cast("string").alias("ANNEES_CONCERNEES_MOY_3"),
        F.when(k % 3 == 0, F.lit(None)).otherwise((k % 30).cast("bigint")).alias("NBRE_PRENEUR"),
    )


# Footprint fixture: a 12.5 m square per reading (plus a 5 m hole for urgent
# ones), placed from the building and object ids, in metres of EPSG:2056.
FOOTPRINT_X0, FOOTPRINT_Y0, FOOTPRINT_SIDE = 2480000.0, 1110000.0, 12.5
HOLE_INSET, HOLE_SIDE = 2.5, 5.0


def _square(x: Column, y: Column, side: float) -> Column:
    corners = [(0, 0), (side, 0), (side, side), (0, side), (0, 0)]
    return F.array(
        *[F.struct((x + F.lit(dx)).alias("x"), (y + F.lit(dy)).alias("y")) for dx, dy in corners]
    )


def readings_with_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_readings`` plus a polygon ``geometry`` column (GEOMETRY struct)."""
    r = raw_readings(spark, sf_dir)
    x = F.lit(FOOTPRINT_X0) + (F.col("EGID") - F.lit(9990.0)) * F.lit(7.0)
    y = F.lit(FOOTPRINT_Y0) + F.col("OBJECTID").cast("double") * F.lit(0.5)
    outer = _square(x, y, FOOTPRINT_SIDE)
    hole = _square(x + F.lit(HOLE_INSET), y + F.lit(HOLE_INSET), HOLE_SIDE)
    parts = F.when(F.col("AGENT_ENERGETIQUE_1") == "1-URGENT", F.array(outer, hole)).otherwise(
        F.array(outer)
    )
    geom = F.struct(
        F.lit("polygon").alias("type"),
        F.lit(None).cast("double").alias("x"),
        F.lit(None).cast("double").alias("y"),
        parts.alias("parts"),
        F.lit(2056).alias("wkid"),
    )
    return r.withColumn("geometry", geom)


def requested_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested building keys: every customer of the BUILDING segment."""
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_mktsegment") == "BUILDING").select(
        (F.lit(9990) + F.col("c_custkey")).alias("egid")
    )


def building_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of building keys, one per part; some have no reading."""
    p = table(spark, sf_dir, "part")
    return p.select((F.lit(9990) + F.col("p_partkey")).alias("egid"))


# --- DuckDB text of the same views -------------------------------------------

_MS = "(epoch_us(o_orderdate)//1000)"

RAW_READINGS_SQL = f"""
select o_orderkey as OBJECTID, cast(9990+o_custkey as double) as EGID,
  cast(year(o_orderdate)+4 as bigint) as ANNEE,
  cast(floor(o_totalprice/1000) as bigint)-20 as INDICE,
  cast(o_orderkey%200 as bigint) as SRE, c_name as ADRESSE, cast(990+o_custkey as bigint) as NPA,
  case when o_orderkey%89=0 then null else c_mktsegment end as COMMUNE, o_orderstatus as DESTINATION,
  o_orderpriority as AGENT_ENERGETIQUE_1, o_totalprice as QUANTITE_AGENT_ENERGETIQUE_1,
  case when o_orderkey%2=0 then 'kWh' else 'lt' end as UNITE_AGENT_ENERGETIQUE_1,
  case when o_orderkey%5=0 then 'Gaz' end as AGENT_ENERGETIQUE_2,
  case when o_orderkey%5=0 then o_totalprice/2 end as QUANTITE_AGENT_ENERGETIQUE_2,
  case when o_orderkey%5=0 then 'kWh' end as UNITE_AGENT_ENERGETIQUE_2,
  cast(null as varchar) as AGENT_ENERGETIQUE_3, cast(null as double) as QUANTITE_AGENT_ENERGETIQUE_3,
  cast(null as varchar) as UNITE_AGENT_ENERGETIQUE_3,
  {_MS}-31536000000 as DATE_DEBUT_PERIODE,
  case when o_orderkey%97=0 then {_MS}-31536000000 else {_MS} end as DATE_FIN_PERIODE,
  case when o_orderkey%101=0 then null else {_MS}+o_orderkey end as DATE_SAISIE,
  case when o_orderkey%4=0 then cast(o_orderkey%700 as bigint) end as INDICE_MOY2,
  case when o_orderkey%4=0 then concat(cast(year(o_orderdate)+4 as varchar),',',
       cast(year(o_orderdate)+3 as varchar)) end as ANNEES_CONCERNEES_MOY_2,
  cast(null as bigint) as INDICE_MOY3, cast(null as varchar) as ANNEES_CONCERNEES_MOY_3,
  case when o_orderkey%3=0 then null else cast(o_orderkey%30 as bigint) end as NBRE_PRENEUR
from orders join customer on o_custkey=c_custkey
"""

BUILDING_REGISTRY_SQL = "select 9990 + p_partkey as egid from part"

REQUESTED_BUILDINGS_SQL = (
    "select 9990 + c_custkey as egid from customer where c_mktsegment = 'BUILDING'"
)
