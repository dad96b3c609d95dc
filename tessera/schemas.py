"""Declared schemas: layer field types, the raw and curated readings, geometry.

Everything downstream works against these declared types; no schema is
inferred by scanning data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: must equal the curated dataset's published contract. ----
# Raw attribute names of the heat-index layer, in contract order.
API_COLUMNS: tuple[str, ...] = (
    "EGID",
    "ANNEE",
    "INDICE",
    "SRE",
    "ADRESSE",
    "NPA",
    "COMMUNE",
    "DESTINATION",
    "AGENT_ENERGETIQUE_1",
    "QUANTITE_AGENT_ENERGETIQUE_1",
    "UNITE_AGENT_ENERGETIQUE_1",
    "AGENT_ENERGETIQUE_2",
    "QUANTITE_AGENT_ENERGETIQUE_2",
    "UNITE_AGENT_ENERGETIQUE_2",
    "AGENT_ENERGETIQUE_3",
    "QUANTITE_AGENT_ENERGETIQUE_3",
    "UNITE_AGENT_ENERGETIQUE_3",
    "DATE_DEBUT_PERIODE",
    "DATE_FIN_PERIODE",
    "DATE_SAISIE",
    "INDICE_MOY2",
    "ANNEES_CONCERNEES_MOY_2",
    "INDICE_MOY3",
    "ANNEES_CONCERNEES_MOY_3",
    "NBRE_PRENEUR",
)

# Curated column -> (type, nullable). Order is the curated column order.
CURATED_FIELDS: tuple[tuple[str, str, bool], ...] = (
    ("egid", "bigint", False),
    ("annee", "bigint", False),
    ("indice", "bigint", False),
    ("sre", "bigint", False),
    ("adresse", "string", False),
    ("npa", "bigint", False),
    ("commune", "string", False),
    ("destination", "string", False),
    ("agent_energetique_1", "string", False),
    ("quantite_agent_energetique_1", "double", False),
    ("unite_agent_energetique_1", "string", False),
    ("agent_energetique_2", "string", True),
    ("quantite_agent_energetique_2", "double", True),
    ("unite_agent_energetique_2", "string", True),
    ("agent_energetique_3", "string", True),
    ("quantite_agent_energetique_3", "double", True),
    ("unite_agent_energetique_3", "string", True),
    ("date_debut_periode", "timestamp_ntz", False),
    ("date_fin_periode", "timestamp_ntz", False),
    ("date_saisie", "timestamp_ntz", False),
    ("indice_moy2", "bigint", True),
    ("annees_concernees_moy_2", "string", True),
    ("indice_moy3", "bigint", True),
    ("annees_concernees_moy_3", "string", True),
    ("nbre_preneur", "bigint", True),
)

# Value columns spread over years by the wide (pivot) table, in this order.
PIVOT_VALUE_COLUMNS: tuple[str, ...] = (
    "nbre_preneur",
    "sre",
    "indice",
    "adresse",
    "date_debut_periode",
    "date_fin_periode",
    "agent_energetique_1",
    "quantite_agent_energetique_1",
    "unite_agent_energetique_1",
    "agent_energetique_2",
    "quantite_agent_energetique_2",
    "unite_agent_energetique_2",
    "agent_energetique_3",
    "quantite_agent_energetique_3",
    "unite_agent_energetique_3",
)

# Business bounds (inclusive) of the curated readings.
EGID_MIN, EGID_MAX = 10000, 999_999_999
ANNEE_MIN = 2000
NPA_MIN, NPA_MAX = 1000, 9999

# Default page size when layer metadata lacks it, and the key-list chunk size.
DEFAULT_STANDARD_MAX_RECORDS = 2000
DEFAULT_RECORD_FACTOR = 1.0
DEFAULT_KEY_CHUNK = 50
# -----------------------------------------------------------------------------

CURATED_COLUMNS: tuple[str, ...] = tuple(c for c, _, _ in CURATED_FIELDS)

_SPARK_TYPES = {
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def spark_type(name: str) -> T.DataType:
    return _SPARK_TYPES[name]

CURATED_SCHEMA = T.StructType(
    [T.StructField(c, _SPARK_TYPES[t], n) for c, t, n in CURATED_FIELDS]
)

# Raw attribute types as the layer serves them: ids and counts as numbers,
# EGID as a double, dates as epoch milliseconds.
RAW_TYPES: dict[str, str] = {
    "OBJECTID": "bigint",
    "EGID": "double",
    "ANNEE": "bigint",
    "INDICE": "bigint",
    "SRE": "bigint",
    "ADRESSE": "string",
    "NPA": "bigint",
    "COMMUNE": "string",
    "DESTINATION": "string",
    "AGENT_ENERGETIQUE_1": "string",
    "QUANTITE_AGENT_ENERGETIQUE_1": "double",
    "UNITE_AGENT_ENERGETIQUE_1": "string",
    "AGENT_ENERGETIQUE_2": "string",
    "QUANTITE_AGENT_ENERGETIQUE_2": "double",
    "UNITE_AGENT_ENERGETIQUE_2": "string",
    "AGENT_ENERGETIQUE_3": "string",
    "QUANTITE_AGENT_ENERGETIQUE_3": "double",
    "UNITE_AGENT_ENERGETIQUE_3": "string",
    "DATE_DEBUT_PERIODE": "bigint",
    "DATE_FIN_PERIODE": "bigint",
    "DATE_SAISIE": "bigint",
    "INDICE_MOY2": "bigint",
    "ANNEES_CONCERNEES_MOY_2": "string",
    "INDICE_MOY3": "bigint",
    "ANNEES_CONCERNEES_MOY_3": "string",
    "NBRE_PRENEUR": "bigint",
}

RAW_SCHEMA = T.StructType(
    [T.StructField(c, spark_type(t), True) for c, t in RAW_TYPES.items()]
)

# One geometry struct for every geometry kind: point (x, y), multipoint
# (one part), polyline paths and polygon rings (parts), optional wkid.
VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
GEOMETRY = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("parts", T.ArrayType(T.ArrayType(VERTEX))),
        T.StructField("wkid", T.IntegerType()),
    ]
)

# --- Fixed values: layer protocol field types -> Spark SQL types. -----------
FIELD_TYPES: dict[str, str] = {
    "esriFieldTypeSmallInteger": "smallint",
    "esriFieldTypeInteger": "int",
    "esriFieldTypeSingle": "float",
    "esriFieldTypeDouble": "double",
    "esriFieldTypeString": "string",
    "esriFieldTypeDate": "bigint",
    "esriFieldTypeOID": "bigint",
    "esriFieldTypeBlob": "binary",
    "esriFieldTypeRaster": "binary",
    "esriFieldTypeGUID": "string",
    "esriFieldTypeGlobalID": "string",
    "esriFieldTypeXML": "string",
    "esriFieldTypeBigInteger": "bigint",
    "esriFieldTypeDateOnly": "date",
    "esriFieldTypeTimeOnly": "string",
    "esriFieldTypeTimestampOffset": "timestamp",
}
# -----------------------------------------------------------------------------


def schema_from_fields(fields: list[dict]) -> T.StructType:
    """Attribute schema from a layer's ``fields`` list (name, type).

    Geometry fields are skipped (geometry is a separate column); unknown
    types fall back to string.
    """
    out = []
    for f in fields:
        ftype = f.get("type", "esriFieldTypeString")
        if ftype == "esriFieldTypeGeometry":
            continue
        out.append(
            T.StructField(f["name"], spark_type(FIELD_TYPES.get(ftype, "string")))
        )
    return T.StructType(out)


def field_type(dtype: T.DataType) -> str:
    """The layer's name for a Spark type (text for those it has none for)."""
    names = {spark: name for name, spark in reversed(FIELD_TYPES.items())}
    names["bigint"] = "esriFieldTypeBigInteger"
    return names.get(dtype.simpleString(), "esriFieldTypeString")
