"""Raw layer attributes -> curated columns: rename, ordered select, casts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.timestamps import ms_to_ntz
from tessera.schemas import CURATED_FIELDS


def transform(raw: DataFrame, keep: Iterable[str] = ("OBJECTID",)) -> DataFrame:
    """Rename upper -> lower case, select the curated columns, cast each.

    Integers and doubles are cast strictly (ANSI: a non-numeric string
    fails the job rather than turning into NULL), epoch-ms dates become
    ``timestamp_ntz``. Columns in ``keep`` that exist are carried along in
    lower case after the curated ones (the object id is the tie-break of
    keep-latest).
    """
    cols = []
    for name, typ, _nullable in CURATED_FIELDS:
        src = F.col(name.upper())
        value = ms_to_ntz(src.cast("bigint")) if typ == "timestamp_ntz" else src.cast(typ)
        cols.append(value.alias(name))
    cols += [F.col(c).alias(c.lower()) for c in keep if c in raw.columns]
    return raw.select(*cols)
