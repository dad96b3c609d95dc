"""Requested building keys: normalisation, chunked predicates, scan, coverage.

* ``normalize_keys``: any key column -> distinct BIGINT keys; values that are
  not integers are dropped (``try_cast``), none left is an error.
* ``key_chunks``: keys in ascending order cut into chunks of ``size`` with the
  predicate text a remote layer is queried with (``EGID IN (..)`` or
  ``EGID=..``); groups are bounded by ``size``.
* ``key_scan``: layer rows of the requested keys (left semi join).
* ``missing_keys``: requested keys with no row (left anti join).

Joins are plain equi-joins; Catalyst broadcasts the key side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and falls back
to a shuffle join otherwise, so a key list of any size works.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.indexing import dense_index
from tessera.functions.strict import whole_number
from tessera.schemas import DEFAULT_KEY_CHUNK


class NoValidKeys(ValueError):
    pass


def normalize_keys(keys: DataFrame, column: str = "egid", check: bool = True) -> DataFrame:
    """Distinct integer keys as ``egid BIGINT``; non-integers are dropped.

    A value counts as an integer when it is integral: ``'12'`` and ``12.0``
    pass, ``'12.5'`` and ``'abc'`` do not. With ``check`` an empty result
    raises :class:`NoValidKeys` (one ``limit(1)`` probe, not a count).
    """
    out = (
        keys.select(whole_number(F.col(column).cast("string")).alias("egid"))
        .where(F.col("egid").isNotNull())
        .distinct()
    )
    if check and not out.limit(1).collect():
        raise NoValidKeys("no valid key: every requested key must be an integer")
    return out


def key_chunks(keys: DataFrame, size: int = DEFAULT_KEY_CHUNK, field: str = "EGID") -> DataFrame:
    """(chunk, n_keys, predicate) with keys ascending, ``size`` keys per chunk."""
    if size < 1:
        raise ValueError("chunk size must be >= 1")
    idx = dense_index(keys.select("egid"), ["egid"], "_i")
    per_chunk = idx.groupBy(F.floor(F.col("_i") / size).cast("bigint").alias("chunk")).agg(
        F.array_sort(F.collect_list("egid")).alias("_ks")
    )
    n = F.size("_ks")
    listed = F.array_join(F.transform("_ks", lambda k: k.cast("string")), ",")
    predicate = F.when(n > 1, F.concat(F.lit(f"{field} IN ("), listed, F.lit(")"))).otherwise(
        F.concat(F.lit(f"{field}="), F.element_at("_ks", 1).cast("string"))
    )
    return per_chunk.select("chunk", n.cast("bigint").alias("n_keys"), predicate.alias("predicate"))


def key_scan(layer: DataFrame, keys: DataFrame, on: Column | str = "EGID") -> DataFrame:
    """Rows of ``layer`` whose key is requested (left semi join on the key)."""
    col = F.col(on) if isinstance(on, str) else on
    k = keys.select(F.col("egid").alias("_k"))
    return layer.join(k, col.cast("bigint") == F.col("_k"), "left_semi")


def missing_keys(keys: DataFrame, curated: DataFrame) -> DataFrame:
    """Requested keys with no curated row (left anti join on ``egid``)."""
    return keys.select("egid").join(curated.select("egid"), "egid", "left_anti")
