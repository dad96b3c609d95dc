"""Column contract of raw layer attributes.

The contract compares the attribute names the layer actually returned with
the expected names. With untyped (JSON) attributes the names are read from
the data itself -- the distinct keys over every feature -- because parsing
with a declared schema would silently drop unexpected keys. The distinct is
a partial + final aggregation, so the shuffle carries at most one row per
key and map partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schemas import API_COLUMNS


class ContractError(ValueError):
    pass


def contract_diff(
    returned: DataFrame, expected: Sequence[str] = API_COLUMNS, spark: SparkSession | None = None
) -> DataFrame:
    """(column_name, status) for names missing from or unexpected in ``returned``.

    ``returned`` has one column ``name``. The expected side is the contract
    (a few dozen names), joined by a full outer join on the name.
    """
    spark = spark or returned.sparkSession
    exp = spark.createDataFrame([(c,) for c in expected], "name string").withColumn("_e", F.lit(1))
    got = returned.select("name").distinct().withColumn("_r", F.lit(1))
    j = exp.join(got, "name", "full_outer")
    return j.where(F.col("_e").isNull() | F.col("_r").isNull()).select(
        F.col("name").alias("column_name"),
        F.when(F.col("_r").isNull(), "missing").otherwise("unexpected").alias("status"),
    )


def require_contract(returned: DataFrame, expected: Sequence[str] = API_COLUMNS) -> None:
    """Raise :class:`ContractError` if the names in ``returned`` (column ``name``) break the contract."""
    drift = contract_diff(returned, expected).orderBy("column_name").collect()  # a name each, at most
    if drift:
        raise ContractError("the layer breaks the column contract: " + ", ".join(f"{r.column_name} is {r.status}" for r in drift))
