"""Rule validation of curated readings: a valid / invalid split and counts.

Rules are a plain table of name -> boolean SQL expression. A rule that
evaluates to NULL does not fail a row; missing values are caught by the
separate ``<column>|nullability`` rules instead. Every rule is evaluated on
every row, so one row can fail several rules. All of it is a projection
(no shuffle); only the per-rule counts aggregate, with map-side combine.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schemas import (
    ANNEE_MIN,
    CURATED_FIELDS,
    CURATED_SCHEMA,
    EGID_MAX,
    EGID_MIN,
    NPA_MAX,
    NPA_MIN,
)

FAILED = "failed_rules"


def default_annee_max() -> int:
    """Upper bound of valid years: next calendar year (taken from the clock)."""
    return datetime.date.today().year + 1


def business_rules(annee_max: int | None = None) -> list[tuple[str, str]]:
    """(name, expression) of the business rules, in declaration order."""
    amax = default_annee_max() if annee_max is None else int(annee_max)
    return [
        ("egid_valide", f"egid BETWEEN {EGID_MIN} AND {EGID_MAX}"),
        ("indice_positif", "indice > 0"),
        ("sre_positive", "sre > 0"),
        ("annee_valide", f"annee BETWEEN {ANNEE_MIN} AND {amax}"),
        ("npa_suisse", f"npa BETWEEN {NPA_MIN} AND {NPA_MAX}"),
        ("periode_coherente", "date_debut_periode < date_fin_periode"),
    ]


def nullability_rules() -> list[tuple[str, str]]:
    return [(f"{c}|nullability", f"{c} IS NOT NULL") for c, _, n in CURATED_FIELDS if not n]


def all_rules(annee_max: int | None = None) -> list[tuple[str, str]]:
    return nullability_rules() + business_rules(annee_max)


def failed_rules_column(annee_max: int | None = None) -> Column:
    """ARRAY<STRING> of the names of the rules a row fails, in rule order."""
    checks = [
        F.when(~F.coalesce(F.expr(expr), F.lit(True)), F.lit(name))
        for name, expr in all_rules(annee_max)
    ]
    return F.array_compact(F.array(*checks))


def with_failed_rules(df: DataFrame, annee_max: int | None = None) -> DataFrame:
    return df.withColumn(FAILED, failed_rules_column(annee_max))


@dataclass(frozen=True)
class Split:
    valid: DataFrame
    invalid: DataFrame


def split(checked: DataFrame) -> Split:
    """Valid rows (no failed rule, without the rule column) and invalid rows."""
    ok = F.size(FAILED) == 0
    return Split(valid=checked.where(ok).drop(FAILED), invalid=checked.where(~ok))


def rule_counts(checked: DataFrame) -> DataFrame:
    """(rule, n): failures per rule, only rules that failed at least once."""
    return (
        checked.select(F.explode(FAILED).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def check_raw_types(raw: DataFrame) -> list[str]:
    """Raw columns whose type can't become the curated one: text must be text, numbers and dates numbers or text."""
    have = {f.name: f.dataType for f in raw.schema.fields}
    problems = []
    for name, curated, _ in CURATED_FIELDS:
        got = have.get(name.upper())
        if got is None:
            problems.append(f"{name.upper()}: missing")
        elif not isinstance(got, T.StringType) and (curated == "string" or not isinstance(got, T.NumericType)):
            problems.append(f"{name.upper()}|dtype: {got.simpleString()} can't be read as {curated}")
    return problems


def check_types(df: DataFrame, expected=CURATED_SCHEMA) -> list[str]:
    """Column type mismatches against the declared schema (no coercion)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in have:
            problems.append(f"{f.name}: missing")
        elif have[f.name] != f.dataType:
            problems.append(
                f"{f.name}|dtype: expected {f.dataType.simpleString()}, "
                f"got {have[f.name].simpleString()}"
            )
    return problems
