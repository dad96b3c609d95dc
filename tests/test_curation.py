import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators.contract import ContractError, require_contract
from tessera.operators.dedup import dedup_counts, keep_latest
from tessera.operators.keys import NoValidKeys, key_chunks, missing_keys, normalize_keys
from tessera.operators.pivot import pivot_years, valid_years
from tessera.operators.rules import check_types, rule_counts, split, with_failed_rules
from tessera.plans.curation import InvalidRows, NoData, curate
from tessera.schemas import API_COLUMNS, CURATED_SCHEMA
from tessera.sources.fixtures import raw_readings

SF = "/root/testdata/sf0.001"


def _rows(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


def test_keep_latest_null_first_and_tie(spark):
    t = dt.datetime(2024, 1, 1)
    df = _rows(
        spark,
        [(1, 2020, t, 10), (1, 2020, None, 11), (1, 2021, t, 12), (1, 2021, t, 13),
         (2, 2020, t, 14), (2, 2020, t + dt.timedelta(days=1), 15)],
        "egid long, annee long, date_saisie timestamp_ntz, objectid long",
    )
    got = {(r.egid, r.annee): r.objectid for r in keep_latest(df).collect()}
    assert got == {(1, 2020): 11, (1, 2021): 13, (2, 2020): 15}
    last = {(r.egid, r.annee): r.objectid for r in keep_latest(df, nulls="last").collect()}
    assert last[(1, 2020)] == 10
    c = dedup_counts(df).collect()[0]
    assert (c.n_before, c.n_after, c.n_removed) == (6, 3, 3)


def test_rules_null_does_not_fail_but_nullability_does(spark):
    raw = raw_readings(spark, SF)
    cur = curate(raw, annee_max=2027)
    counts = {r.rule: r.n for r in cur.rule_counts.collect()}
    # NULL date_saisie fails only its nullability rule, never periode_coherente by itself
    assert counts.get("date_saisie|nullability", 0) > 0
    assert all(n > 0 for n in counts.values())
    n_valid = cur.valid.count()
    n_invalid = cur.invalid.count()
    assert n_valid + n_invalid == cur.deduped.count()
    assert cur.valid.columns == [f.name for f in CURATED_SCHEMA.fields]
    assert check_types(cur.valid) == []


def test_rule_split_one_row_many_rules(spark):
    t = dt.datetime(2024, 1, 1)
    row = dict(egid=5, annee=1990, indice=-1, sre=0, adresse="a", npa=10, commune=None,
               destination="d", agent_energetique_1="x", quantite_agent_energetique_1=1.0,
               unite_agent_energetique_1="u", date_debut_periode=t, date_fin_periode=t,
               date_saisie=t)
    cols = [f for f in CURATED_SCHEMA.fields]
    data = [tuple(row.get(f.name) for f in cols)]
    df = spark.createDataFrame(data, CURATED_SCHEMA.__class__(
        [f.__class__(f.name, f.dataType, True) for f in cols]))
    checked = with_failed_rules(df, 2027)
    failed = checked.collect()[0]["failed_rules"]
    assert failed == ["commune|nullability", "egid_valide", "indice_positif", "sre_positive",
                      "annee_valide", "npa_suisse", "periode_coherente"]
    parts = split(checked)
    assert parts.valid.count() == 0 and parts.invalid.count() == 1
    assert {r.rule for r in rule_counts(checked).collect()} == set(failed)


def test_strict_mode_raises(spark):
    with pytest.raises(InvalidRows):
        curate(raw_readings(spark, SF), annee_max=2027, mode="strict")


def test_unknown_key_raises_no_data(spark):
    keys = spark.createDataFrame([(999999999,)], "egid long")
    with pytest.raises(NoData):
        curate(raw_readings(spark, SF), keys=keys, annee_max=2027, mode="strict")


def test_contract_names_each_difference(spark):
    def names(cols):
        return spark.createDataFrame([(c,) for c in cols], "name string")

    with pytest.raises(ContractError) as e:
        require_contract(names([c for c in API_COLUMNS if c not in ("NPA", "ANNEE")] + ["ZZZ", "AAA"]))
    assert "AAA is unexpected, ANNEE is missing, NPA is missing, ZZZ is unexpected" in str(e.value)
    require_contract(names(API_COLUMNS))


def test_raw_types_are_checked_before_any_cast(spark):
    raw = raw_readings(spark, SF)
    with pytest.raises(TypeError, match="ADRESSE"):
        curate(raw.withColumn("ADRESSE", F.lit(5)))
    with pytest.raises(TypeError, match="SRE"):
        curate(raw.withColumn("SRE", F.current_date()))


def test_strict_mode_curates_once(spark):
    """What the probes and the wide table read is the stored result: no keep-latest in their plans."""
    raw = raw_readings(spark, SF)
    good = with_failed_rules(keep_latest(curate(raw, annee_max=2027).deduped), 2027).where("size(failed_rules) = 0")
    raw = raw.join(good.select(F.col("objectid").alias("OBJECTID")), "OBJECTID", "left_semi").select(*raw.columns)
    strict = curate(raw, annee_max=2027, mode="strict")
    for df in (strict.valid, strict.invalid, pivot_years(strict.valid, years=valid_years(2027))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "parquet" not in plan.lower()


def test_a_layer_that_drifted_is_refused(spark, scratch):
    from tessera.plans.curation import curate_layer
    from tessera.sources.fixture_pages import land_layer

    raw = raw_readings(spark, SF)
    for fmt in ("json", "pbf"):
        land_layer(raw.withColumnRenamed("NBRE_PRENEUR", "NB"), f"{scratch}/{fmt}", 500, fmt=fmt)
        with pytest.raises(ContractError, match="NBRE_PRENEUR is missing"):
            curate_layer(spark, path=f"{scratch}/{fmt}", response_format=fmt)


def test_normalize_keys(spark):
    df = spark.createDataFrame(
        [("1015052",), ("1015052",), ("not_an_int",), ("12.5",), ("12.0000001",), ("1015054",)], "egid string"
    )
    assert sorted(r.egid for r in normalize_keys(df).collect()) == [1015052, 1015054]
    bad = spark.createDataFrame([("not_an_int",)], "egid string")
    with pytest.raises(NoValidKeys):
        normalize_keys(bad)


def test_key_chunks_predicates(spark):
    keys = spark.createDataFrame([(k,) for k in [5, 3, 9, 1, 7]], "egid long")
    got = sorted((r.chunk, r.n_keys, r.predicate) for r in key_chunks(keys, 2).collect())
    assert got == [(0, 2, "EGID IN (1,3)"), (1, 2, "EGID IN (5,7)"), (2, 1, "EGID=9")]


def test_missing_keys(spark):
    keys = spark.createDataFrame([(1,), (2,), (3,)], "egid long")
    cur = spark.createDataFrame([(2, 2020)], "egid long, annee long")
    assert sorted(r.egid for r in missing_keys(keys, cur).collect()) == [1, 3]


def test_pages_of_a_curated_layer_are_opened_once(spark, scratch):
    """Contract, rows, counts and summary: each landed page file is opened by one read."""
    import os

    from tessera.plans.curation import curate_layer
    from tessera.sources.fixture_pages import land_layer

    raw = raw_readings(spark, SF)
    for fmt in ("json", "pbf"):
        root = f"{scratch}/{fmt}"
        land_layer(raw, root, 500, fmt=fmt)
        made = curate_layer(spark, path=root, response_format=fmt, annee_max=2027)
        folder = f"{root.removeprefix('file:')}/pages"
        for name in os.listdir(folder):  # a second read of any page would miss it
            os.unlink(f"{folder}/{name}")
        direct = curate(raw, annee_max=2027)
        assert sorted(map(str, made.valid.collect())) == sorted(map(str, direct.valid.collect()))
        assert made.invalid.count() == direct.invalid.count()
        for name in ("rule_counts", "dedup_counts"):
            assert sorted(map(str, getattr(made, name).collect())) == sorted(map(str, getattr(direct, name).collect()))
        assert made.summary().collect() == direct.summary().collect()


def test_stored_rows_are_computed_once(spark):
    """With store=True rows, rule counts and summary read the raw rows in one scan."""
    raw = raw_readings(spark, SF)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    made = curate(raw.mapInArrow(count, raw.schema), annee_max=2027, store=True)
    assert made.valid.count() + made.invalid.count() == made.deduped.count()
    assert made.rule_counts.count() > 5 and made.summary().collect()[0].n_valid == made.valid.count()
    assert seen.value == raw.count()


def test_pivot_plan_has_no_sorted_aggregate(spark):
    valid = curate(raw_readings(spark, SF), annee_max=2027).valid
    wide = pivot_years(valid, years=valid_years(2027))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning(egid") == 2  # keep-latest, then its few rows by building
    assert len(wide.columns) == 1 + 15 * 28
    gone = spark.createDataFrame([(1, 1990, 5), (2, 2001, 6)], "egid long, annee long, sre long")
    rows = {r.egid: r.asDict() for r in pivot_years(gone, values=["sre"], years=[2001, 2003]).collect()}
    assert rows == {1: {"egid": 1, "sre_2001": None, "sre_2003": None}, 2: {"egid": 2, "sre_2001": 6, "sre_2003": None}}


def test_pivot_names_and_order(spark):
    df = spark.createDataFrame(
        [(1, 2021, 5, "a"), (1, 2020, 4, "b"), (2, 2020, 3, "c")],
        "egid long, annee long, sre long, adresse string",
    )
    wide = pivot_years(df, values=["sre", "adresse"], years=[2021, 2020])
    assert wide.columns == ["egid", "adresse_2020", "adresse_2021", "sre_2020", "sre_2021"]
    one = pivot_years(df, values=["sre"], years=[2020, 2021])
    assert one.columns == ["egid", "sre_2020", "sre_2021"]
    rows = {r.egid: r for r in one.collect()}
    assert rows[1].sre_2021 == 5 and rows[2].sre_2021 is None
    assert pivot_years(df, values=["sre"]).columns == ["egid"] + [f"sre_{y}" for y in valid_years()]


def test_summary_counts(spark):
    keys = spark.createDataFrame([(9991,), (9992,), (1,)], "egid long")
    cur = curate(raw_readings(spark, SF), keys=keys, annee_max=2027)
    s = cur.summary().collect()[0]
    assert s.n_requested == 3
    assert s.n_egid <= 2
    assert sorted(r.egid for r in cur.missing_keys.collect())[0] == 1
    assert F is not None


def test_registered_wide_tables_keep_every_valid_year(spark, monkeypatch):
    """A valid reading of each year that the rules admit, up to the last, stays in the wide tables."""
    from tessera.plans import catalog

    raw = raw_readings(spark, SF)
    first = valid_years(2027)[0]
    moved = raw.withColumn("ANNEE", (F.lit(first) + F.col("OBJECTID").cast("long") % len(valid_years(2027))).cast(raw.schema["ANNEE"].dataType))
    monkeypatch.setattr(catalog, "raw_readings", lambda spark, sf_dir: moved)
    valid = curate(moved, annee_max=catalog.ANNEE_MAX).valid
    want = {(r.egid, r.annee): r.sre for r in valid.select("egid", "annee", "sre").collect()}
    assert {y for _, y in want} == set(valid_years(2027))
    for name in ("pivot_years", "curated_wide"):
        wide = catalog.QUERIES[name](spark, SF).collect()
        assert {(r.egid, y): r[f"sre_{y}"] for r in wide for y in valid_years(2027) if (r.egid, y) in want} == want
        assert {r.egid for r in wide} == {e for e, _ in want}
