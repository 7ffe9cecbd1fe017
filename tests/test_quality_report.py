"""Checks, audit rows and report measures."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.operators import check_catalogue as catalogue
from wattlake.operators import quality, report_measures
from wattlake.operators.describe import QUARTILES, describe, exact_percentiles, first_pass
from wattlake.operators.quality import Check
from wattlake.plans import daily, report
from wattlake.sources.stored_dimensions import StoredLocations
from wattlake.sources.versions import ConflictError, VersionedStore


def test_catalogue_counts():
    checks = catalogue.all_checks()
    assert len(checks) == len({(c.table, c.name) for c in checks}) == 131
    assert Counter(c.kind for c in checks) == {
        "not_null": 76, "unique": 7, "accepted_values": 11, "expression_is_true": 37,
    }
    assert sum(c.severity == "warn" for c in checks) == 9
    assert sum(bool(c.where) for c in checks) == 9
    by_schema = Counter(c.table.split(".")[0] for c in checks)
    assert by_schema == {"raw": 19, "staging": 43, "intermediate": 27, "marts": 42}


@pytest.fixture(scope="module")
def results(spark):
    table = spark.sql("""SELECT * FROM VALUES (1, 'a', 5), (1, 'b', -1), (2, 'z', NULL), (NULL, NULL, 7),
                         (NULL, 'a', -3) AS t(k, name, v)""")
    checks = [
        Check("s.t", "k", "not_null"), Check("s.t", "k", "unique"),
        Check("s.t", "name", "accepted_values", values=("a", "b")),
        Check("s.t", "v", "expression_is_true", predicate=">= 0", severity="warn"),
        Check("s.t", "v", "expression_is_true", predicate=">= 0", where="name = 'a'"),
        Check("s.t", "name", "expression_is_true", predicate="<> 'q'"),
    ]
    return quality.evaluate(table, checks), table, checks


def test_results(results):
    rows = [(r.check_type, r.scope, r.rows_checked, r.rows_failed, r.check_result) for r in results[0].collect()]
    assert sorted(rows) == [
        ("accepted_values", "", 5, 1, "failed"),
        ("expression_is_true", "", 5, 0, "passed"),
        ("expression_is_true", "", 5, 2, "warning"),
        ("expression_is_true", "name = 'a'", 2, 1, "failed"),
        ("not_null", "", 5, 2, "failed"),
        ("unique", "", 5, 1, "failed"),
    ]


def test_failing_rows(results):
    _, table, checks = results
    assert [tuple(r) for r in quality.failing_rows(table, checks[1]).collect()] == [(1, 2)]
    assert quality.failing_rows(table, checks[3]).count() == 2


def test_audit_rows(results):
    rows = quality.audit_rows(results[0], F.lit("2024-01-01").cast("timestamp_ntz"))
    assert rows.columns == schemas.CHECK_RESULT.fieldNames()
    assert {r.failure_percentage for r in rows.collect()} == {0.0, 20.0, 40.0, 50.0}


def test_empty_table_passes(spark, raw_eia):
    empty = raw_eia().limit(0)
    checks = [c for c in catalogue.all_checks() if c.table == catalogue.RAW_EIA]
    assert {r.check_result for r in quality.evaluate(empty, checks).collect()} == {"passed"}


def test_freshness(spark, raw_eia):
    raw = raw_eia({"ingestion_timestamp": dt.datetime(2024, 1, 1)}, {"ingestion_timestamp": dt.datetime(2024, 1, 2)})

    def status(hour: str, table=raw):
        return quality.freshness(table, F.lit(hour).cast("timestamp_ntz")).first().status

    assert status("2024-01-02 12:00:00") == "pass"
    assert status("2024-01-02 12:30:00") == "warn"
    assert status("2024-01-03 00:00:01") == "error"
    assert status("2024-01-02", raw.limit(0)) == "error"


def test_gates(spark):
    one, none = spark.range(100), spark.range(0)
    row = quality.row_count_gate({"raw_eia": one, "raw_enrichment": one}).first()
    assert (row.raw_eia_count, row.status) == (100, "pass")
    assert quality.row_count_gate({"a": one, "b": none}).first().status == "fail"
    assert quality.row_count_gate({"a": none, "b": none}).first().status == "fail"


def test_orphans_and_columns(spark):
    fact = spark.sql("SELECT * FROM VALUES (1), (2), (3) AS t(k)")
    assert [r.k for r in quality.orphans(fact, fact.filter("k < 3"), "k").collect()] == [3]
    assert quality.missing_columns(fact, ["k", "z"]) == ["z"]
    rows = quality.column_conformance("s.t", fact, ["k", "z"]).collect()
    assert [(r.column_name, r.is_present, r.rows_checked) for r in rows] == [("k", True, 3), ("z", False, 3)]


def test_run_row(spark):
    start = dt.datetime(2024, 1, 1)
    row = quality.run_row(
        spark, pipeline_name="p", run_status="success", start_time=start,
        end_time=start + dt.timedelta(seconds=90), rows_inserted=7,
    ).first()
    assert (row.duration_seconds, row.rows_inserted, row.rows_failed) == (90, 7, None)
    with pytest.raises(ValueError):
        quality.run_row(spark, rows=1)


def test_sums_and_bands(spark):
    rows = spark.sql("SELECT * FROM VALUES ('CA', 1000), ('CA', 1500), ('TX', 2000) AS t(location, mwh)")
    totals = {r.location: r.mwh for r in report_measures.sum_by_location(rows, "mwh").collect()}
    assert totals == {"CA": 2500, "TX": 2000}
    assert [r.location for r in report_measures.top(rows.groupBy("location").agg(F.sum("mwh").alias("mwh")), "mwh", 1).collect()] == ["CA"]


@pytest.fixture(scope="module")
def numbers(spark):
    """Skewed values with NULLs: one value holds a third of the rows."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 7 != 0, F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * F.col("id") % 9973)).alias("a"),
        (F.sqrt("id") - 50).alias("b"),
        F.lit(None).cast("int").alias("c"),
        F.when(F.col("id") == 3, 1.5).alias("d"),
    )


@pytest.mark.parametrize("accuracy", [100, 10_000, 100_000])
def test_describe_equals_pandas(numbers, accuracy):
    found = describe(numbers, ["a", "b", "c", "d"], accuracy).toPandas().set_index("column")
    wanted = numbers.toPandas().astype(float).describe().T
    for column in "abd":
        for ours, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min",
                             "p25": "25%", "p50": "50%", "p75": "75%", "max": "max"}.items():
            left, right = found.loc[column, ours], wanted.loc[column, theirs]
            assert (pd.isna(left) and pd.isna(right)) or left == pytest.approx(right, rel=1e-12), (column, ours)
    assert found.loc["c", "count"] == 0 and pd.isna(found.loc["c", "p50"])


def test_edge_percentiles(numbers):
    edges = {"p0": 0.0, "p1": 0.0001, "p100": 1.0}
    ranges = first_pass(numbers, ["b"], edges, 100)
    found = {r.name: r.value for r in exact_percentiles(numbers, ["b"], ranges, edges).collect()}
    wanted = numbers.select("b").toPandas().b.quantile([0.0, 0.0001, 1.0]).tolist()
    assert [found["p0"], found["p1"], found["p100"]] == pytest.approx(wanted, rel=1e-12)
    assert set(QUARTILES) == {"p25", "p50", "p75"}


def test_percentiles_of_hard_columns(spark):
    """Values over all magnitudes, infinite ones, neighbours in the last bit, one value only."""
    rng = random.Random(12)
    huge = [rng.choice([-1, 1]) * 2.0 ** rng.randint(-1000, 1000) for _ in range(3001)]
    close = [1.0 + rng.randint(0, 40) * 2**-52 for _ in range(3001)]
    odd = [rng.choice([float("inf"), -float("inf"), float("nan"), None, 0.0, 1.0, 2.0]) for _ in range(3001)]
    frame = spark.createDataFrame(list(zip(huge, close, odd, [7.0] * 3001)), "h double, c double, o double, s double").repartition(6)
    wanted = {}
    for name, values in {"h": huge, "c": close, "o": odd, "s": [7.0] * 3001}.items():
        own = sorted(v for v in values if v is not None and v == v)
        for q, p in QUARTILES.items():
            at = p * (len(own) - 1)
            low, high = own[math.floor(at)], own[math.ceil(at)]
            wanted[name, q] = low if low == high else low + (high - low) * (at - math.floor(at))
    # Also from intervals that miss the ranks, and from such that hold everything.
    for accuracy, spoil in ((100, False), (10_000, False), (100, True)):
        ranges = first_pass(frame, list("hcos"), QUARTILES, accuracy)
        if spoil:
            ranges = ranges.withColumns({f"{end}_{q}": F.col("min") for q in QUARTILES for end in ("lo", "hi")})
        found = exact_percentiles(frame, list("hcos"), ranges, QUARTILES, accuracy)
        assert {(r.column, r.name): r.value for r in found.collect()} == wanted


def test_daily_flow_with_new_locations(spark, raw_eia, raw_enrichment, tmp_path):
    path = str(tmp_path)
    known, new = {"location": "CA"}, {"location": "US-ZZ", "location_type": "region", "energy_source": "coal"}
    undated = {"location": "US-YY", "period": "soon"}
    daily.run(spark, raw_eia(known, new, undated), raw_enrichment({}), path, new_locations=True)
    locations = StoredLocations(VersionedStore(spark, f"{path}/dimensions"))
    before = locations.read()
    added = before.where("location_key > 10").collect()
    assert before.count() == 11 and [(r.location_key, r.location_name) for r in added] == [(11, added[0].location_code)]
    mart = spark.read.parquet(f"{path}/fct_energy_metrics")
    assert {r.location_key for r in mart.collect()} >= {11} and mart.count() == 2
    # A later batch keeps the keys and adds after them; the seeds alone drop what they do not know.
    again = daily.run(
        spark, raw_eia(new, {"location": "US-AA", "location_type": "region"}), raw_enrichment({}), path,
        new_locations=True,
    )
    keys = {r.location_code: r.location_key for r in locations.read().collect()}
    assert keys[added[0].location_code] == 11 and sorted(keys.values()) == list(range(1, 13))
    assert {r.location for r in again["renewable_by_location"].collect()} == {"LOC_11", "LOC_12"}


def test_locations_grow_once_and_conflicts_change_nothing(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    locations = StoredLocations(store)
    assert locations.read().count() == 10
    rows = spark.sql("""SELECT * FROM VALUES ('b', 'x'), ('a', 'z'), ('a', 'y'), (' ', 'x'), (NULL, 'x'), ('US', 'x')
                        AS t(location, location_type)""")
    assert locations.grow(rows) == 2 and locations.grow(rows) == 0
    new = {r.location_code: (r.location_key, r.location_type) for r in locations.read().where("location_key > 10").collect()}
    assert new == {"a": (11, "y"), "b": (12, "x")}
    stale = store.snapshot()
    assert locations.grow(spark.sql("SELECT 'c' AS location, 'x' AS location_type")) == 1
    store.snapshot, newest = lambda: stale, store.snapshot
    with pytest.raises(ConflictError):
        locations.grow(spark.sql("SELECT 'd' AS location, 'x' AS location_type"))
    store.snapshot = newest
    assert sorted(r.location_key for r in locations.read().collect()) == list(range(1, 14))
    assert locations.grow(rows.limit(0)) == 0


def test_daily_flow(spark, raw_eia, raw_enrichment, tmp_path):
    eia = raw_eia({"value": 60}, {"energy_source": "coal", "value": 40}, {"location": "TX", "energy_source": "hydro"})
    enrichment = raw_enrichment({}, {"location": "US-TX", "temperature_avg": 200})
    path = str(tmp_path)
    tables = daily.run(spark, eia, enrichment, path)
    bands = {r.location: (r.renewable_percentage, r.band) for r in tables["renewable_by_location"].collect()}
    assert bands == {"LOC_6": (60.0, "green"), "LOC_7": (100.0, "green")}
    audit = spark.read.parquet(path + "/data_quality_checks")
    assert audit.count() == 131
    failed = {(r.table_name, r.check_name) for r in audit.filter("check_result <> 'passed'").collect()}
    assert failed == {
        ("stg_enrichment", "expression_is_true_stg_enrichment_temperature_fahrenheit"),
        ("fct_energy_metrics", "expression_is_true_fct_energy_metrics_avg_temperature_fahrenheit"),
    }
    run = spark.read.parquet(path + "/pipeline_runs").first()
    assert (run.run_status, run.rows_inserted) == ("success", 2)
    figures = {r.metric: r.value for r in tables["summary"].collect()}
    assert figures["total_records"] == 2 and figures["locations_at_least_half_renewable"] == 2
    assert figures["first_date"] == 20240101
    trend = {(str(r.date), r.location): r.total_generation_mwh for r in tables["generation_trend"].collect()}
    assert len(trend) == len(report.SEED_LABELS) and trend["2024-01-01", "LOC_1"] == 0
