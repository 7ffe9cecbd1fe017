"""Staging, combined and fact models on hand-made rows, and their join strategies."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from wattlake.functions import scalar
from wattlake.operators import aggregates, dimensions, joins, report_measures
from wattlake.plans import combined, fact, refresh, report, staging
from wattlake.sources import scans


def _rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_generation_rule_and_null_series(raw_eia):
    raw = raw_eia(
        {}, {"energy_source": None}, {"value": None}, {"value": -1}, {"value": 0},
        {"series_id": "elec.SALES.x"}, {"series_id": "Consumption"}, {"series_id": "a.revenue"},
        {"series_id": None}, {"period": "2024"}, {"location": None}, {"period": "2024-13"},
    )
    assert [r[0] for r in _rows(staging.stage_generation(raw), "source_id")] == [1, 5]


def test_consumption_rule(raw_eia):
    raw = raw_eia(
        {"sector": "residential"},                                   # sector: also a generation row
        {"series_id": "ELEC.SALES", "energy_source": None},
        {"series_id": "ELEC.GEN"},                                   # no sign of consumption
        {"series_id": None, "sector": "Industrial "},                # NULL series, kept by sector
        {"series_id": None},
        {"series_id": "GENERATION.SALES"},                           # generation without sector
        {"series_id": "GENERATION.SALES", "sector": "commercial"},
        {"sector": "residential", "value": -2},
    )
    staged = staging.stage_consumption(raw)
    assert _rows(staged.na.fill("-", ["sector"]), "source_id", "sector") == [
        (1, "residential"), (2, "-"), (4, "industrial"), (7, "commercial"),
    ]


def test_enrichment_keeps_implausible_temperatures(raw_enrichment):
    raw = raw_enrichment(
        {"temperature_avg": 400}, {"temperature_avg": None}, {"population": None},
        {"gdp_per_capita": None, "industrial_activity_index": None}, {"period": "x"},
        {"location": " us-ca "},
    )
    staged = staging.stage_enrichment(raw)
    assert _rows(staged, "source_id", "location") == [(1, "US-CA"), (4, "US-CA"), (6, "US-CA")]
    first = staged.orderBy("source_id").first()
    assert first.temperature_fahrenheit == D(400) and first.temperature_unit == "FAHRENHEIT"


@pytest.fixture(scope="module")
def small(raw_eia, raw_enrichment):
    """Two generation months in CA, one in TX, consumption only in NY, US dropped by the fact."""
    eia = raw_eia(
        {"energy_source": "solar", "value": 30}, {"energy_source": "coal", "value": 60},
        {"energy_source": "natural gas", "value": 10},
        {"energy_source": "wind", "value": 5, "location_type": "region"},
        {"energy_source": "nuclear", "value": 7, "location": "TX", "sector": "residential"},
        {"period": "2024-02", "value": 0},
        {"location": "NY", "energy_source": None, "sector": "commercial", "series_id": "SALES"},
        {"location": "US", "location_type": "national", "value": 1},
        {"series_id": "SALES", "energy_source": None, "sector": "electric power", "value": 21},
    )
    enrichment = raw_enrichment({}, {"population": 4_000_000}, {"location": "US-FL"})
    return eia, enrichment


def test_combined(small):
    rows = combined.combine(*small).collect()
    by = {(r.location, r.location_type, str(r.period_date), r.population): r for r in rows}
    # Two types of one place share the key and both meet both enrichment rows.
    assert len(rows) == 7
    state = by["US-CA", "state", "2024-01-01", 2_000_000]
    assert state.total_generation_mwh == D(100) and state.renewable_percentage == 30.0
    assert (state.other_generation_mwh, state.fossil_generation_mwh) == (D(10), D(60))
    assert state.energy_source_count == 3 and state.sector_count == 1
    assert state.generation_to_consumption_ratio == round(100 / 21, 4)
    assert state.generation_per_capita_mwh == 50.0
    region = by["US-CA", "region", "2024-01-01", 4_000_000]
    assert region.energy_combined_key == state.energy_combined_key
    assert region.total_consumption_mwh == D(21)
    zero = by["US-CA", "state", "2024-02-01", None]
    assert zero.renewable_percentage == 0.0 and zero.total_consumption_mwh is None
    assert not zero.has_consumption_data and not zero.has_enrichment_data
    tx = by["US-TX", "state", "2024-01-01", None]
    # A generation record with a sector counts on both sides.
    assert tx.total_consumption_mwh == D(7) and tx.generation_to_consumption_ratio == 1.0
    assert not any(r.location == "US-NY" for r in rows)


def test_fact(small):
    rows = fact.build(*small).collect()
    assert len(rows) == 4
    ca = [r for r in rows if r.time_key == 20240101 and r.location_key == 6]
    assert len({r.metric_key for r in ca}) == 1 and len(ca) == 2  # repeated by enrichment
    assert ca[0].total_generation_mwh == D(105) and ca[0].wind_generation_mwh == D(5)
    assert ca[0].other_generation_mwh == D(10) and ca[0].fossil_generation_mwh == D(60)
    assert ca[0].net_generation_mwh == D(84)
    assert {r.population for r in ca} == {2_000_000, 4_000_000}
    feb = next(r for r in rows if r.time_key == 20240201)
    assert feb.total_consumption_mwh == 0 and feb.population is None
    assert {r.location_key for r in rows} == {6, 7}


def test_one_scan_equals_staged_joins(small):
    generation, consumption = (f(small[0]) for f in (staging.stage_generation, staging.stage_consumption))
    enrichment = staging.stage_enrichment(small[1])
    staged = combined.combine_staged(generation, consumption, enrichment)
    assert combined.combine(*small).exceptAll(staged).isEmpty()
    assert staged.exceptAll(combined.combine(*small)).isEmpty()
    other = fact.build_staged(generation, consumption, enrichment)
    assert fact.build(*small).exceptAll(other).isEmpty()
    assert other.exceptAll(fact.build(*small)).isEmpty()


def test_fanout_join_is_exact_either_way(spark):
    """One key holds most rows, among them exact copies; some keys have no match, one is NULL."""
    left = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (3, 'c'), (3, 'd'), (NULL, 'e') AS t(k, name)")
    right = spark.range(5000).select(
        F.when(F.col("id") % 10 < 8, 1).when(F.col("id") % 10 == 8, 3).otherwise(9).alias("k"),
        F.col("id").alias("rid"),
        (F.col("id") % 3).alias("x"),
    )
    expected = left.join(right.drop("rid"), "k", "left")
    # Parts of three rows are so many that some are empty; in the last form no key is hot.
    for rows, part in ((5, 100), (None, 100), (None, 3), (joins.BROADCAST_ROWS + 1, 7), (None, 10**6)):
        joined = joins.left_join_fanout(left, right, ["k"], "rid", left_rows=rows, part_rows=part)
        assert joined.columns == expected.columns
        assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()


def test_fanout_join_of_null_ids_and_null_keys(spark):
    left = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (NULL, 'c') AS t(k, name)")
    right = spark.range(300).selectExpr("IF(id < 200, 1, NULL) AS k", "CAST(NULL AS LONG) AS rid", "id % 50 AS x")
    joined = joins.left_join_fanout(left, right, ["k"], "rid", part_rows=10)
    expected = left.join(right.drop("rid"), "k", "left")
    assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    # Rows without an id are spread by their other values.
    hot = joins.hot_keys(right, ["k"], 10)[1]
    assert joins.spread_rows(right.where("k = 1"), ["k"], hot).select("_part").distinct().count() > 10
    empty = joins.left_join_fanout(left, right.limit(0), ["k"], "rid")
    assert _rows(empty.na.fill("-", ["name"]), "name", "x") == [("a", None), ("b", None), ("c", None)]


def test_only_hot_keys_are_spread_and_in_proportion(spark):
    """A key with half of the rows, one with a tenth, and many with four rows each."""
    right = spark.range(40_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN -1 WHEN id % 10 = 1 THEN -2 ELSE id DIV 10 END AS k", "id AS rid"
    )
    parts, hot = joins.hot_keys(right, ["k"], part_rows=1000)
    assert sorted((r["k"], r["_parts"]) for r in hot.collect()) == [(-2, 4), (-1, 20)]
    assert parts.count() == 4002
    spread = joins.spread_rows(right, ["k"], hot)
    sizes = spread.where("k = -1").groupBy("_part").count().collect()
    assert len(sizes) == 20 and max(r["count"] for r in sizes) < 1200
    assert spread.where("k >= 0 AND _part <> 0").isEmpty()
    # However small a part, a key with at most a tenth of the rows is not hot if ten may be.
    assert [r["k"] for r in joins.hot_keys(right, ["k"], 1, most=10)[1].collect()] == [-1]


def test_fanout_join_spreads_half_of_the_rows_over_all_tasks(spark):
    left = spark.sql("SELECT * FROM VALUES (-1, 'hot'), (3, 'cold') AS t(k, name)")
    right = spark.range(40_000).selectExpr("IF(id % 2 = 0, -1, id) AS k", "id AS rid", "id AS x")
    # All tasks of a shuffle, as if none was merged for being small.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = joins.left_join_fanout(left, right, ["k"], "rid", part_rows=250)
        rows = joined.where("k = -1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(rows) == 8 and sum(r["count"] for r in rows) == 20_000
    assert max(r["count"] for r in rows) < 20_000 / 3


def test_bounded_rows(spark):
    assert joins.bounded_rows(spark.range(10), 10) == 10
    assert joins.bounded_rows(spark.range(11), 10) is None
    assert fact.Dimensions(dimensions.dim_time(spark), dimensions.dim_location(spark)).key_bound() == 40_180


def test_latest_by(spark):
    rows = spark.sql("""SELECT * FROM VALUES (1, 10, 1, 'old'), (1, 20, 2, 'tie'), (1, 20, 3, 'new'),
                        (2, 5, 4, NULL) AS t(k, ts, id, v)""")
    latest = joins.latest_by(rows, ["k"], ["ts", "id"])
    assert _rows(latest.na.fill("-"), "k", "id", "v") == [(1, 3, "new"), (2, 4, "-")]


def test_total_is_conserved(small):
    """Without fan-out the fact holds every staged MWh of a known place."""
    generation = staging.stage_generation(small[0])
    codes = [row[0] for row in dimensions.LOCATIONS]
    wanted = generation.filter(F.col("location").isin(codes)).agg(F.sum("generation_mwh")).first()[0]
    base = fact.base_rows(small[0], fact.Dimensions.seeds(generation.sparkSession))
    parts = aggregates.SOURCE_MEASURES + ["other_generation_mwh"]
    total, by_source = base.agg(
        F.sum("total_generation_mwh"), F.sum(sum((F.col(c) for c in parts), F.lit(0)))
    ).first()
    assert total == by_source == wanted


def test_calendar(spark):
    days = dimensions.dim_time(spark)
    assert days.count() == dimensions.CALENDAR_DAYS
    row = days.filter("date = '2021-01-02'").first()  # a Saturday of the last ISO week of 2020
    assert (row.time_key, row.month_name, row.day_name) == (20210102, "January  ", "Saturday ")
    assert (row.day_of_week, row.week_of_year, row.is_weekend, row.is_holiday) == (6, 53, True, False)
    assert days.select("date").distinct().count() == dimensions.CALENDAR_DAYS


def test_seeds(spark):
    assert _rows(dimensions.dim_location(spark), "location_key", "location_code")[5] == (6, "US-CA")
    sources = dimensions.dim_energy_source(spark)
    assert sources.filter("is_renewable").count() == 3 and sources.count() == 7


def test_insert_if_absent(spark):
    old = spark.sql("SELECT * FROM VALUES ('a'), ('b') AS t(code)")
    new = spark.sql("SELECT * FROM VALUES ('b'), ('c'), ('c') AS t(code)")
    assert _rows(dimensions.insert_if_absent(old, new, ["code"]), "code") == [("c",)]


def test_sink_order_of_nulls(spark):
    rows = spark.sql("""SELECT * FROM VALUES (DATE'2024-01-01', NULL), (DATE'2024-01-01', 'a'),
                        (NULL, 'x'), (DATE'2024-02-01', 'b') AS t(period_date, sector)""")
    ordered = [tuple(r) for r in staging.newest_first(rows, ["sector"]).collect()]
    jan, feb = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    assert ordered == [(None, "x"), (feb, "b"), (jan, "a"), (jan, None)]


def test_refresh_equals_rebuild(spark, small, raw_eia, raw_enrichment, tmp_path):
    path = str(tmp_path / "mart")
    refresh.rebuild(fact.build(*small), path)
    late = raw_eia({"id": 900, "value": 3, "period": "2024-02"}, {"id": 901, "period": "2024-03"})
    more = raw_enrichment({"id": 900, "period": "2024-02-01"})
    eia, enrichment = small[0].union(late), small[1].union(more)
    months = refresh.changed_months(late, more)
    assert months == [202402, 202403]
    refresh.refresh(eia, enrichment, months, path)
    refresh.refresh(eia, enrichment, months, path)  # once more changes nothing
    stored = spark.read.parquet(path).select(*fact.OUTPUT_COLUMNS)
    whole = fact.build(eia, enrichment)
    assert stored.exceptAll(whole).isEmpty() and whole.exceptAll(stored).isEmpty()


def test_ratios_are_exact_on_ties(values):
    x, y = F.col("x").cast("decimal(24,7)"), F.col("y").cast("decimal(24,7)")
    names = "x double, y double"
    ties = [(23.0, 160.0), (41.0, 160.0), (51.0, 160.0), (87.0, 160.0)]
    assert values(scalar.share_percent(x, y), names, *ties) == [14.38, 25.63, 31.88, 54.38]
    assert values(scalar.per_million_people(x, F.col("y").cast("long")), names, (397.0, 1.6e6)) == [248.13]


def test_changed_months_follow_the_given_calendar(spark, raw_eia):
    late = raw_eia({"id": 1, "period": "2019-05"}, {"id": 2, "period": "2031-02"}, {"id": 3, "period": "2024-01"})
    assert refresh.changed_months(late) == [202401]
    days = spark.sql("SELECT explode(sequence(date'2019-01-01', date'2031-12-31')) AS date")
    dims = fact.Dimensions(days, spark.range(1), 5000, 1)
    assert refresh.changed_months(late, dims=dims) == [201905, 202401, 203102]


def test_annual_and_quarterly_ranges_keep_their_bounds(raw_eia):
    rows = raw_eia(*({"period": p} for p in ("2020", "2021", "2022", "2021-Q1", "2021-Q4", "2022-Q2", "2022-Q3")))
    found = lambda f: sorted(r.period for r in scans.fetch_period_range(rows, "2021-01", "2022-06", frequency=f).collect())
    assert found("annual") == ["2021", "2022"] and found("quarterly") == ["2021-Q1", "2021-Q4", "2022-Q2"]
    with pytest.raises(ValueError):
        found("weekly")


def test_trend_keeps_locations_beyond_the_seeds(spark):
    rows = spark.createDataFrame(
        [(dt.date(2024, 1, 1), f"LOC_{k}", float(k)) for k in (10, 11, 12)], "date date, location string, total_generation_mwh double"
    ).withColumn("total_generation_mwh", F.col("total_generation_mwh").cast("decimal(24,7)"))
    trend = {r.location: float(r.total_generation_mwh) for r in report.generation_trend(rows).collect()}
    assert sum(trend.values()) == 33 and len(trend) == 12 and trend["LOC_1"] == 0
    with pytest.raises(Exception, match="LOC_1[12]"):
        report_measures.generation_matrix(rows, report.SEED_LABELS).collect()
