"""Pages and records into raw rows; scans of landed data."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.sources import landing, scans

MOCK = {
    "period": "2022-11", "seriesId": "SERIES-7", "value": 41.5, "units": "gigawatthours",
    "location": "US-OR", "locationType": "region", "energySource": "hydro", "sector": "industrial",
}
LIVE = {
    "period": "2022-12", "generation": 0, "generation-units": "MWh", "location": "US-OR",
    "stateDescription": "Oregon", "fuelTypeDescription": "wind", "sectorDescription": "commercial",
    "note": "as sent",
}


def _lines(spark, *records):
    texts = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(texts, "value string").coalesce(1)


def test_pages_from_files(spark, tmp_path):
    page = {"response": {"total": 2, "data": [MOCK, LIVE]}, "apiVersion": "2"}
    (tmp_path / "a.json").write_text(json.dumps(page, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"error": "no data"}))
    (tmp_path / "c.json").write_text("not json")
    pages = landing.read_pages(spark, str(tmp_path))
    now = F.lit("2024-05-01 06:00:00").cast("timestamp_ntz")
    rows = landing.land_eia_pages(pages, ingested_at=now).orderBy("value").collect()
    assert [r.value for r in rows] == [D(0), D("41.5")]
    live, mock = rows
    assert live.series_id == "ELEC.GEN.US-OR"
    assert (live.location_type, live.energy_source, live.sector) == (
        "Oregon", "wind", "commercial",
    )
    assert json.loads(live.raw_json)["note"] == "as sent"
    assert (mock.series_id, mock.units, mock.source) == (
        "SERIES-7", "gigawatthours", "EIA",
    )
    assert mock.ingestion_timestamp == dt.datetime(2024, 5, 1, 6)


def test_zero_and_empty_text_are_values(spark):
    rows = landing.land_eia_lines(
        _lines(spark, {"period": "2024-01", "value": 0, "generation": 5, "units": "", "generation-units": "MWh"})
    ).collect()
    assert (rows[0].value, rows[0].units) == (D(0), "")


def test_series_id_fallback(spark):
    records = [
        {"period": "1", "seriesId": ""}, {"period": "2", "seriesId": None, "location": None},
        {"period": "3", "location": ""}, {"period": "4", "location": "US-TX"},
    ]
    rows = landing.land_eia_lines(_lines(spark, *records)).orderBy("period").collect()
    assert [r.series_id for r in rows] == [
        "ELEC.GEN.NA", "ELEC.GEN.None", "ELEC.GEN.", "ELEC.GEN.US-TX",
    ]


def test_minimal_records_land_and_malformed_ones_do_not(spark):
    rows = landing.land_eia_lines(_lines(spark, {"period": "2024-01", "value": 100}, "{broken", "", "[1]", "7")).collect()
    assert [(r.location, r.value) for r in rows] == [(None, D(100))]


def test_reasons_of_rejects(spark):
    records = [
        {"period": "1", "value": "12.5", "unknown": {"kept": [1]}}, {"period": "2", "value": "n/a"},
        {"period": "3", "value": 1e40}, {"period": "4", "value": 123456789012345678}, "{\"period\": \"5\"", "null",
        {"period": 6, "value": True}, {"period": "7", "value": None, "generation": 0.123456}, [{"period": "8"}], "",
        {"period": "9", "value": 1, "generation": {"a": 1}},
    ]
    marked = landing.mark(landing.records_of_lines(_lines(spark, *records)), "eia").collect()
    assert [r.reject_reason for r in marked] == [
        None, "value: no number", "value: out of range", "value: out of range", "malformed JSON", "malformed JSON",
        "value: no number", None, "malformed JSON", "malformed JSON", "generation: no number",
    ]
    assert marked[0].value == D("12.5") and json.loads(marked[0].raw_json)["unknown"] == {"kept": [1]}
    assert (marked[7].value, marked[7].is_rounded, marked[0].is_rounded) == (D("0.1235"), True, False)
    assert json.loads(marked[7].raw_json)["generation"] == 0.123456
    # A reject carries nothing but its source, time and text.
    assert (marked[1].period, marked[1].series_id, marked[1].source) == (None, None, "EIA")
    wanted = [{"location": " US-CA ", "period": "1"}, {"location": " ", "period": "2"}, {"location": "US-CA"}, {"x": 1}]
    rows = landing.mark(landing.records_of_lines(_lines(spark, *wanted)), "enrichment").collect()
    assert [r.reject_reason for r in rows] == [
        None, "location must not be blank", "period must not be blank", "location,period must not be blank",
    ]
    assert rows[0].location == "US-CA"


def test_one_pass_fills_both_sinks(spark, tmp_path):
    path = str(tmp_path / "raw")
    pages = spark.createDataFrame(
        [(1, json.dumps({"response": {"data": [MOCK, LIVE, {"value": "x"}]}})), (2, "not json"), (3, '{"error": 1}'), (4, None)],
        "page int, value string",
    )
    marked = landing.mark(landing.records_of_pages(pages, keep=["page"]), "eia", ["page"])
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("AS record as sent#") == 1 and plan.count("AS page as parsed#") == 1
    assert landing.land_batch(marked, path) == {"landed": 2, "rejected": 2, "rounded": 0}
    assert landing.land_batch(marked.where("page = 1"), path) == {"landed": 2, "rejected": 1, "rounded": 0}
    landed = landing.read_landed(spark, path, schemas.RAW_EIA)
    assert landed.schema.names == schemas.RAW_EIA.names and landed.count() == 4
    text = landed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in text
    rejects = landing.read_quarantine(spark, path, ["page"]).collect()
    assert sorted((r.page, r.reject_reason, r.raw_json) for r in rejects) == [
        (1, "value: no number", '{"value":"x"}'), (1, "value: no number", '{"value":"x"}'), (2, "malformed JSON", "not json"),
    ]
    # Repaired texts pass.
    again = landing.retry_quarantine(spark, path, "eia", ["page"], F.replace("raw_json", F.lit('"x"'), F.lit("5"))).collect()
    assert sorted((r.page, r.reject_reason is None, r.value) for r in again) == [(1, True, D(5)), (1, True, D(5)), (2, False, None)]
    assert landing.land_batch(marked.limit(0), str(tmp_path / "none")) == {"landed": 0, "rejected": 0, "rounded": 0}
    assert not list((tmp_path / "none").glob("**/*.parquet"))


def test_enrichment_records(spark):
    records = [
        {"location": "US-OR", "period": "1", "temperature_fahrenheit": 51.25, "population": 4200000,
         "gdp_per_capita": 61000.75, "industrial_activity_index": 88.5},
        {"location": "US-NY", "period": "2", "gdp_per_capita_usd": 0, "gdp_per_capita": 5},
        {"location": "US-TX", "period": "3", "temperature_fahrenheit": 0, "gdp_per_capita_usd": 7},
        {"location": "US-FL", "period": "4", "gdp_per_capita_usd": 0},
    ]
    rows = landing.land_enrichment_lines(_lines(spark, *records)).orderBy("period").collect()
    assert [r.gdp_per_capita for r in rows] == [D("61000.75"), D(5), D(7), None]
    assert [r.temperature_unit for r in rows] == ["fahrenheit", None, "fahrenheit", None]
    assert rows[0].temperature_avg == D("51.25") and rows[0].population == 4200000


def test_raw_json_keeps_nulls(spark):
    row = landing.with_raw_json(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b")).first()
    assert json.loads(row.raw_json) == {"a": 1, "b": None}


def test_rejects_are_marked(spark):
    frame = spark.createDataFrame([("2024-01",), ("2024-1",), ("2024-01-15",), (None,)], "period string")
    marks = landing.split_by_month_format(frame).collect()
    assert [m.is_valid for m in marks] == [True, False, False, False]
    assert marks[3].reject_reason == "missing period"
    pairs = spark.createDataFrame([(" US-CA ", "2024"), ("  ", None), (None, "2024")], "location string, period string")
    rows = landing.split_by_required_text(pairs, ["location", "period"]).collect()
    assert [r.is_valid for r in rows] == [True, False, False]
    assert rows[0].location == "US-CA"
    assert rows[1].reject_reason == "location,period must not be blank"


def test_month_parameters():
    assert landing.require_month("2024-01") == "2024-01"
    for bad in ("2024", "2024-1", "2024-01-01", "jan", ""):
        with pytest.raises(ValueError, match="not a month"):
            landing.require_month(bad)


def test_fetch_period_range(spark, raw_eia):
    rows = raw_eia(
        {"period": "2023-12"}, {"period": "2024-01"}, {"period": "2024-02", "location": "TX"},
        {"period": "2024-02-15"}, {"period": "2024"}, {"period": "2024-03"},
    )
    found = scans.fetch_period_range(rows, "2024-01", "2024-02")
    assert sorted(r.period for r in found.collect()) == ["2024-01", "2024-02"]
    assert scans.fetch_period_range(rows, "2024-01", "2024-02", "TX").count() == 1
    daily = scans.fetch_period_range(rows, "2024-01", "2024-02", frequency="daily")
    assert [r.period for r in daily.collect()] == ["2024-02-15"]


def test_append_batch(spark, raw_eia, tmp_path):
    path = str(tmp_path / "raw")
    assert landing.append_batch(raw_eia().limit(0), path) == 0
    assert not (tmp_path / "raw").exists()
    assert landing.append_batch(raw_eia({}, {}), path) == 2
    assert landing.append_batch(raw_eia({}), path) == 1
    assert spark.read.schema(schemas.RAW_EIA).parquet(path).count() == 3


def test_bounds_reach_the_reader(spark, raw_eia, tmp_path):
    path = str(tmp_path / "raw")
    landing.append_batch(raw_eia({}), path)
    landed = spark.read.parquet(path)
    plan = scans.fetch_period_range(landed, "2024-01", "2024-02", "CA").select("value")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(period,2024-01)" in text and "EqualTo(location,CA)" in text
    assert "energy_source" not in text
