"""The whole batch flow as plain functions: land, check, build, check, report."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wattlake.operators import check_catalogue, dimensions, quality, report_measures
from wattlake.plans import combined, fact, refresh, report, staging
from wattlake.sources.stored_dimensions import StoredLocations
from wattlake.sources.versions import VersionedStore


def grown_dimensions(spark: SparkSession, raw_eia: DataFrame, path: str) -> fact.Dimensions:
    """The calendar, and the locations stored under ``path`` with those that the raw rows add.

    Only dated generation adds a place: the fact has no row of a place without it.
    """
    locations = StoredLocations(VersionedStore(spark, f"{path}/dimensions"))
    staged = staging.tag_energy(raw_eia).where("is_generation AND period_date IS NOT NULL")
    locations.grow(staged.select("location", "location_type"))
    return fact.Dimensions(dimensions.dim_time(spark), locations.read(), dimensions.CALENDAR_DAYS)


def model_tables(raw_eia: DataFrame, raw_enrichment: DataFrame, mart: DataFrame) -> dict[str, DataFrame]:
    """All tables under the names that the checks use."""
    return {
        check_catalogue.RAW_EIA: raw_eia,
        check_catalogue.RAW_ENRICHMENT: raw_enrichment,
        check_catalogue.GENERATION: staging.stage_generation(raw_eia),
        check_catalogue.CONSUMPTION: staging.stage_consumption(raw_eia),
        check_catalogue.ENRICHMENT: staging.stage_enrichment(raw_enrichment),
        check_catalogue.COMBINED: combined.combine(raw_eia, raw_enrichment),
        check_catalogue.FACT: mart,
    }


def run(
    spark: SparkSession, raw_eia: DataFrame, raw_enrichment: DataFrame, path: str,
    new_locations: bool = False,
) -> dict[str, DataFrame]:
    """Build the mart under ``path``, then check it and give the report tables.

    With ``new_locations`` the location dimension is a stored table, and places that it does not
    have are added before the mart is built; otherwise it is the seeds, and other places are dropped.
    A failed gate is recorded in the run's status and does not stop the report.
    """
    start = datetime.now(UTC).replace(tzinfo=None)
    written = Observation()
    dims = grown_dimensions(spark, raw_eia, path) if new_locations else None
    mart_rows = fact.stamped(fact.build(raw_eia, raw_enrichment, dims))
    refresh.rebuild(mart_rows.observe(written, F.count(F.lit(1)).alias("rows")), f"{path}/fct_energy_metrics")
    mart = spark.read.parquet(f"{path}/fct_energy_metrics")
    tables = model_tables(raw_eia, raw_enrichment, mart)
    results = quality.evaluate_all(tables, check_catalogue.all_checks())
    quality.audit_rows(results).write.mode("append").parquet(f"{path}/data_quality_checks")
    gate = quality.row_count_gate({"fact": mart, "dim_time": dimensions.dim_time(spark)})
    passed = gate.first()["status"] == "pass"
    end = datetime.now(UTC).replace(tzinfo=None)
    quality.run_row(
        spark, pipeline_name="daily_energy", run_status="success" if passed else "failed",
        start_time=start, end_time=end, rows_inserted=written.get["rows"],
    ).write.mode("append").parquet(f"{path}/pipeline_runs")
    rows = report_measures.with_report_columns(mart)
    return {
        "generation_by_location": report.generation_by_location(rows),
        "generation_trend": report.generation_trend(rows),
        "renewable_by_location": report.renewable_by_location(rows),
        "renewable_trend": report.renewable_trend(rows),
        "temperature_points": report.temperature_points(rows),
        "economic_scatter": report.economic_scatter(rows),
        "summary": report.summary(rows),
        "quality_summary": report.quality_summary(rows),
    }
