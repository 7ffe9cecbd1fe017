"""Staging models: cleaned and typed rows of the raw layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions import scalar
from wattlake.operators import filters


def _energy_columns(measure: str) -> list[Column]:
    period, location_type = F.col("period"), F.col("location_type")
    return [
        F.col("id").alias("source_id"),
        F.col("source").alias("data_source"),
        F.col("ingestion_timestamp"),
        scalar.period_date(period).alias("period_date"),
        scalar.period_type(period).alias("period_type"),
        period.alias("period_raw"),
        scalar.standard_location(F.col("location"), location_type).alias("location"),
        scalar.clean_lower(location_type).alias("location_type"),
        scalar.clean_lower(F.col("energy_source")).alias("energy_source"),
        scalar.clean_lower(F.col("sector")).alias("sector"),
        F.col("value").alias(f"{measure}_value"),
        scalar.clean_lower(F.col("units")).alias("units"),
        scalar.to_mwh(F.col("value"), F.col("units")).alias(f"{measure}_mwh"),
        F.col("series_id"),
        F.col("raw_json"),
    ]


def _keyed(rows: DataFrame, name: str, *parts: str) -> DataFrame:
    key = scalar.surrogate_key(*(F.col(p) for p in parts)).alias(name)
    return rows.select(key, *rows.columns)


def stage_generation(raw_eia: DataFrame) -> DataFrame:
    rows = filters.generation_rows(raw_eia).select(*_energy_columns("generation"))
    parsed = filters.parsed_generation(rows)
    return _keyed(
        parsed, "generation_key", "source_id", "period_date", "location", "energy_source"
    )


def stage_consumption(raw_eia: DataFrame) -> DataFrame:
    rows = filters.consumption_rows(raw_eia).select(*_energy_columns("consumption"))
    parsed = filters.parsed_consumption(rows)
    return _keyed(parsed, "consumption_key", "source_id", "period_date", "location", "sector")


def tag_energy(raw_eia: DataFrame) -> DataFrame:
    """Generation and consumption rows of one scan, each marked as either or both.

    The two staging models share their parsing, so the models that need only sums can read
    the raw layer once instead of once for each. Rows without a date are still among them:
    the cube drops their groups, which spares a second parsing of every period in a filter.
    """
    generation = F.coalesce(filters.is_generation(), F.lit(False))
    consumption = F.coalesce(filters.is_consumption(), F.lit(False))
    rows = raw_eia.filter(
        (F.col("value") >= 0) & F.col("location").isNotNull() & (generation | consumption)
    )
    return rows.select(
        *_energy_columns("energy"),
        generation.alias("is_generation"),
        consumption.alias("is_consumption"),
    ).select(
        "ingestion_timestamp", "period_date", "location", "location_type", "energy_source",
        "sector", F.col("energy_mwh").alias("mwh"), "is_generation", "is_consumption",
    )


def stage_enrichment(raw_enrichment: DataFrame) -> DataFrame:
    temperature = F.col("temperature_avg")
    rows = filters.enrichment_rows(raw_enrichment).select(
        F.col("id").alias("source_id"),
        F.col("source").alias("data_source"),
        F.col("ingestion_timestamp"),
        scalar.period_date(F.col("period")).alias("period_date"),
        F.col("period").alias("period_raw"),
        scalar.clean_upper(F.col("location")).alias("location"),
        # An implausible temperature falls back to itself, so the range rejects nothing.
        F.coalesce(scalar.plausible_temperature(temperature), temperature).alias(
            "temperature_fahrenheit"
        ),
        scalar.clean_upper(F.col("temperature_unit")).alias("temperature_unit"),
        F.col("population"),
        F.col("gdp_per_capita"),
        F.col("industrial_activity_index"),
        scalar.temperature_category(temperature).alias("temperature_category"),
        scalar.population_category(F.col("population")).alias("population_category"),
        scalar.industrial_category(F.col("industrial_activity_index")).alias(
            "industrial_activity_category"
        ),
        F.col("raw_json"),
    )
    parsed = filters.parsed_enrichment(rows)
    return _keyed(parsed, "enrichment_key", "source_id", "period_date", "location")


# Orders for sinks. The unique key comes last: it makes the order total and lets the range
# partitioner cut through a date and location that hold much of the data.
GENERATION_ORDER = ["location", "energy_source", "generation_key"]
CONSUMPTION_ORDER = ["location", "sector", "consumption_key"]
ENRICHMENT_ORDER = ["location", "enrichment_key"]


def newest_order(then: list[str], lead: str = "period_date") -> list[Column]:
    """Descending by ``lead`` with NULLs first, then ascending with NULLs last."""
    return [F.desc_nulls_first(lead), *(F.asc_nulls_last(c) for c in then)]


def newest_first(rows: DataFrame, then: list[str], lead: str = "period_date") -> DataFrame:
    """Rows in the order of ``newest_order``."""
    return rows.orderBy(*newest_order(then, lead))
