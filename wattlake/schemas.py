"""Record, raw, mart and audit schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Measures are exact decimals, so sums do not depend on the order of partitions.
MEASURE = T.DecimalType(18, 4)
# A measure times 1000 (GWh) or over 1000 (kWh) still fits without rounding.
ENERGY = T.DecimalType(24, 7)
COORDINATE = T.DecimalType(9, 6)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Input records carry one of two naming families; every alias is nullable.
EIA_RECORD = _struct(
    ("period", T.StringType()),
    ("seriesId", T.StringType()),
    ("value", MEASURE),
    ("generation", MEASURE),
    ("units", T.StringType()),
    ("generation-units", T.StringType()),
    ("location", T.StringType()),
    ("locationType", T.StringType()),
    ("stateDescription", T.StringType()),
    ("energySource", T.StringType()),
    ("fuelTypeDescription", T.StringType()),
    ("sector", T.StringType()),
    ("sectorDescription", T.StringType()),
)

ENRICHMENT_RECORD = _struct(
    ("period", T.StringType()),
    ("location", T.StringType()),
    ("temperature_fahrenheit", MEASURE),
    ("population", T.LongType()),
    ("gdp_per_capita_usd", MEASURE),
    ("gdp_per_capita", MEASURE),
    ("industrial_activity_index", MEASURE),
)

RAW_EIA = _struct(
    ("id", T.LongType()),
    ("source", T.StringType()),
    ("ingestion_timestamp", T.TimestampNTZType()),
    ("series_id", T.StringType()),
    ("period", T.StringType()),
    ("value", MEASURE),
    ("units", T.StringType()),
    ("location", T.StringType()),
    ("location_type", T.StringType()),
    ("energy_source", T.StringType()),
    ("sector", T.StringType()),
    ("raw_json", T.StringType()),
)

RAW_ENRICHMENT = _struct(
    ("id", T.LongType()),
    ("source", T.StringType()),
    ("ingestion_timestamp", T.TimestampNTZType()),
    ("period", T.StringType()),
    ("location", T.StringType()),
    ("temperature_avg", MEASURE),
    ("temperature_unit", T.StringType()),
    ("population", T.LongType()),
    ("gdp_per_capita", MEASURE),
    ("industrial_activity_index", MEASURE),
    ("raw_json", T.StringType()),
)

DIM_ENERGY_SOURCE = _struct(
    ("energy_source_key", T.IntegerType()),
    ("energy_source_code", T.StringType()),
    ("energy_source_name", T.StringType()),
    ("category", T.StringType()),
    ("is_renewable", T.BooleanType()),
    ("carbon_intensity_kg_per_mwh", T.IntegerType()),
)

DIM_LOCATION = _struct(
    ("location_key", T.IntegerType()),
    ("location_code", T.StringType()),
    ("location_name", T.StringType()),
    ("location_type", T.StringType()),
    ("region", T.StringType()),
    ("timezone", T.StringType()),
    ("latitude", COORDINATE),
    ("longitude", COORDINATE),
)

CHECK_RESULT = _struct(
    ("check_name", T.StringType()),
    ("table_schema", T.StringType()),
    ("table_name", T.StringType()),
    ("check_type", T.StringType()),
    ("check_result", T.StringType()),
    ("rows_checked", T.LongType()),
    ("rows_failed", T.LongType()),
    ("failure_percentage", T.DoubleType()),
    ("check_timestamp", T.TimestampNTZType()),
    ("details", T.StringType()),
)

RUN_RESULT = _struct(
    ("run_id", T.StringType()),
    ("pipeline_name", T.StringType()),
    ("run_status", T.StringType()),
    ("start_time", T.TimestampNTZType()),
    ("end_time", T.TimestampNTZType()),
    ("duration_seconds", T.IntegerType()),
    ("rows_processed", T.LongType()),
    ("rows_inserted", T.LongType()),
    ("rows_updated", T.LongType()),
    ("rows_failed", T.LongType()),
    ("error_message", T.StringType()),
    ("metadata", T.StringType()),
)

# The columns that a table must have (Q12).
REQUIRED_COLUMNS = {
    "raw.eia_energy_data": [
        "id", "source", "ingestion_timestamp", "series_id", "period", "value", "units",
        "location", "location_type", "energy_source", "sector", "raw_json",
    ],
    "raw.enrichment_data": [
        "id", "source", "ingestion_timestamp", "period", "location", "temperature_avg",
        "temperature_unit", "population", "gdp_per_capita", "industrial_activity_index",
        "raw_json",
    ],
    "marts.fct_energy_metrics": [
        "metric_key", "time_key", "location_key", "total_generation_mwh",
        "total_consumption_mwh", "renewable_generation_mwh", "fossil_generation_mwh",
    ],
}
