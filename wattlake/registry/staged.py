"""Staging projections, scalar functions and filters: P01-P28, F01-F06, T01."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.functions import scalar
from wattlake.operators import aggregates, filters, ordering
from wattlake.plans import combined, fact, staging
from wattlake.registry import sql
from wattlake.registry.core import Tables, query
from wattlake.registry.sql import doubles, longs, percent, texts

_GEN_COLUMNS = [
    "generation_key", "source_id", "data_source", "period_date", "period_type", "period_raw",
    "location", "location_type", "energy_source", "sector", "generation_value", "units",
    "generation_mwh", "series_id",
]
_CONS_COLUMNS = [c.replace("generation", "consumption") for c in _GEN_COLUMNS]
_ENR_COLUMNS = [
    "enrichment_key", "source_id", "data_source", "period_date", "period_raw", "location",
    "temperature_fahrenheit", "temperature_unit", "population", "gdp_per_capita",
    "industrial_activity_index", "temperature_category", "population_category",
    "industrial_activity_category",
]
_NUMBERS = {
    "generation_value", "generation_mwh", "consumption_value", "consumption_mwh",
    "temperature_fahrenheit", "gdp_per_capita", "industrial_activity_index",
}


def _select(columns: list[str], table: str) -> str:
    picked = [
        doubles(c) if c in _NUMBERS else texts(c) if c == "period_date" else c for c in columns
    ]
    return f"SELECT {', '.join(picked)} FROM {table}"


@query("P01_period_date", f"""
SELECT id, period, CAST({sql._PARSED_DATE} AS VARCHAR) AS period_date FROM raw_eia""")
def period_date(t: Tables):
    return t.raw_eia.select("id", "period", scalar.period_date(F.col("period")).alias("period_date"))


@query("P02_period_type", f"SELECT id, period, {sql._PERIOD_TYPE} AS period_type FROM raw_eia")
def period_type(t: Tables):
    return t.raw_eia.select("id", "period", scalar.period_type(F.col("period")).alias("period_type"))


@query("P03_standard_location", f"SELECT id, {sql._LOCATION} AS location FROM raw_eia")
def standard_location(t: Tables):
    place = scalar.standard_location(F.col("location"), F.col("location_type"))
    return t.raw_eia.select("id", place.alias("location"))


@query("P04_enrichment_location", "SELECT id, trim(upper(location)) AS location FROM raw_enrichment")
def enrichment_location(t: Tables):
    return t.raw_enrichment.select("id", scalar.clean_upper(F.col("location")).alias("location"))


@query("P05_clean_text", """
SELECT id, trim(lower(location_type)) AS location_type, trim(lower(energy_source)) AS energy_source,
       trim(lower(sector)) AS sector, trim(lower(units)) AS units FROM raw_eia""")
def clean_text(t: Tables):
    names = ["location_type", "energy_source", "sector", "units"]
    return t.raw_eia.select("id", *(scalar.clean_lower(F.col(n)).alias(n) for n in names))


@query("P06_units_to_mwh", f"""
SELECT id, r.units, CAST({sql.MWH} AS DOUBLE) AS mwh
FROM raw_eia r JOIN unit_factors u ON r.units IS NOT DISTINCT FROM u.units""")
def units_to_mwh(t: Tables):
    return t.raw_eia.select("id", "units", scalar.to_mwh(F.col("value"), F.col("units")).alias("mwh"))


@query("P07_generation_key", "SELECT source_id, generation_key FROM gen")
def generation_key(t: Tables):
    return t.generation.select("source_id", "generation_key")


@query("P08_consumption_key", "SELECT source_id, consumption_key FROM cons")
def consumption_key(t: Tables):
    return t.consumption.select("source_id", "consumption_key")


@query("P09_enrichment_key", "SELECT source_id, enrichment_key FROM enr")
def enrichment_key(t: Tables):
    return t.enrichment.select("source_id", "enrichment_key")


@query("P10_combined_key", f"""
SELECT CAST(period_date AS VARCHAR) AS period_date, location, location_type,
       {sql.key("period_date", "location")} AS energy_combined_key FROM gen_agg""")
def combined_key(t: Tables):
    joined = combined.join_raw(t.raw_eia)
    key = scalar.surrogate_key(F.col("period_date"), F.col("location"))
    return joined.select(
        "period_date", "location", "location_type", key.alias("energy_combined_key")
    )


@query("P11_fact_key", f"SELECT {longs('time_key', 'location_key')}, metric_key FROM fact")
def fact_key(t: Tables):
    return t.fact.select("time_key", "location_key", "metric_key")


@query("P12_plausible_temperature", f"""
SELECT id, CAST(CASE WHEN temperature_avg BETWEEN -50 AND 150 THEN temperature_avg END AS DOUBLE)
         AS validated, CAST(temperature_avg AS DOUBLE) AS kept FROM raw_enrichment""")
def plausible_temperature(t: Tables):
    value = F.col("temperature_avg")
    checked = scalar.plausible_temperature(value)
    return t.raw_enrichment.select(
        "id", checked.alias("validated"), F.coalesce(checked, value).alias("kept")
    )


@query("P13_temperature_category", "SELECT source_id, temperature_category FROM enr")
def temperature_category(t: Tables):
    return t.enrichment.select("source_id", "temperature_category")


@query("P14_population_category", "SELECT source_id, population_category FROM enr")
def population_category(t: Tables):
    return t.enrichment.select("source_id", "population_category")


@query("P15_industrial_category", "SELECT source_id, industrial_activity_category FROM enr")
def industrial_category(t: Tables):
    return t.enrichment.select("source_id", "industrial_activity_category")


@query("P16_lineage", "SELECT source_id, data_source, period_raw FROM gen")
def lineage(t: Tables):
    return t.generation.select("source_id", "data_source", "period_raw")


_COMBINED_KEYS = "CAST(period_date AS VARCHAR) AS period_date, location, location_type"


@query("P17_share_percent", f"""
SELECT {_COMBINED_KEYS},
       {percent("renewable_generation_mwh", "total_generation_mwh")} AS renewable_percentage,
       {percent("fossil_generation_mwh", "total_generation_mwh")} AS fossil_percentage
FROM gen_agg""")
def share_percent(t: Tables):
    rows = aggregates.aggregate_generation(t.generation)
    total = F.col("total_generation_mwh")
    return rows.select(
        "period_date", "location", "location_type",
        scalar.share_percent(F.col("renewable_generation_mwh"), total).alias("renewable_percentage"),
        scalar.share_percent(F.col("fossil_generation_mwh"), total).alias("fossil_percentage"),
    )


@query("P18_generation_to_consumption", f"""
SELECT {_COMBINED_KEYS}, generation_to_consumption_ratio FROM combined""")
def generation_to_consumption(t: Tables):
    return t.combined.select(
        "period_date", "location", "location_type", "generation_to_consumption_ratio"
    )


@query("P19_per_million_people", f"""
SELECT {_COMBINED_KEYS}, generation_per_capita_mwh, consumption_per_capita_mwh FROM combined""")
def per_million_people(t: Tables):
    return t.combined.select(
        "period_date", "location", "location_type", "generation_per_capita_mwh",
        "consumption_per_capita_mwh",
    )


@query("P20_presence_flags", f"""
SELECT {_COMBINED_KEYS}, has_consumption_data, has_enrichment_data FROM combined""")
def presence_flags(t: Tables):
    return t.combined.select(
        "period_date", "location", "location_type", "has_consumption_data", "has_enrichment_data"
    )


@query("P21_zero_defaults", f"""
SELECT metric_key, {doubles(*aggregates.CONSUMPTION_MEASURES, *aggregates.SOURCE_MEASURES)}
FROM fact""")
def zero_defaults(t: Tables):
    return t.fact.select(
        "metric_key", *aggregates.CONSUMPTION_MEASURES, *aggregates.SOURCE_MEASURES
    )


@query("P22_net_generation", f"SELECT metric_key, {doubles('net_generation_mwh')} FROM fact")
def net_generation(t: Tables):
    return t.fact.select("metric_key", "net_generation_mwh")


@query("P23_created_updated", """
SELECT metric_key, '2025-06-01 02:00:00' AS created_at, '2025-06-01 02:00:00' AS updated_at
FROM fact""")
def created_updated(t: Tables):
    now = F.lit("2025-06-01 02:00:00").cast("timestamp_ntz")
    return fact.stamped(t.fact, now).select("metric_key", "created_at", "updated_at")


@query("P24_zero_safe_percent", """
SELECT metric_key, CASE WHEN total_generation_mwh = 0 THEN 0.0 ELSE
         round(CAST(renewable_generation_mwh AS DOUBLE) / CAST(total_generation_mwh AS DOUBLE)
         * 100, 9) END AS renewable_percentage FROM fact""")
def zero_safe_percent(t: Tables):
    value = scalar.zero_safe_percent(
        F.col("renewable_generation_mwh"), F.col("total_generation_mwh")
    )
    return t.fact.select("metric_key", F.round(value, 9).alias("renewable_percentage"))


@query("P25_display_date", """
SELECT source_id, strftime(period_date, '%Y-%m-%d') AS shown FROM gen""")
def display_date(t: Tables):
    return t.generation.select("source_id", scalar.display_date(F.col("period_date")).alias("shown"))


@query("P26_date_of_time_key", f"""
SELECT metric_key, CAST(date AS VARCHAR) AS date, {longs("year", "month")} FROM report_rows""")
def date_of_time_key(t: Tables):
    return t.report_rows.select("metric_key", "date", "year", "month")


@query("P27_location_label", "SELECT metric_key, location FROM report_rows")
def location_label(t: Tables):
    return t.report_rows.select("metric_key", "location")


@query("P28_renewable_band", """
SELECT metric_key, CASE WHEN renewable_percentage >= 50 THEN 'green'
         WHEN renewable_percentage >= 25 THEN 'orange' ELSE 'red' END AS band FROM fact""")
def renewable_band(t: Tables):
    return t.fact.select(
        "metric_key", scalar.renewable_band(F.col("renewable_percentage")).alias("band")
    )


@query("F01_generation_rows", """
SELECT id, series_id, energy_source FROM raw_eia
SEMI JOIN (SELECT source_id FROM energy_rows WHERE generates) ON id = source_id""")
def generation_rows(t: Tables):
    return filters.generation_rows(t.raw_eia).select("id", "series_id", "energy_source")


@query("F02_consumption_rows", """
SELECT id, series_id, sector FROM raw_eia
SEMI JOIN (SELECT source_id FROM energy_rows WHERE consumes) ON id = source_id""")
def consumption_rows(t: Tables):
    return filters.consumption_rows(t.raw_eia).select("id", "series_id", "sector")


@query("F03_enrichment_rows", """
SELECT id, period, location FROM raw_enrichment
WHERE period IS NOT NULL AND location IS NOT NULL AND temperature_avg IS NOT NULL
  AND population IS NOT NULL""")
def enrichment_rows(t: Tables):
    return filters.enrichment_rows(t.raw_enrichment).select("id", "period", "location")


@query("F04_staged_generation", _select(_GEN_COLUMNS, "gen"))
def staged_generation(t: Tables):
    return t.generation.select(*_GEN_COLUMNS)


@query("F05_staged_consumption", _select(_CONS_COLUMNS, "cons"))
def staged_consumption(t: Tables):
    return t.consumption.select(*_CONS_COLUMNS)


@query("F06_staged_enrichment", _select(_ENR_COLUMNS, "enr"))
def staged_enrichment(t: Tables):
    return t.enrichment.select(*_ENR_COLUMNS)


@query("T01_staging_order_generation", _select(_GEN_COLUMNS, "gen") + """
ORDER BY period_date DESC NULLS FIRST, location, energy_source, generation_key""")
def staging_order_generation(t: Tables):
    return staging.newest_first(t.generation, staging.GENERATION_ORDER).select(*_GEN_COLUMNS)


@query("T01_staging_order_consumption", _select(_CONS_COLUMNS, "cons") + """
ORDER BY period_date DESC NULLS FIRST, location, sector NULLS LAST, consumption_key""")
def staging_order_consumption(t: Tables):
    return staging.newest_first(t.consumption, staging.CONSUMPTION_ORDER).select(*_CONS_COLUMNS)


@query("T01_staging_order_enrichment", _select(_ENR_COLUMNS, "enr") + """
ORDER BY period_date DESC NULLS FIRST, location, enrichment_key""")
def staging_order_enrichment(t: Tables):
    return staging.newest_first(t.enrichment, staging.ENRICHMENT_ORDER).select(*_ENR_COLUMNS)


def _positions(columns: list[str], table: str, then: list[str]) -> str:
    order = ", ".join(f"{table}.{c} NULLS LAST" for c in then)
    return f"""
SELECT {columns[0]}, row_number() OVER (ORDER BY {table}.period_date DESC NULLS FIRST, {order}) AS position
FROM {table}"""


@query("T01_position_generation", _positions(_GEN_COLUMNS, "gen", staging.GENERATION_ORDER))
def position_generation(t: Tables):
    order = staging.newest_order(staging.GENERATION_ORDER)
    rows = t.generation.select("generation_key", "period_date", "location", "energy_source")
    return ordering.numbered(rows, order).select("generation_key", "position")


@query("T01_position_consumption", _positions(_CONS_COLUMNS, "cons", staging.CONSUMPTION_ORDER))
def position_consumption(t: Tables):
    order = staging.newest_order(staging.CONSUMPTION_ORDER)
    rows = t.consumption.select("consumption_key", "period_date", "location", "sector")
    return ordering.numbered(rows, order).select("consumption_key", "position")


@query("T01_position_enrichment", _positions(_ENR_COLUMNS, "enr", staging.ENRICHMENT_ORDER))
def position_enrichment(t: Tables):
    order = staging.newest_order(staging.ENRICHMENT_ORDER)
    rows = t.enrichment.select("enrichment_key", "period_date", "location")
    return ordering.numbered(rows, order).select("enrichment_key", "position")
