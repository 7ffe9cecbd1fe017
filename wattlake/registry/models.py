"""Joins and aggregates of the models: J01-J08, A01-A07, T02."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.operators import aggregates, joins, ordering
from wattlake.plans import combined, fact, staging
from wattlake.registry.core import Tables, query
from wattlake.registry.sql import doubles, longs, texts

_KEYS = "CAST(period_date AS VARCHAR) AS period_date, location"
_GENERATION = [
    "total_generation_mwh", "renewable_generation_mwh", "fossil_generation_mwh",
    "nuclear_generation_mwh", "other_generation_mwh",
]
_CONSUMPTION = ["total_consumption_mwh", *aggregates.SECTOR_MEASURES]
_COMBINED_TEXT = {
    "energy_combined_key", "location", "location_type", "temperature_category",
    "population_category", "industrial_activity_category", "has_consumption_data",
    "has_enrichment_data",
}
_COMBINED_LONG = {"energy_source_count", "sector_count", "population"}
_INGESTED = ["generation_ingested_at", "consumption_ingested_at", "enrichment_ingested_at"]
_COMBINED_COLUMNS = [c for c in combined.OUTPUT_COLUMNS if c not in _INGESTED]


def _combined_sql(columns: list[str]) -> str:
    def pick(c: str) -> str:
        if c in _COMBINED_TEXT:
            return c
        if c == "period_date":
            return texts(c)
        return longs(c) if c in _COMBINED_LONG else doubles(c)

    days = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _INGESTED)
    return f"SELECT {', '.join(pick(c) for c in columns)}, {days} FROM combined"


def _fact_sql() -> str:
    def pick(c: str) -> str:
        if c == "metric_key":
            return c
        return longs(c) if c in {"time_key", "location_key", "population"} else doubles(c)

    return f"SELECT {', '.join(pick(c) for c in fact.OUTPUT_COLUMNS)} FROM fact"


def _ingested_days(table):
    return table.withColumns(
        {c: F.col(c).cast("date") for c in _INGESTED if c in table.columns}
    )


@query("A01_total_generation", f"""
SELECT {_KEYS}, location_type, {doubles("total_generation_mwh")} FROM gen_agg""")
def total_generation(t: Tables):
    return t.generation.groupBy("period_date", "location", "location_type").agg(
        F.sum("generation_mwh").alias("total_generation_mwh")
    )


@query("A02_generation_kinds", f"""
SELECT {_KEYS}, location_type, {doubles(*_GENERATION[1:])} FROM gen_agg""")
def generation_kinds(t: Tables):
    return aggregates.aggregate_generation(t.generation).select(
        "period_date", "location", "location_type", *_GENERATION[1:]
    )


@query("A03_distinct_sources", f"""
SELECT {_KEYS}, location_type, energy_source_count FROM gen_agg""")
def distinct_sources(t: Tables):
    return aggregates.aggregate_generation(t.generation).select(
        "period_date", "location", "location_type", "energy_source_count"
    )


@query("A04_latest_ingestion", f"""
SELECT {_KEYS}, location_type, {texts("generation_ingested_at")} FROM gen_agg""")
def latest_ingestion(t: Tables):
    rows = aggregates.aggregate_generation(t.generation)
    return _ingested_days(rows).select(
        "period_date", "location", "location_type", "generation_ingested_at"
    )


@query("A05_consumption", f"""
SELECT {_KEYS}, {doubles(*_CONSUMPTION)}, sector_count, {texts("consumption_ingested_at")}
FROM cons_agg""")
def consumption(t: Tables):
    return _ingested_days(aggregates.aggregate_consumption(t.consumption))


@query("A06_pivot_generation", f"""
SELECT {_KEYS}, {doubles(*aggregates.GENERATION_MEASURES)} FROM gen_pivot""")
def pivot_generation(t: Tables):
    return aggregates.pivot_generation(t.generation)


@query("A07_pivot_consumption", f"""
SELECT {_KEYS}, {doubles(*aggregates.CONSUMPTION_MEASURES)} FROM cons_pivot""")
def pivot_consumption(t: Tables):
    return aggregates.pivot_consumption(t.consumption)


@query("J01_generation_consumption", f"""
SELECT CAST(g.period_date AS VARCHAR) AS period_date, g.location, g.location_type,
       {doubles(*_GENERATION, prefix="g.")}, g.energy_source_count,
       {doubles(*_CONSUMPTION, prefix="c.")}, c.sector_count
FROM gen_agg g LEFT JOIN cons_agg c ON g.period_date = c.period_date AND g.location = c.location""")
def generation_consumption(t: Tables):
    return combined.join_staged(t.generation, t.consumption).drop(
        "generation_ingested_at", "consumption_ingested_at"
    )


@query("J02_combined_enrichment", f"""
SELECT CAST(g.period_date AS VARCHAR) AS period_date, g.location, g.location_type,
       {doubles("total_generation_mwh", prefix="g.")}, {doubles("temperature_fahrenheit", prefix="e.")},
       e.population, e.population_category, {doubles("gdp_per_capita", prefix="e.")}
FROM gen_agg g LEFT JOIN enr e ON g.period_date = e.period_date AND g.location = e.location""")
def combined_enrichment(t: Tables):
    rows = aggregates.aggregate_generation(t.generation)
    return combined.add_enrichment(rows, t.enrichment).select(
        "period_date", "location", "location_type", "total_generation_mwh",
        "temperature_fahrenheit", "population", "population_category", "gdp_per_capita",
    )


@query("J03_time_lookup", f"""
SELECT {_KEYS}, {longs("time_key")}, {doubles("total_generation_mwh")}
FROM gen_pivot JOIN dim_time ON period_date = date""")
def time_lookup(t: Tables):
    rows = joins.join_time(aggregates.pivot_generation(t.generation), t.dims.time, t.dims.time_rows)
    return rows.select("period_date", "location", "time_key", "total_generation_mwh")


@query("J04_location_lookup", f"""
SELECT {_KEYS}, {longs("location_key")}, {doubles("total_generation_mwh")}
FROM gen_pivot JOIN dim_location ON location = location_code""")
def location_lookup(t: Tables):
    rows = joins.join_location(
        aggregates.pivot_generation(t.generation), t.dims.location, t.dims.location_rows
    )
    return rows.select("period_date", "location", "location_key", "total_generation_mwh")


@query("J05_fact_consumption", f"""
SELECT DISTINCT metric_key, {doubles(*aggregates.GENERATION_MEASURES,
       *aggregates.CONSUMPTION_MEASURES, "renewable_percentage", "net_generation_mwh")}
FROM fact""")
def fact_consumption(t: Tables):
    """One row for each day and location: the fact before enrichment repeats its rows."""
    return fact.base_rows_staged(t.generation, t.consumption, t.dims).select(
        "metric_key", *aggregates.GENERATION_MEASURES, *aggregates.CONSUMPTION_MEASURES,
        "renewable_percentage", "net_generation_mwh",
    )


@query("J06_fact_enrichment", f"""
SELECT metric_key, {doubles("total_generation_mwh", "avg_temperature_fahrenheit")},
       {longs("population")}, {doubles("gdp_per_capita_usd", "industrial_activity_index")}
FROM fact""")
def fact_enrichment(t: Tables):
    keyed = fact.look_up_keys(aggregates.pivot_generation(t.generation), t.dims)
    return fact.add_enrichment(keyed, t.enrichment, t.dims).select(
        "metric_key", "total_generation_mwh", *fact.ENRICHMENT_COLUMNS
    )


@query("J07_combined", _combined_sql(_COMBINED_COLUMNS))
def combined_model(t: Tables):
    return _ingested_days(t.combined)


@query("J07_combined_from_staging", _combined_sql(_COMBINED_COLUMNS))
def combined_from_staging(t: Tables):
    return _ingested_days(combined.combine_staged(t.generation, t.consumption, t.enrichment))


@query("J08_fact", _fact_sql())
def fact_model(t: Tables):
    return t.fact


@query("J08_fact_from_staging", _fact_sql())
def fact_from_staging(t: Tables):
    return fact.build_staged(t.generation, t.consumption, t.enrichment, t.dims)


@query("T02_combined_order", _combined_sql(_COMBINED_COLUMNS))
def combined_order(t: Tables):
    return _ingested_days(staging.newest_first(t.combined, combined.SINK_ORDER))


@query("T02_fact_order", _fact_sql())
def fact_order(t: Tables):
    return staging.newest_first(t.fact, fact.SINK_ORDER, lead="time_key")


#: Context columns that tell the rows of a period and location apart, after those of the sink.
_TIES = ["gdp_per_capita", "industrial_activity_index", "enrichment_ingested_at"]


@query("T02_combined_position", f"""
SELECT {texts("period_date")}, location, location_type, {doubles("total_generation_mwh", "temperature_fahrenheit")},
       row_number() OVER (ORDER BY combined.period_date DESC NULLS FIRST,
           {", ".join(f"combined.{c} NULLS LAST" for c in (*combined.SINK_ORDER, *_TIES))}) AS position
FROM combined""")
def combined_position(t: Tables):
    order = staging.newest_order([*combined.SINK_ORDER, *_TIES])
    return ordering.numbered(t.combined, order).select(
        "period_date", "location", "location_type", "total_generation_mwh", "temperature_fahrenheit",
        "position",
    )


@query("T02_fact_position", f"""
SELECT metric_key, {longs("time_key", "location_key")}, {doubles("total_generation_mwh", "avg_temperature_fahrenheit")},
       row_number() OVER (ORDER BY fact.time_key DESC NULLS FIRST,
           {", ".join(f"fact.{c} NULLS LAST" for c in fact.SINK_ORDER)}) AS position
FROM fact""")
def fact_position(t: Tables):
    order = staging.newest_order(fact.SINK_ORDER, lead="time_key")
    return ordering.numbered(t.fact, order).select(
        "metric_key", "time_key", "location_key", "total_generation_mwh", "avg_temperature_fahrenheit",
        "position",
    )
