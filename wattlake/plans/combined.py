"""Intermediate model: generation, consumption and enrichment by period and location."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions import scalar
from wattlake.operators import aggregates, joins
from wattlake.plans import staging

KEYS = aggregates.PERIOD_LOCATION
GENERATION_COLUMNS = [
    "total_generation_mwh", "renewable_generation_mwh", "fossil_generation_mwh",
    "nuclear_generation_mwh", "other_generation_mwh", "energy_source_count",
    "generation_ingested_at",
]
CONSUMPTION_COLUMNS = [
    "total_consumption_mwh", *aggregates.SECTOR_MEASURES, "sector_count",
    "consumption_ingested_at",
]
ENRICHMENT_COLUMNS = [
    "temperature_fahrenheit", "temperature_category", "population", "population_category",
    "gdp_per_capita", "industrial_activity_index", "industrial_activity_category",
]
OUTPUT_COLUMNS = [
    "energy_combined_key", "period_date", "location", "location_type",
    *GENERATION_COLUMNS[:-1],
    "renewable_percentage", "fossil_percentage",
    *CONSUMPTION_COLUMNS[:-1],
    "generation_to_consumption_ratio",
    *ENRICHMENT_COLUMNS,
    "generation_per_capita_mwh", "consumption_per_capita_mwh",
    "has_consumption_data", "has_enrichment_data",
    "generation_ingested_at", "consumption_ingested_at", "enrichment_ingested_at",
]


def join_staged(generation: DataFrame, consumption: DataFrame) -> DataFrame:
    """Aggregates of the two staging models, left-joined: generation leads."""
    return joins.left_join_aggregates(
        aggregates.aggregate_generation(generation),
        aggregates.aggregate_consumption(consumption),
        KEYS,
    )


def join_raw(raw_eia: DataFrame) -> DataFrame:
    """The same rows from one scan of the raw layer.

    The cube holds one row for each combination of its keys. Each of them counts as a
    generation row of its location type, a consumption row of its location, or both; grouping
    these gives both aggregates at once, and a window over the few types of a location hands
    the consumption to each of them.
    """
    cube = aggregates.energy_cube(staging.tag_energy(raw_eia), "location_type")
    none = F.lit(None).cast("string")
    as_generation = F.struct(
        F.lit("g").alias("kind"), "location_type", "energy_source", none.alias("sector")
    )
    as_consumption = F.struct(
        F.lit("c").alias("kind"), none.alias("location_type"), none.alias("energy_source"),
        "sector",
    )
    sides = F.filter(
        F.array(
            F.when(F.col("is_generation"), as_generation),
            F.when(F.col("is_consumption"), as_consumption),
        ),
        lambda side: side.isNotNull(),
    )
    one_kind = (
        cube.select(*KEYS, "mwh", "ingestion_timestamp", F.explode(sides).alias("side"))
        .select(*KEYS, "mwh", "ingestion_timestamp", "side.*")
        .groupBy(*KEYS, "kind", "location_type", "energy_source", "sector")
        .agg(
            F.sum("mwh").alias("mwh"),
            F.max("ingestion_timestamp").alias("ingestion_timestamp"),
        )
    )
    grouped = one_kind.groupBy(*KEYS, "kind", "location_type").agg(
        *aggregates.generation_sums("mwh"),
        *aggregates.consumption_sums("mwh"),
        F.count("energy_source").alias("energy_source_count"),
        F.count("sector").alias("sector_count"),
        F.max("ingestion_timestamp").alias("generation_ingested_at"),
        F.max("ingestion_timestamp").alias("consumption_ingested_at"),
    )
    place = Window.partitionBy(*KEYS)
    is_consumption = F.col("kind") == "c"
    beside = [
        F.max(F.when(is_consumption, F.col(c))).over(place).alias(c) for c in CONSUMPTION_COLUMNS
    ]
    return (
        grouped.select(*KEYS, "kind", "location_type", *GENERATION_COLUMNS, *beside)
        .filter(F.col("kind") == "g")
        .drop("kind")
    )


def with_energy_measures(joined: DataFrame) -> DataFrame:
    """Percentages, ratio and flag (P17, P18, P20) and the key (P10), all of them before the
    enrichment join repeats the rows. Two location types of one place share the key."""
    generation, consumption = F.col("total_generation_mwh"), F.col("total_consumption_mwh")
    return joined.withColumns(
        {
            "renewable_percentage": scalar.share_percent(
                F.col("renewable_generation_mwh"), generation
            ),
            "fossil_percentage": scalar.share_percent(F.col("fossil_generation_mwh"), generation),
            "generation_to_consumption_ratio": scalar.ratio_or_null(generation, consumption),
            "has_consumption_data": consumption.isNotNull(),
            "energy_combined_key": scalar.surrogate_key(F.col("period_date"), F.col("location")),
        }
    )


def with_context_measures(enriched: DataFrame) -> DataFrame:
    """Per-capita values and flag (P19, P20), which differ by enrichment row."""
    population = F.col("population")
    return enriched.withColumns(
        {
            "generation_per_capita_mwh": scalar.per_million_people(
                F.col("total_generation_mwh"), population
            ),
            "consumption_per_capita_mwh": scalar.per_million_people(
                F.col("total_consumption_mwh"), population
            ),
            "has_enrichment_data": F.col("temperature_fahrenheit").isNotNull(),
        }
    )


def add_enrichment(joined: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Left join with every enrichment row of the period and location."""
    context = enrichment.select(
        *KEYS, "source_id", *ENRICHMENT_COLUMNS,
        F.col("ingestion_timestamp").alias("enrichment_ingested_at"),
    )
    return joins.left_join_fanout(joined, context, KEYS, spread_by="source_id")


def _finish(joined: DataFrame, enrichment: DataFrame) -> DataFrame:
    enriched = add_enrichment(with_energy_measures(joined), enrichment)
    return with_context_measures(enriched).select(*OUTPUT_COLUMNS)


def combine_staged(
    generation: DataFrame, consumption: DataFrame, enrichment: DataFrame
) -> DataFrame:
    return _finish(join_staged(generation, consumption), enrichment)


def combine(raw_eia: DataFrame, raw_enrichment: DataFrame) -> DataFrame:
    return _finish(join_raw(raw_eia), staging.stage_enrichment(raw_enrichment))


SINK_ORDER = ["location", "location_type", "population", "temperature_fahrenheit"]
