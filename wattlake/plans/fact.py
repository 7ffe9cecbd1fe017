"""Fact model: energy metrics by calendar day and known location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions import scalar
from wattlake.operators import aggregates, dimensions, joins
from wattlake.plans import staging

KEYS = aggregates.PERIOD_LOCATION
ENRICHMENT_COLUMNS = [
    "avg_temperature_fahrenheit", "population", "gdp_per_capita_usd", "industrial_activity_index",
]
MEASURE_COLUMNS = [
    *aggregates.GENERATION_MEASURES, *aggregates.CONSUMPTION_MEASURES,
    "renewable_percentage", "net_generation_mwh", *ENRICHMENT_COLUMNS,
]
OUTPUT_COLUMNS = ["metric_key", "time_key", "location_key", *MEASURE_COLUMNS]


def with_measures(pivoted: DataFrame) -> DataFrame:
    """Zero defaults, renewable share and net generation."""
    total, zero = F.col("total_generation_mwh"), F.lit(0)
    defaults = {
        c: F.coalesce(F.col(c), zero)
        for c in (*aggregates.GENERATION_MEASURES, *aggregates.CONSUMPTION_MEASURES)
        if c != "total_generation_mwh"
    }
    consumed = F.coalesce(F.col("total_consumption_mwh"), zero)
    return pivoted.withColumns(
        {
            "renewable_percentage": scalar.share_percent(F.col("renewable_generation_mwh"), total),
            "net_generation_mwh": total - consumed,
            **defaults,
        }
    )


class Dimensions:
    """Calendar and locations with their row counts: the counts bound a fact's keys."""

    def __init__(
        self, time: DataFrame, location: DataFrame,
        time_rows: int | None = None, location_rows: int | None = None,
    ) -> None:
        self.time, self.location = time, location
        self.time_rows = joins.bounded_rows(time) if time_rows is None else time_rows
        self.location_rows = (
            joins.bounded_rows(location) if location_rows is None else location_rows
        )

    @classmethod
    def seeds(cls, spark) -> Dimensions:
        """The seeded dimensions, whose sizes are fixed: no job counts them."""
        return cls(
            dimensions.dim_time(spark), dimensions.dim_location(spark),
            dimensions.CALENDAR_DAYS, len(dimensions.LOCATIONS),
        )

    def key_bound(self) -> int | None:
        """Most rows that a table with one row for each day and location can have."""
        if self.time_rows is None or self.location_rows is None:
            return None
        return self.time_rows * self.location_rows


def look_up_keys(pivoted: DataFrame, dims: Dimensions) -> DataFrame:
    """Inner joins with both dimensions (J03, J04) and the fact's key."""
    dated = joins.join_time(pivoted, dims.time, dims.time_rows)
    placed = joins.join_location(dated, dims.location, dims.location_rows)
    key = scalar.surrogate_key(F.col("time_key"), F.col("location_key"))
    return placed.withColumn("metric_key", key)


def add_enrichment(base: DataFrame, enrichment: DataFrame, dims: Dimensions) -> DataFrame:
    """Left join with every enrichment row of the day and location.

    The base has one row at most for each pair of dimension rows. That bound decides whether
    it is sent to the enrichment's tasks or the enrichment's hot keys are spread.
    """
    context = enrichment.select(
        *KEYS,
        "source_id",
        F.col("temperature_fahrenheit").alias("avg_temperature_fahrenheit"),
        "population",
        F.col("gdp_per_capita").alias("gdp_per_capita_usd"),
        "industrial_activity_index",
    )
    return joins.left_join_fanout(
        base, context, KEYS, spread_by="source_id", left_rows=dims.key_bound()
    )


def base_rows(raw_eia: DataFrame, dims: Dimensions) -> DataFrame:
    """Fact rows before enrichment from one scan of the raw layer."""
    cube = aggregates.energy_cube(staging.tag_energy(raw_eia))
    return with_measures(look_up_keys(aggregates.pivot_cube(cube), dims))


def base_rows_staged(
    generation: DataFrame, consumption: DataFrame, dims: Dimensions
) -> DataFrame:
    """The same rows from the staging models: pivot each, look up, then left join."""
    keyed = look_up_keys(aggregates.pivot_generation(generation), dims)
    consumed = aggregates.pivot_consumption(consumption)
    return with_measures(joins.left_join_aggregates(keyed, consumed, KEYS))


def build(
    raw_eia: DataFrame, raw_enrichment: DataFrame, dims: Dimensions | None = None
) -> DataFrame:
    dims = dims or Dimensions.seeds(raw_eia.sparkSession)
    enrichment = staging.stage_enrichment(raw_enrichment)
    return add_enrichment(base_rows(raw_eia, dims), enrichment, dims).select(*OUTPUT_COLUMNS)


def build_staged(
    generation: DataFrame, consumption: DataFrame, enrichment: DataFrame,
    dims: Dimensions | None = None,
) -> DataFrame:
    dims = dims or Dimensions.seeds(generation.sparkSession)
    base = base_rows_staged(generation, consumption, dims)
    return add_enrichment(base, enrichment, dims).select(*OUTPUT_COLUMNS)


def stamped(fact: DataFrame, now: Column | None = None) -> DataFrame:
    """Add created_at and updated_at; kept apart so that a fact can be compared."""
    when = (F.current_timestamp() if now is None else now).cast("timestamp_ntz")
    return fact.withColumns({"created_at": when, "updated_at": when})


SINK_ORDER = ["location_key", *ENRICHMENT_COLUMNS]
