"""Aggregates of energy by period and location."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.scalar import FOSSIL, NAMED_SECTORS, NAMED_SOURCES, RENEWABLE

PERIOD_LOCATION = ["period_date", "location"]

SOURCE_MEASURES = [f"{s}_generation_mwh" for s in NAMED_SOURCES]
GENERATION_MEASURES = [
    *SOURCE_MEASURES, "other_generation_mwh", "total_generation_mwh",
    "renewable_generation_mwh", "fossil_generation_mwh",
]
SECTOR_MEASURES = [f"{s}_consumption_mwh" for s in NAMED_SECTORS]
CONSUMPTION_MEASURES = [*SECTOR_MEASURES, "total_consumption_mwh"]


def _sum(amount: str, condition: str, only: str | None, name: str) -> Column:
    wanted = condition if only is None else f"{only} AND {condition}"
    return F.expr(f"sum(CASE WHEN {wanted} THEN {amount} ELSE 0 END) AS {name}")


def _total(amount: str, only: str | None, name: str) -> Column:
    """Sum of the rows in question, NULL if there are none."""
    return F.expr(f"sum({amount if only is None else f'CASE WHEN {only} THEN {amount} END'}) AS {name}")


def _any_of(column: str, texts: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(t) for t in texts)})"


def generation_sums(mwh: str = "generation_mwh", only: str | None = None) -> list[Column]:
    """Ten sums in one pass: by source, other, total, renewable and fossil.

    ``only`` names a flag column that narrows them to some of the rows.
    """
    kinds = {f"{s}_generation_mwh": _any_of("energy_source", [s]) for s in NAMED_SOURCES}
    kinds["other_generation_mwh"] = f"NOT {_any_of('energy_source', NAMED_SOURCES)}"
    groups = {
        "renewable_generation_mwh": _any_of("energy_source", RENEWABLE),
        "fossil_generation_mwh": _any_of("energy_source", FOSSIL),
    }
    return [
        *(_sum(mwh, condition, only, name) for name, condition in kinds.items()),
        _total(mwh, only, "total_generation_mwh"),
        *(_sum(mwh, condition, only, name) for name, condition in groups.items()),
    ]


def consumption_sums(mwh: str = "consumption_mwh", only: str | None = None) -> list[Column]:
    """The sums of the four named sectors and of all rows."""
    return [
        *(_sum(mwh, _any_of("sector", [s]), only, f"{s}_consumption_mwh") for s in NAMED_SECTORS),
        _total(mwh, only, "total_consumption_mwh"),
    ]


def pivot_generation(staged: DataFrame) -> DataFrame:
    return staged.groupBy(*PERIOD_LOCATION).agg(*generation_sums())


def pivot_consumption(staged: DataFrame) -> DataFrame:
    return staged.groupBy(*PERIOD_LOCATION).agg(*consumption_sums())


def aggregate_generation(staged: DataFrame) -> DataFrame:
    """Totals, kinds, number of sources and latest ingestion by period, location and type."""
    sums = {
        "total_generation_mwh", "renewable_generation_mwh", "fossil_generation_mwh",
        "nuclear_generation_mwh", "other_generation_mwh",
    }
    by_source = staged.groupBy(*PERIOD_LOCATION, "location_type", "energy_source").agg(
        F.sum("generation_mwh").alias("generation_mwh"),
        F.max("ingestion_timestamp").alias("ingestion_timestamp"),
    )
    # After the first grouping each source is one row, so a plain count counts them distinct.
    pivoted = by_source.groupBy(*PERIOD_LOCATION, "location_type").agg(
        *generation_sums(),
        F.count("energy_source").alias("energy_source_count"),
        F.max("ingestion_timestamp").alias("generation_ingested_at"),
    )
    return pivoted.select(
        *PERIOD_LOCATION, "location_type",
        *(c for c in GENERATION_MEASURES if c in sums),
        "energy_source_count", "generation_ingested_at",
    )


def aggregate_consumption(staged: DataFrame) -> DataFrame:
    by_sector = staged.groupBy(*PERIOD_LOCATION, "sector").agg(
        F.sum("consumption_mwh").alias("consumption_mwh"),
        F.max("ingestion_timestamp").alias("ingestion_timestamp"),
    )
    return by_sector.groupBy(*PERIOD_LOCATION).agg(
        *consumption_sums(),
        F.count("sector").alias("sector_count"),
        F.max("ingestion_timestamp").alias("consumption_ingested_at"),
    )


def energy_cube(tagged: DataFrame, *extra_keys: str) -> DataFrame:
    """One sum for each combination of period, location, source, sector and kind.

    The raw layer is read once for generation and consumption together, every row costs one
    decimal addition, and the partial sums of each task leave little to shuffle however many
    rows a single location or source holds. Rows without a date end in groups of their own,
    which are dropped by their count of dates.
    """
    return (
        tagged.groupBy(
            *PERIOD_LOCATION, *extra_keys, "energy_source", "sector", "is_generation",
            "is_consumption",
        )
        .agg(
            F.sum("mwh").alias("mwh"),
            F.max("ingestion_timestamp").alias("ingestion_timestamp"),
            F.count("period_date").alias("dated_rows"),
        )
        .filter("dated_rows > 0")
        # Both keys are set by now. Saying so keeps later joins from sending a not-null test
        # of the parsed keys down to the raw scan, where it would parse every row once more.
        .withColumns(
            {
                "period_date": F.coalesce("period_date", F.lit(datetime.date(1970, 1, 1))),
                "location": F.coalesce("location", F.lit("")),
            }
        )
        .drop("dated_rows")
    )


def pivot_cube(cube: DataFrame) -> DataFrame:
    """Generation by source and consumption by sector side by side, for every period and
    location that has generation (consumption totals stay NULL where there is none)."""
    return (
        cube.groupBy(*PERIOD_LOCATION)
        .agg(
            *generation_sums("mwh", "is_generation"),
            *consumption_sums("mwh", "is_consumption"),
            F.bool_or("is_generation").alias("has_generation"),
        )
        .filter("has_generation")
        .drop("has_generation")
    )
