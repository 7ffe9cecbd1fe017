"""Month ranges, location-by-period grids and synthetic enrichment records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions import synthetic

PUBLICATION_LAG_DAYS, WINDOW_DAYS = 60, 90


def month_starts(start: Column, end: Column) -> Column:
    """Array of the first days of all months from start to end, both included.

    The array is empty where end lies in a month before start, as a counting loop would be.
    """
    first, last = F.trunc(start, "MM").cast("date"), F.trunc(end, "MM").cast("date")
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return F.when(first <= last, months).otherwise(F.array().cast("array<date>"))


def expand_months(ranges: DataFrame, start: str, end: str, keep: list[str]) -> DataFrame:
    """One row with ``month`` (YYYY-MM) for each month of every range."""
    months = F.explode(month_starts(F.col(start), F.col(end)))
    return ranges.select(*keep, months.alias("first_day")).select(
        *keep, F.date_format("first_day", "yyyy-MM").alias("month")
    )


def expand_first_days(ranges: DataFrame, start: str, end: str, keep: list[str]) -> DataFrame:
    return ranges.select(
        *keep, F.explode(month_starts(F.col(start), F.col(end))).alias("first_day")
    )


def location_period_grid(locations: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every location with the first day of every month, as text. Each location row expands
    by itself, so there is neither a join nor a shuffle."""
    return locations.select(
        "location", F.explode(month_starts(start, end)).alias("first_day")
    ).select("location", F.date_format("first_day", "yyyy-MM-dd").alias("period"))


def rolling_window(as_of: Column) -> tuple[Column, Column]:
    """First and last month (YYYY-MM) to fetch on a day: 90 days that end 60 days before."""
    end = F.date_sub(as_of, PUBLICATION_LAG_DAYS)
    start = F.date_sub(end, WINDOW_DAYS)
    return F.date_format(start, "yyyy-MM"), F.date_format(end, "yyyy-MM")


def enrichment_records(grid: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The six-field synthetic record of each location and period."""
    location, period = F.col("location"), F.col("period")
    return grid.select(
        *(keep or []),
        "location",
        "period",
        synthetic.temperature(location, period).alias("temperature_fahrenheit"),
        synthetic.population(location).alias("population"),
        synthetic.gdp_per_capita(location, period).alias("gdp_per_capita_usd"),
        synthetic.industrial_activity_index(location, period).alias("industrial_activity_index"),
    )


# Limits that a generated record must keep.
RECORD_LIMITS = {
    "population_positive": "population > 0",
    "gdp_per_capita_positive": "gdp_per_capita_usd > 0",
    "industrial_activity_index_range": "industrial_activity_index between 0 and 200",
}
