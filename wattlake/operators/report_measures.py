"""Aggregates of the report over the fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions import scalar

COMPLETENESS_COLUMNS = {
    "generation": "total_generation_mwh",
    "renewable": "renewable_percentage",
    "temperature": "avg_temperature_fahrenheit",
    "population": "population",
}


def with_report_columns(fact: DataFrame) -> DataFrame:
    """Date, year, month and location label from the keys."""
    date = scalar.date_of_time_key(F.col("time_key"))
    return fact.withColumns(
        {
            "date": date,
            "year": F.year(date),
            "month": F.month(date),
            "location": scalar.location_label(F.col("location_key")),
        }
    )


def sum_by_location(rows: DataFrame, metric: str = "total_generation_mwh") -> DataFrame:
    return rows.groupBy("location").agg(F.sum(metric).alias(metric))


def mean_renewable_by_location(rows: DataFrame) -> DataFrame:
    return rows.groupBy("location").agg(
        F.avg(F.col("renewable_percentage").cast("double")).alias("renewable_percentage")
    )


def ranked(rows: DataFrame, measure: str) -> DataFrame:
    return rows.orderBy(F.desc_nulls_last(measure), "location")


def top(rows: DataFrame, measure: str, n: int = 3) -> DataFrame:
    return ranked(rows, measure).limit(n)


def generation_matrix(rows: DataFrame, locations: Sequence[str]) -> DataFrame:
    """Dates by locations, 0 where a location has nothing. The labels come from the location
    dimension, so no job is needed to find them; a location without a label is an error."""
    label = F.col("location")
    missing = F.raise_error(F.concat(F.lit("no column for location "), label))
    known = F.when(label.isNull() | label.isin(*locations), label).otherwise(missing)
    return (
        rows.select("date", known.alias("location"), "total_generation_mwh")
        .groupBy("date")
        .pivot("location", list(locations))
        .agg(F.sum("total_generation_mwh"))
        .fillna(0)
    )


def generation_over_time(rows: DataFrame, locations: Sequence[str]) -> DataFrame:
    """(date, location, mwh) rows of all dates and locations, zeros included.

    A location is one of the rows or of the given labels. The names are as few as the location
    dimension has; a scalar subquery finds those of the rows, and every date unfolds the list, so
    the grid needs no join of all pairs.
    """
    totals = rows.groupBy("date", "location").agg(F.sum("total_generation_mwh").alias("mwh"))
    own = totals.agg(F.collect_set("location").alias("own")).scalar()
    given = F.array(*(F.lit(x) for x in locations)) if locations else F.array().cast("array<string>")
    dates = totals.select("date").distinct()
    grid = dates.select("date", F.explode(F.array_union(own, given)).alias("location"))
    return grid.join(totals, ["date", "location"], "left").select(
        "date", "location", F.coalesce("mwh", F.lit(0).cast("decimal(24,7)")).alias("total_generation_mwh")
    )


def monthly_renewable(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("year", "month", "location")
        .agg(F.avg(F.col("renewable_percentage").cast("double")).alias("renewable_percentage"))
        .withColumn("date", F.make_date("year", "month", F.lit(1)))
    )


def temperature_correlation(rows: DataFrame) -> DataFrame:
    """Pearson's r of temperature and generation; pairs with a NULL do not count."""
    x = F.col("avg_temperature_fahrenheit").cast("double")
    y = F.col("total_generation_mwh").cast("double")
    return rows.agg(F.corr(x, y).alias("correlation"))


def economic_means(rows: DataFrame) -> DataFrame:
    measures = ["total_generation_mwh", "gdp_per_capita_usd", "population"]
    return rows.groupBy("location").agg(
        *(F.avg(F.col(m).cast("double")).alias(m) for m in measures)
    )


def key_figures(rows: DataFrame) -> DataFrame:
    """All global figures of the report in one pass, as one row."""

    def mean(column: str) -> Column:
        return F.avg(F.col(column).cast("double"))

    temperature = F.col("avg_temperature_fahrenheit").cast("double")
    generation = F.col("total_generation_mwh").cast("double")
    return rows.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_distinct("location").alias("locations"),
        F.sum("total_generation_mwh").alias("total_generation_mwh"),
        mean("total_generation_mwh").alias("mean_generation_mwh"),
        F.max("total_generation_mwh").alias("max_generation_mwh"),
        mean("renewable_percentage").alias("mean_renewable_percentage"),
        F.max("renewable_percentage").alias("max_renewable_percentage"),
        mean("avg_temperature_fahrenheit").alias("mean_temperature_fahrenheit"),
        mean("population").alias("mean_population"),
        mean("gdp_per_capita_usd").alias("mean_gdp_per_capita_usd"),
        F.corr(temperature, generation).alias("temperature_generation_correlation"),
    )


def locations_with_majority(rows: DataFrame, threshold: float = 50.0) -> DataFrame:
    """How many locations reach the threshold with their mean renewable share, of how many."""
    return mean_renewable_by_location(rows).agg(
        F.count_if(F.col("renewable_percentage") >= threshold).alias("locations_at_least"),
        F.count(F.lit(1)).alias("locations"),
    )


def completeness(rows: DataFrame) -> DataFrame:
    """Percentage of non-null values of four columns in one pass."""
    n = F.count(F.lit(1))
    return rows.agg(
        *(
            F.when(n > 0, F.count(column) / n * 100).alias(f"{name}_completeness")
            for name, column in COMPLETENESS_COLUMNS.items()
        )
    )
