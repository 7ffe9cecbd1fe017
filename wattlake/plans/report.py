"""Report tables over the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions import scalar
from wattlake.operators import dimensions, report_measures
from wattlake.operators.describe import describe
from wattlake.sources.scans import REPORT_COLUMNS

SEED_LABELS = [f"LOC_{key}" for key in range(1, len(dimensions.LOCATIONS) + 1)]
DESCRIBED_COLUMNS = REPORT_COLUMNS


def generation_by_location(rows: DataFrame) -> DataFrame:
    totals = report_measures.sum_by_location(rows)
    return report_measures.ranked(totals, "total_generation_mwh")


def generation_trend(rows: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Every location of the rows, and those of the labels (the seeds) also without any row."""
    return report_measures.generation_over_time(rows, labels or SEED_LABELS)


def renewable_by_location(rows: DataFrame) -> DataFrame:
    means = report_measures.mean_renewable_by_location(rows)
    banded = means.withColumn("band", scalar.renewable_band(F.col("renewable_percentage")))
    return report_measures.ranked(banded, "renewable_percentage")


def renewable_trend(rows: DataFrame) -> DataFrame:
    return report_measures.monthly_renewable(rows).select(
        F.col("date").alias("month"), "location", "renewable_percentage"
    )


def temperature_points(rows: DataFrame) -> DataFrame:
    return rows.select("location", "avg_temperature_fahrenheit", "total_generation_mwh")


def economic_scatter(rows: DataFrame) -> DataFrame:
    return report_measures.economic_means(rows)


def summary(rows: DataFrame) -> DataFrame:
    """(metric, value) rows of all key figures, dates as YYYYMMDD numbers."""
    figures = report_measures.key_figures(rows)
    majority = report_measures.locations_with_majority(rows).select(
        F.array(
            F.struct(
                F.lit("locations_at_least_half_renewable").alias("metric"),
                F.col("locations_at_least").cast("double").alias("value"),
            )
        ).alias("figures")
    )
    dates = {"first_date", "last_date"}
    pairs = [
        F.struct(
            F.lit(c).alias("metric"),
            (scalar.time_key(F.col(c)) if c in dates else F.col(c)).cast("double").alias("value"),
        )
        for c in figures.columns
    ]
    wide = figures.select(F.array(*pairs).alias("figures"))
    return wide.unionByName(majority).select(F.inline("figures"))


def quality_summary(rows: DataFrame) -> DataFrame:
    """Completeness of four columns and the statistics of all, as (subject, stat, value)."""
    complete = report_measures.completeness(rows)
    shares = complete.unpivot([], complete.columns, "subject", "value").select(
        F.regexp_replace("subject", "_completeness$", "").alias("subject"),
        F.lit("completeness").alias("stat"),
        F.col("value").cast("double").alias("value"),
    )
    stats = describe(rows, DESCRIBED_COLUMNS)
    doubles = stats.select(
        F.col("column").alias("subject"),
        *(F.col(c).cast("double").alias(c) for c in stats.columns if c != "column"),
    )
    return shares.unionByName(doubles.unpivot("subject", doubles.columns[1:], "stat", "value"))
