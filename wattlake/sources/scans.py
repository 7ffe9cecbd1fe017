"""Table scans with pushed-down bounds, views and written tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions import scalar
from wattlake.sources.landing import require_month

_FREQUENCY_SHAPE = {
    "monthly": scalar.MONTH,
    "daily": scalar.DAY,
    "annual": scalar.YEAR,
    "quarterly": r"^\d{4}-Q[1-4]$",
}

REPORT_COLUMNS = [
    "time_key", "location_key", "total_generation_mwh", "renewable_percentage",
    "renewable_generation_mwh", "fossil_generation_mwh", "coal_generation_mwh",
    "natural_gas_generation_mwh", "nuclear_generation_mwh", "solar_generation_mwh",
    "wind_generation_mwh", "hydro_generation_mwh", "total_consumption_mwh",
    "net_generation_mwh", "avg_temperature_fahrenheit", "population", "gdp_per_capita_usd",
    "industrial_activity_index",
]
METRIC_COLUMNS = [
    "time_key", "location_key", "total_generation_mwh", "renewable_percentage",
    "avg_temperature_fahrenheit",
]
# Ties of time_key are broken by further columns, so a limit always keeps the same rows.
_TIE_BREAKERS = [
    "location_key", "avg_temperature_fahrenheit", "population", "gdp_per_capita_usd",
    "industrial_activity_index",
]


def _bound(month: str, frequency: str) -> str:
    """The period of a frequency that holds a month."""
    if frequency not in _FREQUENCY_SHAPE:
        raise ValueError(f"frequency {frequency!r} is none of {sorted(_FREQUENCY_SHAPE)}")
    if frequency == "annual":
        return month[:4]
    if frequency == "quarterly":
        return f"{month[:4]}-Q{(int(month[5:]) + 2) // 3}"
    return month


def fetch_period_range(
    landed: DataFrame, start: str, end: str, location: str | None = None,
    frequency: str = "monthly",
) -> DataFrame:
    """Rows of a landed dataset from month ``start`` to month ``end``, both included.

    Plain comparisons on stored columns: they reach the Parquet reader and prune row
    groups, and partitions where the dataset is partitioned by period.
    """
    low, high = (_bound(require_month(month), frequency) for month in (start, end))
    period = F.col("period")
    # "~" sorts after every digit and "-", so days within the last month are included.
    rows = landed.filter(period.between(low, high + "~" if frequency == "daily" else high))
    rows = rows.filter(period.rlike(_FREQUENCY_SHAPE[frequency]))
    return rows if location is None else rows.filter(F.col("location") == location)


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make tables known to ``spark.table`` and SQL; nothing is computed or stored."""
    for name, table in tables.items():
        table.createOrReplaceTempView(prefix + name)


def write_table(table: DataFrame, path: str, partition_by: list[str]) -> None:
    """Write a table anew, partitioned. The rebalance hint lets AQE split a partition value
    that holds much of the data over several tasks, and join small ones."""
    table.hint("rebalance", *partition_by).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(*partition_by).parquet(path)


def newest(fact: DataFrame, columns: list[str], n: int) -> DataFrame:
    """The n newest fact rows: a top-n in every task, then one merge of n rows each."""
    order = [F.desc("time_key")] + [F.asc_nulls_last(c) for c in _TIE_BREAKERS]
    return fact.orderBy(*order).limit(n).select(*columns)


def report_scan(fact: DataFrame, n: int = 5_000) -> DataFrame:
    return newest(fact, REPORT_COLUMNS, n)


def metrics_scan(fact: DataFrame, n: int = 1_000) -> DataFrame:
    return newest(fact, METRIC_COLUMNS, n)
