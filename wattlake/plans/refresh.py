"""Stored mart: full rebuild and refresh of the months that changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions import scalar
from wattlake.plans import fact as fact_model
from wattlake.sources import scans

PARTITIONS = ["year", "month"]


def with_partitions(fact: DataFrame) -> DataFrame:
    key = F.col("time_key")
    return fact.withColumns(
        {
            "year": F.floor(key / 10_000).cast("int"),
            "month": (F.floor(key / 100) % 100).cast("int"),
        }
    )


def rebuild(fact: DataFrame, path: str) -> None:
    scans.write_table(with_partitions(fact), path, PARTITIONS)


def month_of(period: Column) -> Column:
    """YYYYMM of a period text, NULL where it is no date."""
    return F.date_format(scalar.period_date(period), "yyyyMM").cast("int")


def changed_months(
    *changed: DataFrame, dims: fact_model.Dimensions | None = None
) -> list[int]:
    """Months (YYYYMM) that new raw rows touch, among those of the time dimension.

    They come to the driver, which is safe: only months of the calendar can reach the mart, and
    all others are left out before the collect. Give the same ``dims`` as to refresh().
    """
    found: set[int] = set()
    for rows in changed:
        time = (dims or fact_model.Dimensions.seeds(rows.sparkSession)).time
        calendar = time.select(F.date_format("date", "yyyyMM").cast("int").alias("m")).distinct()
        months = rows.select(month_of(F.col("period")).alias("m")).distinct()
        found |= {row.m for row in months.join(calendar, "m", "left_semi").collect()}
    return sorted(found)


def refresh(
    raw_eia: DataFrame, raw_enrichment: DataFrame, months: list[int], path: str,
    dims: fact_model.Dimensions | None = None,
) -> None:
    """Recompute the changed months and put them in place of their old partitions.

    The periods are texts that begin with year and month, so a plain text range of the months
    reaches the raw scan. The raw layer only grows, so no month of the mart can become empty.
    """
    if not months:
        return
    fact = fact_model.build(_of_months(raw_eia, months), _of_months(raw_enrichment, months), dims)
    rows = with_partitions(fact)
    rows.hint("rebalance", *PARTITIONS).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*PARTITIONS).parquet(path)


def _of_months(raw: DataFrame, months: list[int]) -> DataFrame:
    prefixes = [f"{m // 100:04d}-{m % 100:02d}" for m in months]
    period = F.col("period")
    in_range = period.between(min(prefixes), max(prefixes) + "~")
    return raw.filter(in_range & F.substring(period, 1, 7).isin(prefixes))
