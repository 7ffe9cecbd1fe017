"""Row rules of the staging layer.

The rules keep SQL's three-valued logic: a NULL series id fails the generation rule and
passes the consumption rule only by its sector.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _series_has(word: str) -> Column:
    return F.lower("series_id").contains(word)


def _set(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows where all columns are set. Single tests reach the Parquet reader, which the
    combined test of ``dropna`` does not."""
    return rows.filter(reduce(Column.__and__, (F.col(c).isNotNull() for c in columns)))


def is_generation() -> Column:
    return (
        F.col("energy_source").isNotNull()
        & (F.col("value") >= 0)
        & ~_series_has("sales")
        & ~_series_has("consumption")
        & ~_series_has("revenue")
    )


def is_consumption() -> Column:
    by_series = (_series_has("sales") | _series_has("consumption")) & ~_series_has("generation")
    return (F.col("value") >= 0) & (F.col("sector").isNotNull() | by_series)


def generation_rows(raw_eia: DataFrame) -> DataFrame:
    return raw_eia.filter(is_generation())


def consumption_rows(raw_eia: DataFrame) -> DataFrame:
    return raw_eia.filter(is_consumption())


def enrichment_rows(raw_enrichment: DataFrame) -> DataFrame:
    return _set(raw_enrichment, "period", "location", "temperature_avg", "population")


def parsed_generation(staged: DataFrame) -> DataFrame:
    """Rows with a date and a place. Their source and value cannot be missing any more:
    the generation rule requires both, and neither cleaning nor scaling makes a NULL."""
    return _set(staged, "period_date", "location")


def parsed_consumption(staged: DataFrame) -> DataFrame:
    return _set(staged, "period_date", "location")


def parsed_enrichment(staged: DataFrame) -> DataFrame:
    """The enrichment rule has required location and temperature already."""
    return _set(staged, "period_date")
