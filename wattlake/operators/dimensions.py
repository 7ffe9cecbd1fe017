"""Calendar, energy-source and location dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake import schemas
from wattlake.functions import scalar

# Range of the calendar and the seed rows, keys in order of insertion.
CALENDAR_START, CALENDAR_END, CALENDAR_DAYS = "2020-01-01", "2030-12-31", 4018

ENERGY_SOURCES = [
    ("COAL", "Coal", "fossil", False, 820),
    ("NG", "Natural Gas", "fossil", False, 490),
    ("NUC", "Nuclear", "nuclear", False, 12),
    ("SUN", "Solar", "renewable", True, 45),
    ("WND", "Wind", "renewable", True, 11),
    ("HYD", "Hydroelectric", "renewable", True, 24),
    ("OTH", "Other", "other", False, 100),
]
LOCATIONS = [
    ("US", "United States", "national", "National"),
    ("US-NE", "Northeast", "region", "Northeast"),
    ("US-MW", "Midwest", "region", "Midwest"),
    ("US-S", "South", "region", "South"),
    ("US-W", "West", "region", "West"),
    ("US-CA", "California", "state", "West"),
    ("US-TX", "Texas", "state", "South"),
    ("US-NY", "New York", "state", "Northeast"),
    ("US-FL", "Florida", "state", "South"),
    ("US-IL", "Illinois", "state", "Midwest"),
]


def calendar_days(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row for each day from start to end of every row of ``bounds``."""
    return bounds.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("date"))


def calendar_columns(date: Column) -> dict[str, Column]:
    """Attributes of a day. Names are padded to nine characters, days count from Monday."""
    weekday = F.weekday(date) + 1
    return {
        "time_key": scalar.time_key(date),
        "year": F.year(date),
        "quarter": F.quarter(date),
        "month": F.month(date),
        "month_name": F.rpad(F.date_format(date, "MMMM"), 9, " "),
        "day_of_month": F.dayofmonth(date),
        "day_of_week": weekday,
        "day_name": F.rpad(F.date_format(date, "EEEE"), 9, " "),
        "week_of_year": F.weekofyear(date),
        "is_weekend": weekday >= 6,
        "is_holiday": F.lit(False),
    }


def dim_time(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    one_row = spark.range(0, 1, 1, 1)
    days = calendar_days(one_row, F.lit(start).cast("date"), F.lit(end).cast("date"))
    columns = calendar_columns(F.col("date"))
    key = columns.pop("time_key").alias("time_key")
    return days.select(key, "date", *(c.alias(name) for name, c in columns.items()))


def _seed_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Literal rows as a relation of the plan itself: its size is known, no job makes it."""

    def literal(value: object) -> str:
        return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)

    table = ", ".join(f"({', '.join(literal(v) for v in row)})" for row in rows)
    values = spark.sql(f"SELECT * FROM VALUES {table} AS t({', '.join(schema.fieldNames())})")
    return values.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def dim_energy_source(spark: SparkSession) -> DataFrame:
    rows = [(key, *row) for key, row in enumerate(ENERGY_SOURCES, start=1)]
    return _seed_rows(spark, rows, schemas.DIM_ENERGY_SOURCE)


def dim_location(spark: SparkSession) -> DataFrame:
    rows = [(key, *row, None, None, None) for key, row in enumerate(LOCATIONS, start=1)]
    return _seed_rows(spark, rows, schemas.DIM_LOCATION)


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` to append: those whose key is in neither ``existing`` nor an earlier
    row of the batch."""
    keys = list(keys)
    return new.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")
