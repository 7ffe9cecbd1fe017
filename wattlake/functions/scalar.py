"""Parsing, standardising and rating of single values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattlake.schemas import ENERGY

# Location types that keep a two-letter code as it is.
CENSUS_DIVISIONS = [
    "pacific", "east south central", "west south central", "east north central",
    "west north central", "mountain", "new england", "middle atlantic", "south atlantic",
]
# Energy sources and sectors with a measure of their own.
RENEWABLE = ["solar", "wind", "hydro"]
FOSSIL = ["coal", "natural_gas"]
NAMED_SOURCES = ["coal", "natural_gas", "nuclear", "solar", "wind", "hydro"]
NAMED_SECTORS = ["residential", "commercial", "industrial", "transportation"]
# Plausible temperatures.
MIN_TEMPERATURE_F, MAX_TEMPERATURE_F = -50, 150

# \z and not $: a Java $ also matches before a closing line break.
DAY = r"^\d{4}-\d{2}-\d{2}\z"
MONTH = r"^\d{4}-\d{2}\z"
YEAR = r"^\d{4}\z"


def period_date(period: Column) -> Column:
    """First day of a YYYY-MM period, the day of a YYYY-MM-DD one, else NULL.

    Dates that match the shape but do not exist (2024-13) become NULL. The shape is checked
    already, so a cast does: it takes half the time of a date format.
    """
    return F.when(period.rlike(MONTH), F.concat(period, F.lit("-01")).try_cast("date")).when(
        period.rlike(DAY), period.try_cast("date")
    )


def period_type(period: Column) -> Column:
    return (
        F.when(period.rlike(DAY), "daily")
        .when(period.rlike(MONTH), "monthly")
        .when(period.rlike(YEAR), "annual")
        .otherwise("unknown")
    )


def clean_lower(text: Column) -> Column:
    return F.trim(F.lower(text))


def clean_upper(text: Column) -> Column:
    return F.trim(F.upper(text))


def standard_location(location: Column, location_type: Column) -> Column:
    """Upper-case code; two letters get the US- prefix unless the type is a division.

    The raw type is compared, neither lowered nor trimmed, and a NULL type makes the
    condition NULL: such codes stay without prefix.
    """
    code = clean_upper(location)
    is_short = F.length(F.trim(location)) == 2
    return F.when(
        is_short & ~location_type.isin(*CENSUS_DIVISIONS), F.concat(F.lit("US-"), code)
    ).otherwise(code)


def to_mwh(value: Column, units: Column) -> Column:
    """Energy in MWh by the unit's text; unknown and missing units count as MWh.

    "thousand MWh" contains "mwh" and is therefore taken as plain MWh. One exact decimal
    factor keeps the result free of division.
    """
    unit = F.lower(units)
    factor = (
        F.when(unit.contains("mwh"), F.lit(Decimal("1.000")))
        .when(unit.contains("gwh"), F.lit(Decimal("1000.000")))
        .when(unit.contains("kwh"), F.lit(Decimal("0.001")))
        .otherwise(F.lit(Decimal("1.000")))
    )
    return (value * factor).cast(ENERGY)


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the parts as text; a NULL part is empty but keeps its separator."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("|"))
        pieces.append(F.coalesce(part.cast("string"), F.lit("")))
    return F.md5(F.concat(*pieces))


def plausible_temperature(temperature: Column) -> Column:
    return F.when(temperature.between(MIN_TEMPERATURE_F, MAX_TEMPERATURE_F), temperature)


def temperature_category(temperature: Column) -> Column:
    return (
        F.when(temperature < 32, "freezing")
        .when(temperature.between(32, 50), "cold")
        .when(temperature.between(50, 70), "moderate")
        .when(temperature.between(70, 85), "warm")
        .when(temperature > 85, "hot")
        .otherwise("unknown")
    )


def population_category(population: Column) -> Column:
    return (
        F.when(population < 1_000_000, "small")
        .when(population.between(1_000_000, 5_000_000), "medium")
        .when(population.between(5_000_000, 15_000_000), "large")
        .when(population > 15_000_000, "very_large")
        .otherwise("unknown")
    )


def industrial_category(index: Column) -> Column:
    return (
        F.when(index < 90, "low")
        .when(index.between(90, 110), "normal")
        .when(index > 110, "high")
        .otherwise("unknown")
    )


def _exact_ratio(part: Column, whole: Column, factor: int, digits: int) -> Column:
    """factor * part / whole, rounded half up, by whole numbers: no binary fraction comes in.

    For parts that are not negative and a positive whole, of at most 7 decimals each.
    """
    wide = "decimal(24,7)"
    scale = F.lit(2 * factor * 10**digits).cast("decimal(12,0)")
    doubled = part.cast(wide) * scale + whole.cast(wide)
    quotient = F.call_function("div", doubled, whole.cast(wide) * F.lit(2).cast("decimal(1,0)"))
    return quotient.cast("double") / float(10**digits)


def share_percent(part: Column, total: Column) -> Column:
    """Percentage with two decimals; 0 where the total is not positive."""
    return F.when(total > 0, _exact_ratio(part, total, 100, 2)).otherwise(F.lit(0.0))


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    """Ratio with four decimals; NULL where the denominator is missing or not positive."""
    return F.when(denominator > 0, _exact_ratio(numerator, denominator, 1, 4))


def per_million_people(energy: Column, population: Column) -> Column:
    """Energy per million people, two decimals; NULL without energy or population."""
    return F.when(population > 0, _exact_ratio(energy, population, 1_000_000, 2))


def zero_safe_percent(part: Column, total: Column) -> Column:
    """Unrounded percentage; 0.0 where the total is zero."""
    ratio = part.cast("double") / total.cast("double") * 100
    return F.when(total == 0, F.lit(0.0)).otherwise(ratio)


def renewable_band(percent: Column) -> Column:
    return F.when(percent >= 50, "green").when(percent >= 25, "orange").otherwise("red")


def location_label(location_key: Column) -> Column:
    return F.concat(F.lit("LOC_"), location_key.cast("string"))


def display_date(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def time_key(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def date_of_time_key(key: Column) -> Column:
    return F.to_date(key.cast("string"), "yyyyMMdd")
