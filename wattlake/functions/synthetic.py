"""Deterministic synthetic enrichment values from a SHA-256 of a seed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODULUS = 1_000_000
_DIGITS = 15  # hex digits that fit a signed long


def sha256_mod(seed: Column) -> Column:
    """SHA-256 of the seed, read as a 256-bit integer, modulo one million.

    The 64 hex digits are cut into pieces that fit a long. Each piece is reduced first and
    weighted with its place value modulo one million, so no product can overflow.
    """
    digest = F.sha2(seed, 256)
    total: Column = F.lit(0).cast("long")
    for start in range(0, 64, _DIGITS):
        width = min(_DIGITS, 64 - start)
        place = pow(16, 64 - start - width, MODULUS)
        piece = F.conv(F.substring(digest, start + 1, width), 16, 10).cast("long")
        total = total + (piece % MODULUS) * F.lit(place).cast("long")
    return total % MODULUS


def hash_to_range(seed: Column, low: float, high: float) -> Column:
    """A double in [low, high) that depends on nothing but the seed."""
    unit = sha256_mod(seed).cast("double") / F.lit(float(MODULUS))
    return F.lit(float(low)) + unit * F.lit(float(high) - float(low))


def round_exact(x: Column, places: int, binary_places: int) -> Column:
    """Round the exact binary value of a positive double half-even, as IEEE tools do.

    ``F.round`` works on the shortest decimal text of a double and differs near ties.
    ``x * 2**binary_places`` must be a whole number below 2**63 / 10**places.
    """
    scale = F.lit(10**places).cast("long")
    unit = F.lit(2**binary_places).cast("long")
    scaled = (x * F.lit(float(2**binary_places))).cast("long") * scale
    rest = scaled % unit
    whole = F.shiftright(scaled, binary_places)
    half = F.lit(2 ** (binary_places - 1)).cast("long")
    up = (rest > half) | ((rest == half) & (whole % 2 == 1))
    return (whole + F.when(up, 1).otherwise(0)).cast("double") / F.lit(float(10**places))


def _seed(*parts: Column | str) -> Column:
    texts: list[Column] = []
    for part in parts:
        if texts:
            texts.append(F.lit(":"))
        texts.append(F.lit(part) if isinstance(part, str) else part)
    return F.concat(*texts)


# Fixed values in the four functions: seed suffixes, ranges and decimals. The number of
# binary places is the finest one that a double of that range can have.
def temperature(location: Column, period: Column) -> Column:
    return round_exact(hash_to_range(_seed(location, period, "temperature"), 10.0, 95.0), 1, 49)


def population(location: Column) -> Column:
    return hash_to_range(_seed(location, "population"), 500_000.0, 40_000_000.0).cast("long")


def gdp_per_capita(location: Column, period: Column) -> Column:
    return round_exact(hash_to_range(_seed(location, period, "gdp"), 40_000.0, 100_000.0), 2, 37)


def industrial_activity_index(location: Column, period: Column) -> Column:
    return round_exact(hash_to_range(_seed(location, period, "industrial"), 70.0, 130.0), 1, 46)
