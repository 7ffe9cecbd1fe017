"""Parsing, standardising and rating of single values, quirk by quirk."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal as D

from pyspark.sql import functions as F

from wattlake.functions import scalar, synthetic


def test_period_shapes(values):
    periods = ["2024-01", "2024-02-29", "2024", "n/a", "2024-13", "2024-02-30", " 2024-01", "2024-01\n", None]
    assert values(scalar.period_date(F.col("p")), "p string", *periods) == [
        dt.date(2024, 1, 1), dt.date(2024, 2, 29), None, None, None, None, None, None, None,
    ]
    assert values(scalar.period_type(F.col("p")), "p string", *periods) == [
        "monthly", "daily", "annual", "unknown", "monthly", "daily", "unknown", "unknown", "unknown",
    ]


def test_location_prefix_follows_the_raw_type(values):
    place = scalar.standard_location(F.col("l"), F.col("t"))
    rows = [
        ("ca", "state"), (" ca ", "state"), ("US", "national"), ("US-CA", "state"),
        ("ca", "mountain"), ("ca", "Mountain"), ("ca", None), ("ca", " pacific"), (None, "state"),
    ]
    assert values(place, "l string, t string", *rows) == [
        "US-CA", "US-CA", "US-US", "US-CA", "CA", "US-CA", "CA", "US-CA", None,
    ]


def test_units(values):
    mwh = scalar.to_mwh(F.col("v"), F.col("u"))
    rows = [
        (D("2"), "MWh"), (D("2"), "thousand MWh"), (D("2"), " gwh "), (D("2"), "kWh"),
        (D("2"), "megawatthours"), (D("2"), None), (None, "GWh"), (D("0.0001"), "kWh"),
        (D("99999999999999.9999"), "GWh"),
    ]
    assert values(mwh, "v decimal(18,4), u string", *rows) == [
        D("2"), D("2"), D("2000"), D("0.002"), D("2"), D("2"), None, D("0.0000001"),
        D("99999999999999999.9"),
    ]


def test_key_keeps_the_separator_of_a_null(values):
    key = scalar.surrogate_key(F.col("a"), F.col("b"), F.col("c"))
    rows = [(1, dt.date(2024, 1, 1), None), (None, None, None)]
    assert values(key, "a long, b date, c string", *rows) == [
        hashlib.md5(b"1|2024-01-01|").hexdigest(), hashlib.md5(b"||").hexdigest(),
    ]


def test_categories_take_the_first_match(values):
    t = [D("31.9"), D("32"), D("50"), D("50.1"), D("70"), D("85"), D("85.1"), None]
    assert values(scalar.temperature_category(F.col("t")), "t decimal(18,4)", *t) == [
        "freezing", "cold", "cold", "moderate", "moderate", "warm", "hot", "unknown",
    ]
    p = [999_999, 1_000_000, 5_000_000, 5_000_001, 15_000_000, 15_000_001, None]
    assert values(scalar.population_category(F.col("p")), "p long", *p) == [
        "small", "medium", "medium", "large", "large", "very_large", "unknown",
    ]
    i = [D("89.9"), D("90"), D("110"), D("110.1"), None]
    assert values(scalar.industrial_category(F.col("i")), "i decimal(18,4)", *i) == [
        "low", "normal", "normal", "high", "unknown",
    ]


def test_percentages_and_ratios(values):
    names = "x decimal(24,7), y decimal(24,7)"
    rows = [(D(450), D(1000)), (D(1), D(3)), (D(1), D(0)), (D(1), None)]
    x, y = F.col("x"), F.col("y")
    assert values(scalar.share_percent(x, y), names, *rows) == [45.0, 33.33, 0.0, 0.0]
    assert values(scalar.ratio_or_null(x, y), names, *rows) == [0.45, 0.3333, None, None]
    assert values(scalar.per_million_people(x, y), names, *rows) == [450000.0, 333333.33, None, None]
    assert values(scalar.zero_safe_percent(x, y), names, (D(450), D(1000)), (D(0), D(0))) == [45.0, 0.0]


def test_report_labels(values):
    assert values(scalar.renewable_band(F.col("p")), "p double", 50.0, 49.9, 25.0, 24.9) == [
        "green", "orange", "orange", "red",
    ]
    assert values(scalar.location_label(F.col("k")), "k int", 7) == ["LOC_7"]
    assert values(scalar.date_of_time_key(F.col("k")), "k int", 20240229) == [dt.date(2024, 2, 29)]
    assert values(scalar.time_key(F.col("d")), "d date", dt.date(2024, 2, 9)) == [20240209]
    assert values(scalar.display_date(F.col("d")), "d date", dt.date(2024, 2, 9)) == ["2024-02-09"]


def _scaled(text: str, low: float, high: float) -> float:
    number = int(hashlib.sha256(text.encode()).hexdigest(), 16)
    return low + number % 1_000_000 / 1_000_000 * (high - low)


def test_synthetic_values_equal_plain_python(spark):
    places = ["US", "US-CA", "US-TX", "Zürich", ""]
    grid = [(p, f"{y}-{m:02d}-01") for p in places for y in range(2000, 2060) for m in range(1, 13)]
    location, period = F.col("l"), F.col("p")
    rows = spark.createDataFrame(grid, "l string, p string").select(
        "l", "p",
        synthetic.sha256_mod(location).alias("residue"),
        synthetic.temperature(location, period).alias("t"),
        synthetic.population(location).alias("n"),
        synthetic.gdp_per_capita(location, period).alias("g"),
        synthetic.industrial_activity_index(location, period).alias("i"),
    ).collect()
    assert len(rows) == len(grid)
    for r in rows:
        number = int(hashlib.sha256(r.l.encode()).hexdigest(), 16)
        assert r.residue == number % 1_000_000
        assert r.t == round(_scaled(f"{r.l}:{r.p}:temperature", 10.0, 95.0), 1)
        assert r.n == int(_scaled(f"{r.l}:population", 500_000, 40_000_000))
        assert r.g == round(_scaled(f"{r.l}:{r.p}:gdp", 40_000.0, 100_000.0), 2)
        assert r.i == round(_scaled(f"{r.l}:{r.p}:industrial", 70.0, 130.0), 1)


def test_rounding_equals_plain_python_on_every_residue(spark):
    residue = F.col("id").cast("double") / F.lit(1_000_000.0)
    rounded = spark.range(1_000_000).select(
        "id",
        synthetic.round_exact(F.lit(10.0) + residue * F.lit(85.0), 1, 49).alias("t"),
        synthetic.round_exact(F.lit(40_000.0) + residue * F.lit(60_000.0), 2, 37).alias("g"),
        synthetic.round_exact(F.lit(70.0) + residue * F.lit(60.0), 1, 46).alias("i"),
    ).toPandas()
    for r in rounded.itertuples():
        unit = r.id / 1_000_000
        assert r.t == round(10.0 + unit * 85.0, 1)
        assert r.g == round(40_000.0 + unit * 60_000.0, 2)
        assert r.i == round(70.0 + unit * 60.0, 1)
