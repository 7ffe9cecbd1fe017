"""Row generators and dimensions: G01-G13, D01-D08."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.functions import synthetic
from wattlake.operators import dimensions, grids, quality
from wattlake.registry import sql
from wattlake.registry.core import Tables, query
from wattlake.registry.sql import longs
from wattlake.session import work_folder
from wattlake.sources.landing import split_by_required_text
from wattlake.sources.stored_dimensions import StoredLocations
from wattlake.sources.versions import VersionedStore

_RANGES = """
FROM (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
      FROM orders GROUP BY o_custkey)"""
_MONTHS = "unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH))"


def _customer_ranges(t: Tables):
    day = F.col("o_orderdate").cast("date")
    return t.read("orders").groupBy("o_custkey").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))


@query("G01_month_range", f"""
SELECT o_custkey, strftime({_MONTHS}, '%Y-%m') AS month {_RANGES}""")
def month_range(t: Tables):
    return grids.expand_months(_customer_ranges(t), "lo", "hi", ["o_custkey"])


@query("G02_first_days", f"""
SELECT o_custkey, strftime({_MONTHS}, '%Y-%m-%d') AS first_day {_RANGES}""")
def first_days(t: Tables):
    return grids.expand_first_days(_customer_ranges(t), "lo", "hi", ["o_custkey"])


_GRID = """
SELECT location, strftime(unnest(generate_series(date_trunc('month', lo),
         date_trunc('month', hi), INTERVAL 1 MONTH)), '%Y-%m-%d') AS period
FROM (SELECT location, min(ingestion_date) AS lo, max(ingestion_date) AS hi
      FROM raw_enrichment GROUP BY location)"""


def _grid(t: Tables):
    day = F.col("ingestion_timestamp").cast("date")
    places = t.raw_enrichment.groupBy("location").agg(
        F.min(day).alias("lo"), F.max(day).alias("hi")
    )
    return grids.location_period_grid(places, F.col("lo"), F.col("hi"))


@query("G03_location_period_grid", _GRID)
def location_period_grid(t: Tables):
    return _grid(t)


@query("G04_required_text", """
SELECT id, trim(location) AS location, trim(coalesce(sector, '  ')) AS sector,
       sector IS NOT NULL AS is_valid,
       CASE WHEN sector IS NULL THEN 'sector must not be blank' END AS reject_reason
FROM raw_eia""")
def required_text(t: Tables):
    rows = t.raw_eia.select("id", "location", F.coalesce("sector", F.lit("  ")).alias("sector"))
    return split_by_required_text(rows, ["location", "sector"])


@query("G05_rolling_window", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - 150, '%Y-%m') AS start_month,
       strftime(CAST(o_orderdate AS DATE) - 60, '%Y-%m') AS end_month
FROM orders""")
def rolling_window(t: Tables):
    start, end = grids.rolling_window(F.col("o_orderdate").cast("date"))
    return t.read("orders").select(
        "o_orderkey", start.alias("start_month"), end.alias("end_month")
    )


_SEED = "location || ':' || period || ':temperature'"


@query("G06_hash_residue", f"SELECT id, {sql.sha_mod(_SEED)} AS residue FROM raw_enrichment")
def hash_residue(t: Tables):
    seed = F.concat_ws(":", "location", "period", F.lit("temperature"))
    return t.raw_enrichment.select("id", synthetic.sha256_mod(seed).alias("residue"))


@query("G07_temperature", f"SELECT id, {sql.TEMPERATURE} AS temperature FROM raw_enrichment")
def temperature(t: Tables):
    value = synthetic.temperature(F.col("location"), F.col("period"))
    return t.raw_enrichment.select("id", value.alias("temperature"))


@query("G08_population", f"SELECT id, {sql.POPULATION} AS population FROM raw_enrichment")
def population(t: Tables):
    return t.raw_enrichment.select(
        "id", synthetic.population(F.col("location")).alias("population")
    )


@query("G09_gdp_per_capita", f"SELECT id, {sql.GDP} AS gdp_per_capita FROM raw_enrichment")
def gdp_per_capita(t: Tables):
    value = synthetic.gdp_per_capita(F.col("location"), F.col("period"))
    return t.raw_enrichment.select("id", value.alias("gdp_per_capita"))


@query("G10_industrial_index", f"SELECT id, {sql.INDUSTRIAL} AS industrial FROM raw_enrichment")
def industrial_index(t: Tables):
    value = synthetic.industrial_activity_index(F.col("location"), F.col("period"))
    return t.raw_enrichment.select("id", value.alias("industrial"))


_RECORD = f"""{sql.TEMPERATURE} AS temperature_fahrenheit, {sql.POPULATION} AS population,
       {sql.GDP} AS gdp_per_capita_usd, {sql.INDUSTRIAL} AS industrial_activity_index"""


@query("G11_enrichment_records", f"SELECT location, period, {_RECORD} FROM ({_GRID})")
def enrichment_records(t: Tables):
    return grids.enrichment_records(_grid(t))


@query("G12_record_limits", f"""
SELECT name AS limit_name, count(*) AS rows_checked, count(*) FILTER (WHERE NOT ok) AS rows_failed
FROM (SELECT unnest(['population_positive', 'gdp_per_capita_positive',
                     'industrial_activity_index_range']) AS name,
             unnest([population > 0, gdp_per_capita_usd > 0,
                     industrial_activity_index BETWEEN 0 AND 200]) AS ok
      FROM (SELECT {_RECORD} FROM ({_GRID})))
GROUP BY name""")
def record_limits(t: Tables):
    records = grids.enrichment_records(_grid(t))
    checks = [
        quality.Check("raw.enrichment_data", rule.split()[0], quality.EXPRESSION,
                      predicate=rule.split(maxsplit=1)[1])
        for rule in grids.RECORD_LIMITS.values()
    ]
    names = dict(zip((c.name for c in checks), grids.RECORD_LIMITS))
    label = F.element_at(
        F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), F.col("check_name")
    )
    return quality.evaluate(records, checks).select(
        label.alias("limit_name"), "rows_checked", "rows_failed"
    )


@query("G13_calendar", """
SELECT CAST(d AS VARCHAR) AS date, CAST(coalesce(n, 0) AS BIGINT) AS n_rows
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(ingestion_date) AS lo, max(ingestion_date) AS hi FROM raw_eia))
LEFT JOIN (SELECT ingestion_date, count(*) AS n FROM raw_eia GROUP BY ingestion_date)
  ON d = ingestion_date""")
def calendar(t: Tables):
    """Calendar over the span of the raw rows, with the number of rows of each day."""
    by_day = t.raw_eia.groupBy(F.col("ingestion_timestamp").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    span = by_day.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    days = dimensions.calendar_days(span, F.col("lo"), F.col("hi"))
    return days.join(by_day, "date", "left").fillna(0, ["n_rows"])


_DAYS = "FROM (SELECT DISTINCT ingestion_date AS d FROM raw_eia)"


def _day_columns(t: Tables, *names: str):
    days = t.raw_eia.select(F.col("ingestion_timestamp").cast("date").alias("date")).distinct()
    columns = dimensions.calendar_columns(F.col("date"))
    return days.select("date", *(columns[n].alias(n) for n in names))


@query("D01_time_key", f"""
SELECT CAST(d AS VARCHAR) AS date, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS time_key {_DAYS}""")
def time_key(t: Tables):
    return _day_columns(t, "time_key")


@query("D02_date_parts", f"""
SELECT CAST(d AS VARCHAR) AS date, CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT)
         AS quarter, CAST(month(d) AS BIGINT) AS month, CAST(day(d) AS BIGINT) AS day_of_month
{_DAYS}""")
def date_parts(t: Tables):
    return _day_columns(t, "year", "quarter", "month", "day_of_month")


@query("D03_iso_week", f"""
SELECT CAST(d AS VARCHAR) AS date, CAST(isodow(d) AS BIGINT) AS day_of_week,
       CAST(weekofyear(d) AS BIGINT) AS week_of_year {_DAYS}""")
def iso_week(t: Tables):
    return _day_columns(t, "day_of_week", "week_of_year")


@query("D04_padded_names", f"""
SELECT CAST(d AS VARCHAR) AS date, rpad(strftime(d, '%B'), 9, ' ') AS month_name,
       rpad(strftime(d, '%A'), 9, ' ') AS day_name {_DAYS}""")
def padded_names(t: Tables):
    return _day_columns(t, "month_name", "day_name")


@query("D05_weekend_holiday", f"""
SELECT CAST(d AS VARCHAR) AS date, isodow(d) IN (6, 7) AS is_weekend, FALSE AS is_holiday
{_DAYS}""")
def weekend_holiday(t: Tables):
    return _day_columns(t, "is_weekend", "is_holiday")


@query("D06_dim_energy_source", f"""
SELECT {longs("energy_source_key")}, energy_source_code, category, is_renewable,
       {longs("carbon_intensity_kg_per_mwh")}, CAST(coalesce(n, 0) AS BIGINT) AS staged_rows
FROM dim_energy_source
LEFT JOIN (SELECT energy_source, count(*) AS n FROM gen GROUP BY energy_source)
  ON lower(energy_source_name) = energy_source""")
def dim_energy_source(t: Tables):
    """The dimension, with the number of staged rows that bear the name of each source."""
    staged = t.generation.groupBy("energy_source").agg(F.count(F.lit(1)).alias("staged_rows"))
    dim = dimensions.dim_energy_source(t.spark).withColumn(
        "energy_source", F.lower("energy_source_name")
    )
    return dim.join(staged, "energy_source", "left").fillna(0, ["staged_rows"]).select(
        "energy_source_key", "energy_source_code", "category", "is_renewable",
        "carbon_intensity_kg_per_mwh", "staged_rows",
    )


@query("D07_dim_location", f"""
SELECT {longs("location_key")}, location_code, location_name, dim_location.location_type, region,
       CAST(coalesce(n, 0) AS BIGINT) AS staged_rows
FROM dim_location
LEFT JOIN (SELECT location, count(*) AS n FROM gen GROUP BY location) ON location_code = location""")
def dim_location(t: Tables):
    staged = t.generation.groupBy(F.col("location").alias("location_code")).agg(
        F.count(F.lit(1)).alias("staged_rows")
    )
    return dimensions.dim_location(t.spark).join(staged, "location_code", "left").fillna(
        0, ["staged_rows"]
    ).select(
        "location_key", "location_code", "location_name", "location_type", "region", "staged_rows"
    )


@query("D08_insert_if_absent", """
SELECT DISTINCT location AS location_code FROM gen
WHERE location NOT IN (SELECT location_code FROM dim_location)""")
def insert_if_absent(t: Tables):
    """Codes of the staged rows that the location dimension does not have yet."""
    codes = t.generation.select(F.col("location").alias("location_code"))
    return dimensions.insert_if_absent(
        dimensions.dim_location(t.spark), codes, ["location_code"]
    )


@query("D08_stored_locations", f"""
SELECT {longs("location_key")}, location_code, location_name, location_type FROM dim_location
UNION ALL
SELECT (SELECT max(location_key) FROM dim_location) + row_number() OVER (ORDER BY location),
       location, location, min(location_type)
FROM gen
WHERE trim(location) <> '' AND location NOT IN (SELECT location_code FROM dim_location)
GROUP BY location""")
def stored_locations(t: Tables):
    """The stored dimension after the staged rows came twice: the second time adds nothing."""
    locations = StoredLocations(VersionedStore(t.spark, work_folder(t.spark, "dimensions")))
    for _ in range(2):
        locations.grow(t.generation)
    return locations.read().select("location_key", "location_code", "location_name", "location_type")
