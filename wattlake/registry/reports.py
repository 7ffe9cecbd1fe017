"""Report aggregates, top lists and tables: A08-A18, T03-T05, R01-R08."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.operators import report_measures as measures
from wattlake.operators.describe import describe
from wattlake.plans import report
from wattlake.registry.core import Tables, query
from wattlake.registry.landing import newest_sql
from wattlake.registry.sql import doubles, longs
from wattlake.sources import scans

_BY_LOCATION = """
SELECT location, CAST(sum(total_generation_mwh) AS DOUBLE) AS total_generation_mwh
FROM report_rows GROUP BY location"""
_RENEWABLE = """
SELECT location, round(avg(CAST(renewable_percentage AS DOUBLE)), 6) AS renewable_percentage
FROM report_rows GROUP BY location"""
_RANK = "ORDER BY {} DESC, location"


def _rounded(table, places: int, *columns: str):
    return table.withColumns({c: F.round(c, places) for c in columns})


@query("A08_sum_by_location", _BY_LOCATION)
def sum_by_location(t: Tables):
    return measures.sum_by_location(t.report_rows)


@query("A09_mean_renewable", _RENEWABLE + " " + _RANK.format("renewable_percentage"))
def mean_renewable(t: Tables):
    means = measures.mean_renewable_by_location(t.report_rows)
    return _rounded(measures.ranked(means, "renewable_percentage"), 6, "renewable_percentage")


_MATRIX = ", ".join(
    f"""CAST(coalesce(sum(total_generation_mwh) FILTER (WHERE location = '{label}'), 0) AS DOUBLE)
         AS "{label}\""""
    for label in report.SEED_LABELS
)


@query("A10_generation_matrix", f"""
SELECT CAST(date AS VARCHAR) AS date, {_MATRIX} FROM report_rows GROUP BY date""")
def generation_matrix(t: Tables):
    return measures.generation_matrix(t.report_rows, report.SEED_LABELS)


_MONTHLY = f"""
SELECT {longs("year", "month")}, location, round(avg(CAST(renewable_percentage AS DOUBLE)), 6)
         AS renewable_percentage, strftime(make_date(year, month, 1), '%Y-%m-%d') AS date
FROM report_rows GROUP BY year, month, location"""


@query("A11_monthly_renewable", _MONTHLY)
def monthly_renewable(t: Tables):
    return _rounded(measures.monthly_renewable(t.report_rows), 6, "renewable_percentage")


_CORRELATION = """
round(corr(CAST(avg_temperature_fahrenheit AS DOUBLE), CAST(total_generation_mwh AS DOUBLE)), 6)"""


@query("A12_temperature_correlation", f"SELECT {_CORRELATION} AS correlation FROM fact")
def temperature_correlation(t: Tables):
    return _rounded(measures.temperature_correlation(t.report_rows), 6, "correlation")


_ECONOMIC_COLUMNS = ["total_generation_mwh", "gdp_per_capita_usd", "population"]
_ECONOMIC = "SELECT location, " + ", ".join(
    f"round(avg(CAST({c} AS DOUBLE)), 3) AS {c}" for c in _ECONOMIC_COLUMNS
) + " FROM report_rows GROUP BY location"


@query("A13_economic_means", _ECONOMIC)
def economic_means(t: Tables):
    return _rounded(measures.economic_means(t.report_rows), 3, *_ECONOMIC_COLUMNS)


_FIGURES = {
    "total_records": "count(*)",
    "first_date": "min(time_key)",
    "last_date": "max(time_key)",
    "locations": "count(DISTINCT location)",
    "total_generation_mwh": "sum(total_generation_mwh)",
    "mean_generation_mwh": "round(avg(CAST(total_generation_mwh AS DOUBLE)), 3)",
    "max_generation_mwh": "max(total_generation_mwh)",
    "mean_renewable_percentage": "round(avg(CAST(renewable_percentage AS DOUBLE)), 3)",
    "max_renewable_percentage": "max(renewable_percentage)",
    "mean_temperature_fahrenheit": "round(avg(CAST(avg_temperature_fahrenheit AS DOUBLE)), 3)",
    "mean_population": "round(avg(CAST(population AS DOUBLE)), 3)",
    "mean_gdp_per_capita_usd": "round(avg(CAST(gdp_per_capita_usd AS DOUBLE)), 3)",
    "temperature_generation_correlation": _CORRELATION,
}


@query("A14_key_figures", "SELECT " + ", ".join(
    f"CAST({text} AS {'BIGINT' if name in ('total_records', 'locations') else 'DOUBLE'}) AS {name}"
    for name, text in _FIGURES.items() if name not in ("first_date", "last_date")
) + ", CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date "
    "FROM report_rows")
def key_figures(t: Tables):
    figures = measures.key_figures(t.report_rows)
    means = [c for c in figures.columns if c.startswith("mean_")]
    return _rounded(
        _rounded(figures, 3, *means), 6, "temperature_generation_correlation"
    )


@query("A15_majority_locations", f"""
SELECT count(*) FILTER (WHERE renewable_percentage >= 50) AS locations_at_least,
       count(*) AS locations FROM ({_RENEWABLE})""")
def majority_locations(t: Tables):
    return measures.locations_with_majority(t.report_rows)


_COMPLETE = {
    name: f"round(count({column}) * 100.0 / count(*), 6)"
    for name, column in measures.COMPLETENESS_COLUMNS.items()
}


@query("A16_completeness", "SELECT " + ", ".join(
    f"CAST({text} AS DOUBLE) AS {name}_completeness" for name, text in _COMPLETE.items()
) + " FROM fact")
def completeness(t: Tables):
    shares = measures.completeness(t.report_rows)
    return _rounded(shares, 6, *shares.columns)


def _describe_sql() -> str:
    def one(column: str) -> str:
        x = f"CAST({column} AS DOUBLE)"
        return f"""
SELECT '{column}' AS "column", count({column}) AS count, round(avg({x}), 3) AS mean,
       round(stddev_samp({x}), 3) AS std, min({x}) AS min,
       round(quantile_cont({x}, 0.25), 6) AS p25, round(quantile_cont({x}, 0.5), 6) AS p50,
       round(quantile_cont({x}, 0.75), 6) AS p75, max({x}) AS max FROM fact"""

    return " UNION ALL ".join(one(c) for c in report.DESCRIBED_COLUMNS)


@query("A17_describe", _describe_sql())
def describe_fact(t: Tables):
    stats = describe(t.stored_rows, report.DESCRIBED_COLUMNS)
    return _rounded(_rounded(stats, 3, "mean", "std"), 6, "p25", "p50", "p75")


@query("A18_row_counts", """
SELECT 'eia_energy_data' AS table_name, count(*) AS n_rows FROM raw_eia
UNION ALL SELECT 'enrichment_data', count(*) FROM raw_enrichment""")
def row_counts(t: Tables):
    tables = {"eia_energy_data": t.raw_eia, "enrichment_data": t.raw_enrichment}
    counts = [
        table.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        for n, table in tables.items()
    ]
    return counts[0].unionByName(counts[1])


@query("T03_newest", newest_sql(["time_key", "location_key"], 2500))
def newest(t: Tables):
    return scans.newest(t.fact, ["time_key", "location_key"], 2_500)


@query("T04_top_generators", _BY_LOCATION + " " + _RANK.format("total_generation_mwh") + " LIMIT 3")
def top_generators(t: Tables):
    return measures.top(measures.sum_by_location(t.report_rows), "total_generation_mwh")


@query("T05_top_renewable", _RENEWABLE + " " + _RANK.format("renewable_percentage") + " LIMIT 3")
def top_renewable(t: Tables):
    means = measures.mean_renewable_by_location(t.report_rows)
    return _rounded(measures.top(means, "renewable_percentage"), 6, "renewable_percentage")


@query("R01_generation_by_location", _BY_LOCATION + " " + _RANK.format("total_generation_mwh"))
def generation_by_location(t: Tables):
    return report.generation_by_location(t.report_rows)


@query("R02_generation_trend", f"""
SELECT CAST(d.date AS VARCHAR) AS date, l.location,
       CAST(coalesce(sum(f.total_generation_mwh), 0) AS DOUBLE) AS total_generation_mwh
FROM (SELECT DISTINCT date FROM report_rows) d
CROSS JOIN (SELECT 'LOC_' || location_key AS location FROM dim_location) l
LEFT JOIN report_rows f ON f.date = d.date AND f.location = l.location
GROUP BY d.date, l.location""")
def generation_trend(t: Tables):
    return report.generation_trend(t.report_rows)


@query("R03_renewable_by_location", f"""
SELECT *, CASE WHEN renewable_percentage >= 50 THEN 'green' WHEN renewable_percentage >= 25
         THEN 'orange' ELSE 'red' END AS band FROM ({_RENEWABLE})""")
def renewable_by_location(t: Tables):
    return _rounded(report.renewable_by_location(t.report_rows), 6, "renewable_percentage")


@query("R04_renewable_trend", f"""
SELECT date AS month, location, renewable_percentage FROM ({_MONTHLY})""")
def renewable_trend(t: Tables):
    return _rounded(report.renewable_trend(t.report_rows), 6, "renewable_percentage")


@query("R05_temperature_points", f"""
SELECT location, {doubles("avg_temperature_fahrenheit", "total_generation_mwh")}
FROM report_rows""")
def temperature_points(t: Tables):
    return report.temperature_points(t.report_rows)


@query("R06_economic_scatter", _ECONOMIC)
def economic_scatter(t: Tables):
    return _rounded(report.economic_scatter(t.report_rows), 3, *_ECONOMIC_COLUMNS)


@query("R07_summary", " UNION ALL ".join(
    f"SELECT '{name}' AS metric, round(CAST({text} AS DOUBLE), 3) AS value FROM report_rows"
    for name, text in _FIGURES.items()
) + f""" UNION ALL SELECT 'locations_at_least_half_renewable',
  CAST(count(*) FILTER (WHERE renewable_percentage >= 50) AS DOUBLE) FROM ({_RENEWABLE})""")
def summary(t: Tables):
    return _rounded(report.summary(t.stored_rows), 3, "value")


def _quality_sql() -> str:
    parts = [
        f"SELECT '{name}' AS subject, 'completeness' AS stat, round({text}, 3) AS value FROM fact"
        for name, text in _COMPLETE.items()
    ]
    stats = {
        "count": "count({x})", "mean": "avg({x})", "std": "stddev_samp({x})", "min": "min({x})",
        "p25": "quantile_cont({x}, 0.25)", "p50": "quantile_cont({x}, 0.5)",
        "p75": "quantile_cont({x}, 0.75)", "max": "max({x})",
    }
    for column in report.DESCRIBED_COLUMNS:
        x = f"CAST({column} AS DOUBLE)"
        parts += [
            f"SELECT '{column}', '{stat}', round(CAST({text.format(x=x)} AS DOUBLE), 3) FROM fact"
            for stat, text in stats.items()
        ]
    return " UNION ALL ".join(parts)


@query("R08_quality_summary", _quality_sql())
def quality_summary(t: Tables):
    return _rounded(report.quality_summary(t.stored_rows), 3, "value")
