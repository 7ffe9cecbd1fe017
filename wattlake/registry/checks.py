"""Data quality and audit: Q01-Q14."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.operators import check_catalogue as catalogue
from wattlake.operators import dimensions, quality
from wattlake.plans import daily, fact, refresh
from wattlake.registry.core import Tables, query
from wattlake.session import work_folder

_SQL_TABLES = {
    catalogue.RAW_EIA: "(SELECT *, ingestion_date AS ingestion_timestamp FROM raw_eia)",
    catalogue.RAW_ENRICHMENT: "(SELECT *, ingestion_date AS ingestion_timestamp FROM raw_enrichment)",
    catalogue.GENERATION: "(SELECT *, ingestion_date AS ingestion_timestamp FROM gen)",
    catalogue.CONSUMPTION: "(SELECT *, ingestion_date AS ingestion_timestamp FROM cons)",
    catalogue.ENRICHMENT: "(SELECT *, ingestion_date AS ingestion_timestamp FROM enr)",
    catalogue.COMBINED: "combined",
    catalogue.FACT: "(SELECT *, 1 AS created_at, 1 AS updated_at FROM fact)",
}


def _fails_sql(check: quality.Check) -> str:
    if check.kind == quality.NOT_NULL:
        return f"SELECT 1 FROM {{table}} WHERE {check.column} IS NULL"
    if check.kind == quality.UNIQUE:
        return (
            f"SELECT {check.column} FROM {{table}} WHERE {check.column} IS NOT NULL "
            f"GROUP BY {check.column} HAVING count(*) > 1"
        )
    if check.kind == quality.ACCEPTED:
        accepted = ", ".join(f"'{v}'" for v in check.values)
        return f"SELECT 1 FROM {{table}} WHERE {check.column} NOT IN ({accepted})"
    return f"SELECT 1 FROM {{table}} WHERE NOT ({check.column} {check.predicate})"


def _check_sql(check: quality.Check) -> str:
    table = _SQL_TABLES[check.table]
    if check.where:
        table = f"(SELECT * FROM {table} WHERE {check.where})"
    failed = _fails_sql(check).format(table=table)
    bad = "warning" if check.severity == "warn" else "failed"
    return f"""
SELECT '{check.name}' AS check_name, '{check.table.split(".")[0]}' AS table_schema,
       '{check.table.split(".")[1]}' AS table_name, '{check.column}' AS column_name,
       '{check.kind}' AS check_type, '{check.severity}' AS severity, '{check.where}' AS scope,
       (SELECT count(*) FROM {table}) AS rows_checked,
       (SELECT count(*) FROM ({failed})) AS rows_failed,
       CASE WHEN (SELECT count(*) FROM ({failed})) = 0 THEN 'passed' ELSE '{bad}' END
         AS check_result"""


def _checks_sql(checks: list[quality.Check]) -> str:
    return " UNION ALL ".join(_check_sql(c) for c in checks)


def _tables(t: Tables):
    return daily.model_tables(t.raw_eia, t.raw_enrichment, fact.stamped(t.fact))


_NOT_NULL = catalogue.checks_of(quality.NOT_NULL)
_UNIQUE = catalogue.checks_of(quality.UNIQUE)
_ACCEPTED = catalogue.checks_of(quality.ACCEPTED)
_EXPRESSION = catalogue.checks_of(quality.EXPRESSION)
_SCOPED = [c for c in catalogue.all_checks() if c.where]


@query("Q01_not_null", _checks_sql(_NOT_NULL))
def not_null(t: Tables):
    return quality.evaluate_all(_tables(t), _NOT_NULL)


@query("Q02_unique", _checks_sql(_UNIQUE))
def unique(t: Tables):
    return quality.evaluate_all(_tables(t), _UNIQUE)


@query("Q02_repeated_fact_keys", """
SELECT metric_key, count(*) AS n_records FROM fact GROUP BY metric_key HAVING count(*) > 1""")
def repeated_fact_keys(t: Tables):
    check = next(c for c in _UNIQUE if c.table == catalogue.FACT)
    return quality.failing_rows(t.fact, check)


@query("Q03_accepted_values", _checks_sql(_ACCEPTED))
def accepted_values(t: Tables):
    return quality.evaluate_all(_tables(t), _ACCEPTED)


@query("Q04_expression_is_true", _checks_sql(_EXPRESSION))
def expression_is_true(t: Tables):
    return quality.evaluate_all(_tables(t), _EXPRESSION)


@query("Q04_implausible_temperatures", """
SELECT source_id, CAST(temperature_fahrenheit AS DOUBLE) AS temperature_fahrenheit FROM enr
WHERE NOT (temperature_fahrenheit BETWEEN -50 AND 150)""")
def implausible_temperatures(t: Tables):
    check = next(c for c in _EXPRESSION if c.column == "temperature_fahrenheit")
    return quality.failing_rows(t.enrichment, check).select("source_id", "temperature_fahrenheit")


@query("Q05_scoped_checks", _checks_sql(_SCOPED))
def scoped_checks(t: Tables):
    return quality.evaluate_all(_tables(t), _SCOPED)


@query("Q06_severity", f"""
SELECT severity, check_result, count(*) AS n_checks, CAST(sum(rows_failed) AS BIGINT) AS rows_failed
FROM ({_checks_sql(_NOT_NULL + _ACCEPTED + _EXPRESSION)}) GROUP BY severity, check_result""")
def severity(t: Tables):
    results = quality.evaluate_all(_tables(t), _NOT_NULL + _ACCEPTED + _EXPRESSION)
    return results.groupBy("severity", "check_result").agg(
        F.count(F.lit(1)).alias("n_checks"), F.sum("rows_failed").alias("rows_failed")
    )


@query("Q07_freshness", """
SELECT table_name, CAST(newest AS VARCHAR) AS newest, date_diff('hour', newest, as_of) * 1.0::DOUBLE
         AS age_hours,
       CASE WHEN date_diff('hour', newest, as_of) > 24 THEN 'error'
            WHEN date_diff('hour', newest, as_of) > 12 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT 'eia_energy_data' AS table_name, max(ingestion_date) AS newest,
             TIMESTAMP '2026-11-04 18:00:00' AS as_of FROM raw_eia
      UNION ALL
      SELECT 'enrichment_data', max(ingestion_date), TIMESTAMP '2026-11-04 18:00:00'
      FROM raw_enrichment)""")
def freshness(t: Tables):
    as_of = F.lit("2026-11-04 18:00:00").cast("timestamp_ntz")
    rows = [
        quality.freshness(table, as_of, **catalogue.FRESHNESS_HOURS).withColumn(
            "table_name", F.lit(name)
        )
        for name, table in (("eia_energy_data", t.raw_eia), ("enrichment_data", t.raw_enrichment))
    ]
    return rows[0].unionByName(rows[1]).withColumn("newest", F.col("newest").cast("date"))


@query("Q08_raw_gate", """
SELECT (SELECT count(*) FROM raw_eia) AS raw_eia_count,
       (SELECT count(*) FROM raw_enrichment) AS raw_enrichment_count, 'pass' AS status""")
def raw_gate(t: Tables):
    return quality.row_count_gate({"raw_eia": t.raw_eia, "raw_enrichment": t.raw_enrichment})


@query("Q09_marts_gate", """
SELECT (SELECT count(*) FROM fact) AS fact_count, (SELECT count(*) FROM dim_time) AS dim_time_count,
       'pass' AS status""")
def marts_gate(t: Tables):
    return quality.row_count_gate({"fact": t.fact, "dim_time": t.dims.time})


@query("Q10_fact_orphans", """
SELECT 'time_key' AS key_name, count(*) AS orphans FROM fact
WHERE time_key NOT IN (SELECT time_key FROM dim_time)
UNION ALL SELECT 'location_key', count(*) FROM fact
WHERE location_key NOT IN (SELECT location_key FROM dim_location)""")
def fact_orphans(t: Tables):
    count = F.count(F.lit(1)).alias("orphans")
    time = quality.orphans(t.fact, t.dims.time, "time_key", t.dims.time_rows).agg(count)
    place = quality.orphans(t.fact, t.dims.location, "location_key", t.dims.location_rows).agg(count)
    return time.select(F.lit("time_key").alias("key_name"), "orphans").unionByName(
        place.select(F.lit("location_key").alias("key_name"), "orphans")
    )


@query("Q10_staged_orphans", """
SELECT source_id, location AS location_code FROM gen
WHERE location NOT IN (SELECT location_code FROM dim_location)""")
def staged_orphans(t: Tables):
    """Staged rows that the fact's inner join will drop."""
    rows = t.generation.select("source_id", F.col("location").alias("location_code"))
    return quality.orphans(rows, t.dims.location, "location_code", t.dims.location_rows)


# Fixed value: least number of days that the calendar has to hold.
_LEAST_DAYS = 3651


@query("Q11_seed_bounds", """
SELECT bound, n, at_least, CASE WHEN n >= at_least THEN 'pass' ELSE 'fail' END AS status FROM (
  SELECT 'days' AS bound, count(DISTINCT ingestion_date) AS n, CAST(3651 AS BIGINT) AS at_least
  FROM raw_eia
  UNION ALL SELECT 'energy_sources', count(DISTINCT energy_source), 7 FROM gen
  UNION ALL SELECT 'locations', count(DISTINCT location), 10 FROM gen
  UNION ALL SELECT 'renewables', count(DISTINCT energy_source), 3 FROM gen
  WHERE energy_source IN ('solar', 'wind', 'hydro'))""")
def seed_bounds(t: Tables):
    """The bounds of the seeded dimensions, asked of the values that the data brings."""
    days = t.raw_eia.select(F.col("ingestion_timestamp").cast("date")).distinct()
    sources = t.generation.select("energy_source").distinct()
    places = t.generation.select("location").distinct()
    renewable = F.col("energy_source").isin("solar", "wind", "hydro")
    always = F.lit(True)
    return quality.seed_bounds(
        {
            "days": (days, always, _LEAST_DAYS),
            "energy_sources": (sources, always, len(dimensions.ENERGY_SOURCES)),
            "locations": (places, always, len(dimensions.LOCATIONS)),
            "renewables": (sources, renewable, 3),
        }
    )


@query("Q12_required_columns", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name, TRUE AS is_present, "
    f"(SELECT count(*) FROM {source}) AS rows_checked"
    for table, source in (
        (catalogue.RAW_EIA, "raw_eia"), (catalogue.RAW_ENRICHMENT, "raw_enrichment"),
        (catalogue.FACT, "fact"),
    )
    for column in schemas.REQUIRED_COLUMNS[table]
))
def required_columns(t: Tables):
    tables = {
        catalogue.RAW_EIA: t.raw_eia,
        catalogue.RAW_ENRICHMENT: t.raw_enrichment,
        catalogue.FACT: t.fact,
    }
    parts = [
        quality.column_conformance(name, table, schemas.REQUIRED_COLUMNS[name])
        for name, table in tables.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("Q13_audit_rows", f"""
SELECT check_name, table_schema, table_name, check_type, check_result, rows_checked, rows_failed,
       round(CASE WHEN rows_checked > 0 THEN rows_failed * 100.0::DOUBLE / rows_checked ELSE 0 END,
             4) AS failure_percentage
FROM ({_checks_sql(catalogue.all_checks())})""")
def audit_rows(t: Tables):
    """All 131 checks, written to the audit table and read back.

    The two joined models are stored first: each of them is scanned by its row checks and once
    more by its key check.
    """
    path = work_folder(t.spark, "audit") + "/data_quality_checks"
    tables = {
        **_tables(t),
        catalogue.COMBINED: t.stored_combined,
        catalogue.FACT: fact.stamped(t.stored_fact),
    }
    results = quality.evaluate_all(tables, catalogue.all_checks())
    quality.audit_rows(results).write.mode("append").parquet(path)
    stored = t.spark.read.schema(schemas.CHECK_RESULT).parquet(path)
    return stored.drop("check_timestamp", "details")


@query("Q14_run_row", """
SELECT 'daily_energy' AS pipeline_name, 'success' AS run_status,
       (SELECT count(*) FROM raw_eia) + (SELECT count(*) FROM raw_enrichment) AS rows_processed,
       (SELECT count(*) FROM fact) AS rows_inserted, CAST(0 AS BIGINT) AS rows_failed""")
def run_row(t: Tables):
    """The audit row of one rebuild of the mart; its numbers come from the write itself."""
    path = work_folder(t.spark, "run")
    written = Observation()
    refresh.rebuild(
        t.fact.observe(written, F.count(F.lit(1)).alias("rows")), f"{path}/fct_energy_metrics"
    )
    quality.run_row(
        t.spark, run_id=path, pipeline_name="daily_energy", run_status="success",
        rows_processed=t.raw_eia.count() + t.raw_enrichment.count(),
        rows_inserted=written.get["rows"], rows_failed=0,
    ).write.mode("append").parquet(f"{path}/pipeline_runs")
    return t.spark.read.schema(schemas.RUN_RESULT).parquet(f"{path}/pipeline_runs").select(
        "pipeline_name", "run_status", "rows_processed", "rows_inserted", "rows_failed"
    )
