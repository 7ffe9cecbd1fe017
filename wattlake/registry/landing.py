"""Sources, landing and scans: S01-S16."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake import schemas
from wattlake.plans import refresh
from wattlake.registry.core import Tables, query
from wattlake.registry.sql import doubles, longs
from wattlake.session import work_folder
from wattlake.sources import derived, landing, scans, versions

_MAPPED = ["source", "series_id", "period", "value", "units", "location", "location_type",
           "energy_source", "sector"]
_MAPPED_SQL = f"""
SELECT id, source, CASE WHEN is_first AND series_id IS NOT NULL THEN series_id
         ELSE 'ELEC.GEN.' || series_place END AS series_id,
       period, {doubles("value")}, units, sent_location AS location, location_type,
       energy_source, sector
FROM first_family"""


@query("S01_unwrap_envelope", """
SELECT id, concat_ws(',', 'period', CASE WHEN is_first AND series_id IS NOT NULL THEN 'seriesId' END,
         CASE WHEN is_first THEN 'value' ELSE 'generation' END,
         CASE WHEN units IS NOT NULL THEN CASE WHEN is_first THEN 'units' ELSE 'generation-units'
              END END,
         CASE WHEN sent_location IS NOT NULL THEN 'location' END,
         CASE WHEN location_type IS NOT NULL THEN CASE WHEN is_first THEN 'locationType'
              ELSE 'stateDescription' END END,
         CASE WHEN energy_source IS NOT NULL THEN CASE WHEN is_first THEN 'energySource'
              ELSE 'fuelTypeDescription' END END,
         CASE WHEN sector IS NOT NULL THEN CASE WHEN is_first THEN 'sector'
              ELSE 'sectorDescription' END END,
         CASE WHEN location_type = 'mountain' THEN 'location' END) AS record_keys
FROM first_family WHERE value IS NOT NULL""")
def unwrap_envelope(t: Tables):
    records = landing.unwrap_pages(derived.eia_pages(t.raw_eia), keep=["id"])
    return records.select("id", F.array_join(F.json_object_keys("raw_json"), ",").alias("record_keys"))


@query("S02_fetch_generation", f"""
SELECT id, period, {doubles("value")}, location, energy_source FROM raw_eia
WHERE energy_source IS NOT NULL AND period BETWEEN '2021-01' AND '2022-06'
  AND regexp_matches(period, '^\\d{{4}}-\\d{{2}}$')""")
def fetch_generation(t: Tables):
    landed = t.raw_eia.filter(F.col("energy_source").isNotNull())
    return scans.fetch_period_range(landed, "2021-01", "2022-06").select(
        "id", "period", "value", "location", "energy_source"
    )


@query("S03_fetch_consumption", f"""
SELECT id, period, {doubles("value")}, location, sector FROM raw_eia
WHERE sector IS NOT NULL AND location = 'CA' AND period >= '2021-01' AND period < '2022-07'
  AND regexp_matches(period, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$')""")
def fetch_consumption(t: Tables):
    landed = t.raw_eia.filter(F.col("sector").isNotNull())
    return scans.fetch_period_range(landed, "2021-01", "2022-06", "CA", "daily").select(
        "id", "period", "value", "location", "sector"
    )


@query("S04_validate_period", """
SELECT id, period, regexp_matches(period, '^\\d{4}-\\d{2}$') AS is_valid,
       CASE WHEN NOT regexp_matches(period, '^\\d{4}-\\d{2}$') THEN 'expected YYYY-MM' END
         AS reject_reason
FROM raw_eia""")
def validate_period(t: Tables):
    return landing.split_by_month_format(t.raw_eia).select(
        "id", "period", "is_valid", "reject_reason"
    )


def _sinks(t: Tables, texts, family: str, schema):
    """Faulty record texts through one pass into both sinks: verdicts read back from the sinks,
    beside the numbers that the pass reported."""
    path = work_folder(t.spark, "quarantine") + f"/{family}"
    marked = landing.mark(landing.records_of_lines(texts, "text", ["id"]), family, ["id"])
    seen = landing.land_batch(marked, path)
    kept = T.StructType([T.StructField("id", T.LongType()), *[f for f in schema.fields if f.name != "id"]])
    landed = landing.read_landed(t.spark, path, kept).select("id", F.lit("landed").alias("verdict"))
    rejects = landing.read_quarantine(t.spark, path, ["id"]).select("id", F.col("reject_reason").alias("verdict"))
    return landed.unionByName(rejects).groupBy("verdict").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("id") % 1000).alias("id_digits"),
        F.lit(seen["landed"]).alias("landed"), F.lit(seen["rejected"]).alias("rejected"),
    )


def _judged(reason: str, table: str) -> str:
    return f"""
SELECT coalesce(reason, 'landed') AS verdict, count(*) AS n_rows, sum(id % 1000) AS id_digits,
       any_value(n_landed) AS landed, any_value(n_rejected) AS rejected
FROM (SELECT id, reason, count(*) FILTER (reason IS NULL) OVER () AS n_landed,
             count(*) FILTER (reason IS NOT NULL) OVER () AS n_rejected
      FROM (SELECT id, {reason} AS reason FROM {table}))
GROUP BY ALL"""


@query("S04_quarantine", _judged("""CASE WHEN id % 29 = 0 THEN 'malformed JSON'
             WHEN value IS NULL THEN NULL
             WHEN id % 29 = 1 THEN CASE WHEN is_first THEN 'value' ELSE 'generation' END || ': no number'
             WHEN id % 29 = 2 THEN CASE WHEN is_first THEN 'value' ELSE 'generation' END || ': out of range'
             END""", "first_family"))
def quarantine(t: Tables):
    """Some texts are cut off, some values are texts, some are beyond the type."""
    number, text = r'"(value|generation)":[-+.0-9E]+', F.col("text")
    fault = F.col("id") % 29
    faulty = (
        F.when(fault == 0, F.substring(text, 1, 15))
        .when(fault == 1, F.regexp_replace(text, number, '"$1":"n/a"'))
        .when(fault == 2, F.regexp_replace(text, number, '"$1":1e30'))
        .otherwise(text)
    )
    texts = derived.eia_record_texts(t.raw_eia).select("id", faulty.alias("text"))
    return _sinks(t, texts, "eia", schemas.RAW_EIA)


@query("G04_quarantine", _judged("""CASE WHEN id % 31 = 0 THEN 'location must not be blank'
             WHEN id % 31 = 1 THEN 'period must not be blank' WHEN id % 31 = 2 THEN 'malformed JSON'
             WHEN id % 31 = 3 AND population IS NOT NULL THEN 'population: no number' END""", "raw_enrichment"))
def quarantine_blanks(t: Tables):
    """Blank locations, absent periods, texts that are no object, a population in words."""
    text, fault = F.col("text"), F.col("id") % 31
    faulty = (
        F.when(fault == 0, F.regexp_replace(text, '"location":"[^"]*"', '"location":"  "'))
        .when(fault == 1, F.regexp_replace(text, '"period":"[^"]*",', ""))
        .when(fault == 2, F.concat(F.lit("["), text, F.lit("]")))
        .when(fault == 3, F.regexp_replace(text, '"population":[0-9]+', '"population":"many"'))
        .otherwise(text)
    )
    texts = derived.enrichment_record_texts(t.raw_enrichment).select("id", faulty.alias("text"))
    return _sinks(t, texts, "enrichment", schemas.RAW_ENRICHMENT)


@query("S05_map_eia_batch", _MAPPED_SQL + " WHERE value IS NOT NULL")
def map_eia_batch(t: Tables):
    return landing.land_eia_pages(derived.eia_pages(t.raw_eia), keep=["id"]).select("id", *_MAPPED)


@query("S06_map_eia_record", _MAPPED_SQL)
def map_eia_record(t: Tables):
    texts = derived.eia_record_texts(t.raw_eia)
    return landing.land_eia_lines(texts, "text", keep=["id"]).select("id", *_MAPPED)


_ENRICHED = ["source", "period", "location", "temperature_avg", "temperature_unit", "population",
             "gdp_per_capita", "industrial_activity_index"]
_ENRICHED_SQL = f"""
SELECT id, source, period, location, {doubles("temperature_avg")}, temperature_unit,
       {longs("population")}, {doubles("gdp_per_capita", "industrial_activity_index")}
FROM raw_enrichment"""


@query("S07_map_enrichment_batch", _ENRICHED_SQL)
def map_enrichment_batch(t: Tables):
    """Records that are tabular already, GDP under the first name where it is not zero."""
    records = t.raw_enrichment.select(
        "id", "period", "location", F.col("temperature_avg").alias("temperature_fahrenheit"),
        "population",
        F.when(F.col("population").isNotNull(), F.col("gdp_per_capita"))
        .otherwise(F.lit(0))
        .alias("gdp_per_capita_usd"),
        F.col("gdp_per_capita"),
        "industrial_activity_index",
    )
    whole = landing.with_raw_json(records, schemas.ENRICHMENT_RECORD.fieldNames())
    return landing.map_enrichment_records(whole, keep=["id"]).select("id", *_ENRICHED)


@query("S08_map_enrichment_record", _ENRICHED_SQL)
def map_enrichment_record(t: Tables):
    texts = derived.enrichment_record_texts(t.raw_enrichment)
    return landing.land_enrichment_lines(texts, "text", keep=["id"]).select("id", *_ENRICHED)


@query("S09_raw_json", """
SELECT id, CAST(to_json({'id': id, 'period': period, 'location': location,
         'energy_source': energy_source, 'sector': sector}) AS VARCHAR) AS raw_json
FROM raw_eia""")
def raw_json(t: Tables):
    rows = t.raw_eia.select("id", "period", "location", "energy_source", "sector")
    return landing.with_raw_json(rows).select("id", "raw_json")


@query("S10_stamp", """
SELECT id, 'EIA' AS source, strftime(ingestion_date, '%Y-%m-%d %H:%M:%S') AS ingestion_timestamp
FROM raw_eia""")
def stamp(t: Tables):
    source, when = landing.stamp("EIA", F.col("ingestion_timestamp"))
    rows = t.raw_eia.select("id", source, when)
    return rows.withColumn(
        "ingestion_timestamp", F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss")
    )


@query("S11_append_batch", """
SELECT CAST(year(ingestion_date) AS BIGINT) AS year, count(*) AS rows_stored,
       (SELECT count(*) FROM raw_enrichment) AS rows_reported
FROM raw_enrichment GROUP BY ALL""")
def append_batch(t: Tables):
    """Two batches appended to one table, against the numbers the writes reported."""
    path = work_folder(t.spark, "append") + "/enrichment_data"
    early = F.col("period") < "2023"
    reported = landing.append_batch(t.raw_enrichment.filter(early), path)
    reported += landing.append_batch(t.raw_enrichment.filter(~early), path)
    stored = t.spark.read.schema(schemas.RAW_ENRICHMENT).parquet(path)
    return stored.groupBy(F.year("ingestion_timestamp").alias("year")).agg(
        F.count(F.lit(1)).alias("rows_stored"), F.lit(reported).alias("rows_reported")
    )


@query("S12_source_scans", f"""
SELECT 'eia_energy_data' AS table_name, location, count(*) AS n_rows, count(value) AS n_values,
       min(period) AS first_period, max(period) AS last_period FROM raw_eia GROUP BY location
UNION ALL
SELECT 'enrichment_data', location, count(*), count(temperature_avg), min(period), max(period)
FROM raw_enrichment GROUP BY location""")
def source_scans(t: Tables):
    scans.register_views(
        t.spark,
        {"eia_energy_data": t.raw_eia, "enrichment_data": t.raw_enrichment},
        prefix="wattlake_raw_",
    )
    return t.spark.sql("""
        SELECT 'eia_energy_data' AS table_name, location, count(*) AS n_rows,
               count(value) AS n_values, min(period) AS first_period, max(period) AS last_period
        FROM wattlake_raw_eia_energy_data GROUP BY location
        UNION ALL
        SELECT 'enrichment_data', location, count(*), count(temperature_avg), min(period),
               max(period)
        FROM wattlake_raw_enrichment_data GROUP BY location""")


@query("S13_views", """
SELECT 'generation' AS view_name, location, count(*) AS n_rows FROM gen GROUP BY location
UNION ALL SELECT 'consumption', location, count(*) FROM cons GROUP BY location
UNION ALL SELECT 'enrichment', location, count(*) FROM enr GROUP BY location""")
def views(t: Tables):
    scans.register_views(
        t.spark,
        {
            "stg_eia_energy_generation": t.generation,
            "stg_eia_energy_consumption": t.consumption,
            "stg_enrichment": t.enrichment,
        },
        prefix="wattlake_",
    )
    return t.spark.sql("""
        SELECT 'generation' AS view_name, location, count(*) AS n_rows
        FROM wattlake_stg_eia_energy_generation GROUP BY location
        UNION ALL SELECT 'consumption', location, count(*)
        FROM wattlake_stg_eia_energy_consumption GROUP BY location
        UNION ALL SELECT 'enrichment', location, count(*)
        FROM wattlake_stg_enrichment GROUP BY location""")


@query("S14_stored_mart", f"""
SELECT year, month, location_key, metric_key, {doubles("total_generation_mwh", "total_consumption_mwh",
       "renewable_percentage", "avg_temperature_fahrenheit")}
FROM report_rows""")
def stored_mart(t: Tables):
    path = work_folder(t.spark, "mart") + "/fct_energy_metrics"
    refresh.rebuild(t.fact, path)
    return t.spark.read.parquet(path).select(
        "year", "month", "location_key", "metric_key", "total_generation_mwh",
        "total_consumption_mwh", "renewable_percentage", "avg_temperature_fahrenheit",
    )


@query("S14_versioned_mart", f"""
SELECT year, month, location_key, metric_key, {doubles("total_generation_mwh", "total_consumption_mwh",
       "renewable_percentage", "avg_temperature_fahrenheit")}
FROM report_rows""")
def versioned_mart(t: Tables):
    """A first version of half of the locations, a second of all; the first one expires."""
    store = versions.VersionedStore(t.spark, work_folder(t.spark, "versions"))
    rows = refresh.with_partitions(t.fact)
    for part in (F.col("location_key") <= 5, F.lit(True)):
        store.commit({"fct_energy_metrics": versions.Write(rows.where(part), ("year", "month"))})
    store.expire(keep=1)
    return store.read("fct_energy_metrics", rows.schema).select(
        "year", "month", "location_key", "metric_key", "total_generation_mwh",
        "total_consumption_mwh", "renewable_percentage", "avg_temperature_fahrenheit",
    )


_NEWEST = """
ORDER BY time_key DESC, location_key, avg_temperature_fahrenheit NULLS LAST, population NULLS LAST,
  gdp_per_capita_usd NULLS LAST, industrial_activity_index NULLS LAST LIMIT """
_KEYS = {"time_key", "location_key", "population"}


def newest_sql(columns: list[str], n: int) -> str:
    picked = ", ".join(longs(c) if c in _KEYS else doubles(c) for c in columns)
    return f"SELECT {picked} FROM (SELECT * FROM fact {_NEWEST} {n})"


@query("S15_report_scan", newest_sql(scans.REPORT_COLUMNS, 5000))
def report_scan(t: Tables):
    return scans.report_scan(t.fact)


@query("S16_metrics_scan", newest_sql(scans.METRIC_COLUMNS, 1000))
def metrics_scan(t: Tables):
    return scans.metrics_scan(t.fact)
