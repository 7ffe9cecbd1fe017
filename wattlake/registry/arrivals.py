"""Dedupe, streams and incremental refresh: X01-X05."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.operators import joins
from wattlake.plans import fact, incremental, refresh
from wattlake.registry.core import Tables, query
from wattlake.registry.landing import _ENRICHED, _ENRICHED_SQL
from wattlake.registry.models import _fact_sql
from wattlake.registry.sql import doubles
from wattlake.session import work_folder
from wattlake.sources import derived
from wattlake.streaming import arrivals


@query("X01_latest_enrichment", f"""
SELECT source_id, CAST(period_date AS VARCHAR) AS period_date, location,
       {doubles("temperature_fahrenheit")}, population
FROM (SELECT *, row_number() OVER (PARTITION BY period_date, location
             ORDER BY ingestion_date DESC, source_id DESC) AS n FROM enr) WHERE n = 1""")
def latest_enrichment(t: Tables):
    latest = joins.latest_by(
        t.enrichment, ["period_date", "location"], ["ingestion_timestamp", "source_id"]
    )
    return latest.select(
        "source_id", "period_date", "location", "temperature_fahrenheit", "population"
    )


@query("X01_fact_without_fanout", """
SELECT DISTINCT metric_key, CAST(1 AS BIGINT) AS n_records FROM fact""")
def fact_without_fanout(t: Tables):
    """With the latest enrichment only, every fact key occurs once."""
    latest = joins.latest_by(
        t.enrichment, ["period_date", "location"], ["ingestion_timestamp", "source_id"]
    )
    base = fact.base_rows(t.raw_eia, t.dims)
    rows = fact.add_enrichment(base, latest, t.dims)
    return rows.groupBy("metric_key").agg(F.count(F.lit(1)).alias("n_records"))


@query("X02_stream_landing", _ENRICHED_SQL)
def stream_landing(t: Tables):
    """Arrived record files, landed by a stream that is run twice."""
    folder = work_folder(t.spark, "landing")
    texts = derived.enrichment_record_texts(t.raw_enrichment)
    texts.write.parquet(f"{folder}/arrived")

    def run() -> None:
        lines = arrivals.read_files(t.spark, f"{folder}/arrived", texts.schema, "*.parquet")
        lines = lines.withColumnRenamed("text", "value")
        arrivals.append_enrichment(
            lines, f"{folder}/raw", f"{folder}/checkpoint", keep=("id",)
        ).awaitTermination()

    run()
    run()  # starts from the checkpoint and finds nothing new
    return t.spark.read.parquet(f"{folder}/raw").select("id", *_ENRICHED)


@query("X03_stream_dedupe", "SELECT event_id, user_id, event_type, value FROM events")
def stream_dedupe(t: Tables):
    """Every event arrives twice; the delay spans the replayed month, so no row is late."""
    folder = work_folder(t.spark, "dedupe")
    once = arrivals.read_files(t.spark, t.sf_dir, arrivals.EVENTS, "events.parquet")
    twice = once.union(arrivals.read_files(t.spark, t.sf_dir, arrivals.EVENTS, "events.parquet"))
    first = arrivals.first_arrivals(twice, delay="31 days")
    arrivals.write_available(first, f"{folder}/events", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{folder}/events").select(
        "event_id", "user_id", "event_type", "value"
    )


@query("X04_hourly_arrivals", """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS n
FROM events
WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR
      <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
GROUP BY ALL""")
def hourly_arrivals(t: Tables):
    """Counts of the hours that the watermark has closed when all events have arrived."""
    folder = work_folder(t.spark, "hours")
    stream = arrivals.read_files(t.spark, t.sf_dir, arrivals.EVENTS, "events.parquet")
    counts = arrivals.hourly_counts(stream, delay="1 hour")
    arrivals.write_available(counts, f"{folder}/hours", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{folder}/hours").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n"
    )


@query("X05_incremental_refresh", _fact_sql())
def incremental_refresh(t: Tables):
    """A mart built from the rows before 2024, brought up to date by its changed months."""
    path = work_folder(t.spark, "refresh") + "/fct_energy_metrics"
    early = F.col("ingestion_timestamp") < F.lit("2024-01-01").cast("timestamp_ntz")
    refresh.rebuild(
        fact.build(t.raw_eia.filter(early), t.raw_enrichment.filter(early), t.dims), path
    )
    months = refresh.changed_months(t.raw_eia.filter(~early), t.raw_enrichment.filter(~early), dims=t.dims)
    refresh.refresh(t.raw_eia, t.raw_enrichment, months, path, t.dims)
    return t.spark.read.parquet(path).select(*fact.OUTPUT_COLUMNS)


@query("X05_incremental_state", _fact_sql())
def incremental_state(t: Tables):
    """A mart grown by three batches from mergeable state; the third one is sent twice."""
    mart = incremental.IncrementalMart(t.spark, work_folder(t.spark, "state") + "/mart", t.dims)
    arrived = F.year("ingestion_timestamp")
    batches = {"early": arrived < 2023, "2023": arrived == 2023, "late": arrived > 2023}
    for name, part in [*batches.items(), ("late", batches["late"])]:
        mart.apply(t.raw_eia.where(part), t.raw_enrichment.where(part), batch=name)
    return mart.read().select(*fact.OUTPUT_COLUMNS)
