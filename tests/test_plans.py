"""The physical plans: scans, pushed filters and join kinds."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from wattlake import schemas
from wattlake.plans import combined, fact, staging
from wattlake.registry.core import Tables


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    """Raw tables as stored Parquet, the form that the models read on a cluster."""
    tables = Tables(spark, sf_dir)
    folder = tmp_path_factory.mktemp("landed")
    tables.raw_eia.write.parquet(f"{folder}/eia")
    tables.raw_enrichment.write.parquet(f"{folder}/enrichment")
    return (
        spark.read.schema(schemas.RAW_EIA).parquet(f"{folder}/eia"),
        spark.read.schema(schemas.RAW_ENRICHMENT).parquet(f"{folder}/enrichment"),
    )


def executed(frame) -> str:
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    # Initial plans, that of the whole at the left edge and those of subqueries further in.
    kept, inner = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :"))
        if inner is not None and depth < inner:
            inner = None
        if inner is None and "== Initial Plan ==" in line:
            inner = depth
        if inner is None:
            kept.append(line)
    return "\n".join(kept)


def scans_of(plan: str, folder: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan" in line and f"/{folder}" in line]


def test_fact_reads_the_raw_layer_once(landed):
    plan = executed(fact.build(*landed))
    scan = scans_of(plan, "eia")
    assert len(scan) == 1 and "ReusedExchange" in plan
    assert "raw_json" not in scan[0] and "IsNotNull(location)" in scan[0]
    assert "GreaterThanOrEqual(value,0" in scan[0]
    # The enrichment is read for its columns and for its keys, and neither read is shuffled
    # beyond the distinct keys.
    assert len(scans_of(plan, "enrichment")) == 2
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_combined_reads_the_raw_layer_once(landed):
    plan = executed(combined.combine(*landed))
    assert len(scans_of(plan, "eia")) == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # The enrichment is spread by parts of hot keys and probes the small side without a sort.
    join = next(line for line in plan.splitlines() if "ShuffledHashJoin" in line)
    assert "_part" in join and "LeftOuter, BuildLeft" in join
    # It is read for its columns and, for the counts of its keys, in one grouping.
    assert len(scans_of(plan, "enrichment")) == 2 and "ReusedExchange" in plan


def test_staging_is_one_stage(landed):
    plan = executed(staging.stage_generation(landed[0]))
    assert "Exchange" not in plan
    assert "IsNotNull(energy_source)" in plan and "GreaterThanOrEqual(value,0" in plan


def test_report_limit_is_a_top_n(landed):
    from wattlake.sources import scans

    plan = scans.metrics_scan(fact.build(*landed))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_windows_are_partitioned(spark, sf_dir):
    plan = Tables(spark, sf_dir).combined._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line):
            assert "period_date" in line.rsplit("[", 1)[1]


def test_report_columns(spark, sf_dir):
    rows = Tables(spark, sf_dir).report_rows
    bad = rows.filter(F.date_format("date", "yyyyMMdd").cast("int") != F.col("time_key"))
    assert bad.isEmpty()
