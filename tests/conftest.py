from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wattlake import schemas  # noqa: E402
from wattlake.session import local_session  # noqa: E402

TEST_DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    # Plans are printed in full, for the tests that read them.
    full = {"spark.sql.maxMetadataStringLength": "20000", "spark.sql.debug.maxToStringFields": "500"}
    return local_session(8, app="wattlake-tests", **full)


@pytest.fixture(scope="session")
def sf_dir():
    return TEST_DATA


def _row(defaults: dict, values: dict, schema) -> tuple:
    merged = {**defaults, **values}
    unknown = set(merged) - set(schema.fieldNames())
    assert not unknown, unknown
    return tuple(
        Decimal(str(merged[f]))
        if isinstance(merged[f], (int, float)) and schema[f].dataType == schemas.MEASURE
        else merged[f]
        for f in schema.fieldNames()
    )


@pytest.fixture(scope="session")
def raw_eia(spark):
    """Raw rows from the fields that a test cares about."""
    defaults = {
        "id": 1, "source": "EIA", "ingestion_timestamp": dt.datetime(2024, 2, 1),
        "series_id": "ELEC.GEN.ALL", "period": "2024-01", "value": 10, "units": "MWh",
        "location": "CA", "location_type": "state", "energy_source": "solar", "sector": None,
        "raw_json": None,
    }

    def make(*rows: dict):
        data = [
            _row({**defaults, "id": i}, r, schemas.RAW_EIA) for i, r in enumerate(rows, start=1)
        ]
        return spark.createDataFrame(data, schemas.RAW_EIA)

    return make


@pytest.fixture(scope="session")
def raw_enrichment(spark):
    defaults = {
        "id": 1, "source": "FastAPI", "ingestion_timestamp": dt.datetime(2024, 2, 1),
        "period": "2024-01-01", "location": "US-CA", "temperature_avg": 60,
        "temperature_unit": "fahrenheit", "population": 2_000_000, "gdp_per_capita": 70_000,
        "industrial_activity_index": 100, "raw_json": None,
    }

    def make(*rows: dict):
        data = [
            _row({**defaults, "id": i}, r, schemas.RAW_ENRICHMENT)
            for i, r in enumerate(rows, start=1)
        ]
        return spark.createDataFrame(data, schemas.RAW_ENRICHMENT)

    return make


@pytest.fixture(scope="session")
def values(spark):
    """Result of a column expression over literal input rows, in order."""

    def evaluate(expression, names: str, *rows):
        data = [(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)]
        frame = spark.createDataFrame(data, "_row int, " + names)
        return [r._v for r in frame.select("_row", expression.alias("_v")).orderBy("_row").collect()]

    return evaluate
