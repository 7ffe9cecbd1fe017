"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import connect, verdict_of  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from wattlake.registry.core import ENTRIES  # noqa: E402
from wattlake.registry.sql import COMMON  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query(spark, duck, sf_dir, name):
    frame = queries()[name](spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    # No Python in the tasks, and no join of all pairs.
    assert not re.search(r"Python|BatchEval|MapInPandas|CartesianProduct|NestedLoop", plan)
    verdict, *_ = verdict_of(frame, duck, name)
    assert verdict == "ok", verdict


def test_registry_covers_the_inventory():
    counts = {"S": 16, "G": 13, "D": 8, "P": 28, "F": 6, "J": 8, "A": 18, "T": 5, "Q": 14, "R": 8, "X": 5}
    wanted = {f"{letter}{i:02d}" for letter, n in counts.items() for i in range(1, n + 1)}
    assert {name.split("_")[0] for name in ENTRIES} == wanted
    assert set(ENTRIES) <= set(oracle_sql())
    # The corpus operators, if they are there, have their own tests.
    others = set(queries()) - set(ENTRIES)
    assert all(n == "pipeline" or re.match(r"op\d+_", n) for n in others)


def test_units_by_priority_and_not_by_place(duck):
    raw = """raw_eia AS (SELECT unnest(['kWh, formerly MWh', 'GWh or kWh', 'megawatthours', NULL])
                         AS units)"""
    tables = [raw, *(f"{n} AS ({COMMON[n]})" for n in ("unit_rules", "unit_factors"))]
    rows = duck.execute(f"WITH {', '.join(tables)} SELECT * FROM unit_factors").fetchall()
    assert {u: float(f) for u, f in rows} == {
        "kWh, formerly MWh": 1.0, "GWh or kWh": 1000.0, "megawatthours": 1.0, None: 1.0,
    }


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
