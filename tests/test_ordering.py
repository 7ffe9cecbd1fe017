"""Row numbers of a total order."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wattlake.operators import ordering


def test_numbers_equal_a_window_over_all_rows(spark):
    rows = spark.range(3000).selectExpr("IF(id % 7 = 0, NULL, id % 11) AS lead", "id * 7919 % 3000 AS key")
    order = [F.desc_nulls_first("lead"), F.asc_nulls_last("key")]
    found = ordering.numbered(rows.repartition(5), order)
    assert found.columns == ["lead", "key", "position"]
    expected = rows.collect()
    expected.sort(key=lambda r: (r.lead is not None, -(r.lead or 0), r.key))
    got = sorted(found.collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, 3001))
    assert [(r.lead, r.key) for r in got] == [(r.lead, r.key) for r in expected]


def test_the_numbering_reads_parts_and_no_window_reads_the_rows(spark):
    rows = spark.range(20_000).withColumn("n", F.col("id") % 3)
    found = ordering.numbered(rows, ["n", "id"])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The window's input is the grouping by partition; the rows meet its result in a broadcast join.
    assert plan.count("Window") >= 1 and "BroadcastHashJoin" in plan
    window = plan[plan.index("Window"):]
    assert "HashAggregate(keys=[_partition" in window and "SortMergeJoin" not in plan


def test_ties_names_and_empty_tables(spark):
    rows = spark.range(40).selectExpr("1 AS k", "id % 2 AS _partition", "'x' AS _rows", "2 AS _before", "3 AS `a.b`")
    found = ordering.numbered(rows, ["k"])
    assert found.columns == [*rows.columns, "position"]
    assert sorted(r.position for r in found.collect()) == list(range(1, 41))
    assert {(r._rows, r._before) for r in found.collect()} == {("x", 2)}
    assert ordering.numbered(rows.limit(0), ["k"]).count() == 0
    with pytest.raises(ValueError, match="position"):
        ordering.numbered(rows.withColumn("position", F.lit(1)), ["k"])
