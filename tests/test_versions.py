"""Versioned tables and the mart that grows by state."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wattlake.plans import fact, incremental
from wattlake.sources.versions import ConflictError, VersionedStore, Write

BY = ("year", "month")


@pytest.fixture
def rows(spark):
    def make(*values):
        return spark.createDataFrame(list(values), "year int, month int, v int")

    return make


def content(store, schema, **options):
    return sorted(tuple(r) for r in store.read("t", schema, **options).select("year", "month", "v").collect())


def test_commits_replace_append_and_expire(spark, rows, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    schema = rows((1, 1, 1)).schema
    assert content(store, schema) == [] and store.snapshot().number == 0
    first = store.commit({"t": Write(rows((2024, 1, 1), (2024, 2, 2)), BY)})
    store.commit({"t": Write(rows((2024, 2, 20)), BY, frozenset({"year=2024/month=2", "year=2024/month=3"}))})
    assert content(store, schema) == [(2024, 1, 1), (2024, 2, 20)]
    # A reader of an older snapshot still sees it.
    assert content(store, schema, snapshot=first) == [(2024, 1, 1), (2024, 2, 2)]
    store.commit({"t": Write(rows((2024, 2, 21), (2024, 4, 4)), BY, appends=True)})
    assert content(store, schema, partitions=["year=2024/month=2", "year=1/month=1"]) == [(2024, 2, 20), (2024, 2, 21)]
    # A replaced partition without rows is gone.
    store.commit({"t": Write(rows().limit(0), BY, frozenset({"year=2024/month=1"}))})
    wanted = [(2024, 2, 20), (2024, 2, 21), (2024, 4, 4)]
    assert content(store, schema) == wanted
    assert len(store.expire(keep=1)) >= 1 and content(store, schema) == wanted
    assert store.expire(keep=1) == []
    with pytest.raises(Exception):
        store.snapshot(1)
    store.compact("t", schema, BY, most=1)
    assert content(store, schema) == wanted
    assert all(len(f) == 1 for f in store.snapshot().folders["t"].values())
    with pytest.raises(ValueError, match="outside"):
        store.commit({"t": Write(rows((2025, 1, 1)), BY, frozenset({"year=2024/month=1"}))})
    assert content(store, schema) == wanted


def test_a_reader_prunes_partitions(spark, rows, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    frame = rows((2024, 1, 1), (2024, 2, 2))
    store.commit({"t": Write(frame, BY)})
    plan = store.read("t", frame.schema).where("month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_a_write_that_dies_leaves_the_old_version(spark, rows, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    schema = rows((1, 1, 1)).schema
    store.commit({"t": Write(rows((2024, 1, 1)), BY), "u": Write(rows((2024, 1, 5)), BY)})
    # The first table is written, the second one fails in its tasks.
    dies = rows((2024, 1, 6)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        store.commit({"t": Write(rows((2024, 1, 2)), BY), "u": Write(dies, BY)})
    assert content(store, schema) == [(2024, 1, 1)] and store.snapshot().number == 1
    assert store.read("u", schema).first().v == 5
    store.commit({"t": Write(rows((2024, 1, 3)), BY)})
    assert content(store, schema) == [(2024, 1, 3)]
    # The dead writer's folder has the number of a commit since made by another: it expires.
    assert len(list((tmp_path / "t").iterdir())) == 3
    store.expire(keep=1)
    assert len(list((tmp_path / "t").iterdir())) == 1 and content(store, schema) == [(2024, 1, 3)]


def test_the_slower_of_two_writers_gets_an_error(spark, rows, tmp_path):
    store = VersionedStore(spark, str(tmp_path))
    frame = rows((2024, 1, 1))
    base = store.commit({"t": Write(frame, BY)})
    store.commit({"t": Write(rows((2024, 1, 2)), BY)}, base)
    with pytest.raises(ConflictError):
        store.commit({"t": Write(rows((2024, 1, 3)), BY)}, base)
    assert content(store, frame.schema) == [(2024, 1, 2)]
    again = store.commit({"t": Write(rows((2024, 1, 4)), BY)}, tag="batch 7")
    assert store.commit({"t": Write(rows((2024, 1, 5)), BY)}, tag="batch 7").number == again.number
    assert content(store, frame.schema) == [(2024, 1, 4)]


# State


def compared(frame):
    return sorted((tuple(r) for r in frame.select(*fact.OUTPUT_COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def arrivals(spark, raw_eia, raw_enrichment):
    rng = random.Random(11)
    eia, enrichment = [], []
    for _ in range(300):
        eia.append({
            "period": rng.choice(["2024-01", "2024-02", "2024-02-10", "2023-12", "2024", "2035-01", "n/a"]),
            "location": rng.choice(["CA", "TX", "US", "ZZ", None]), "value": rng.choice([1, 2.5, -1, None, 1000]),
            "units": rng.choice(["MWh", "GWh", "kWh", None]), "energy_source": rng.choice(["solar", "coal", "tidal", None]),
            "sector": rng.choice([None, None, "residential", "industrial", "other"]),
            "series_id": rng.choice(["ELEC.GEN.ALL", "ELEC.SALES.X", None]),
        })
    for _ in range(60):
        enrichment.append({
            "period": rng.choice(["2024-01-01", "2024-02-01", "2023-12-01", "2030-05-01"]),
            "location": rng.choice(["US-CA", "US-TX", "US"]), "temperature_avg": rng.choice([None, 20, 75.5]),
            "population": rng.randint(1, 9) * 1_000_000,
        })
    return raw_eia(*eia), raw_enrichment(*enrichment)


@pytest.mark.parametrize("seed", [1, 2])
def test_state_of_any_batches_equals_a_rebuild(spark, arrivals, tmp_path, seed):
    eia, enrichment = arrivals
    mart = incremental.IncrementalMart(spark, str(tmp_path))
    part = lambda rows, k: rows.where(F.abs(F.hash("id", F.lit(seed))) % 3 == k)
    for k in (2, 0, 1):
        mart.apply(part(eia, k), part(enrichment, k), batch=f"b{k}")
    mart.apply(part(eia, 0), part(enrichment, 0), batch="b0")
    want = compared(fact.build(eia, enrichment))
    assert len(want) > 10 and compared(mart.read()) == want
    # A batch without rows, and one outside of the calendar, change nothing.
    mart.apply(eia.limit(0), enrichment.limit(0))
    mart.apply(eia.where("period = '2035-01'"), enrichment.limit(0))
    assert compared(mart.read()) == want


def test_late_rows_touch_their_keys_only(spark, raw_eia, raw_enrichment, tmp_path):
    mart = incremental.IncrementalMart(spark, str(tmp_path))
    mart.apply(
        raw_eia({"location": "CA"}, {"location": "TX"}, {"location": "CA", "period": "2024-03"}),
        raw_enrichment({"period": "2024-01-01"}),
    )
    before = mart.store.snapshot()
    late_eia, late_enrichment = raw_eia({"location": "TX", "value": 5, "energy_source": "coal"}), raw_enrichment()
    # All that is read of the raw layer is the batch; of the state the months that it touches.
    for write in mart.plan(late_eia, late_enrichment.limit(0), before).values():
        for path in write.rows.inputFiles():
            assert "/batch-" in path or "wattlake-batch-" in path or "year=2024/month=1/" in path
    after = mart.apply(late_eia, late_enrichment.limit(0))
    january, march = "year=2024/month=1", "year=2024/month=3"
    for table in (incremental.CUBE, incremental.MART):
        assert after.folders[table][march] == before.folders[table][march]
        assert after.folders[table][january] != before.folders[table][january]
    assert after.folders[incremental.ENRICHMENT] == before.folders[incremental.ENRICHMENT]
    found = {(r.time_key, r.location_key): (r.total_generation_mwh, r.population) for r in mart.read().collect()}
    assert {k: (float(v[0]), v[1]) for k, v in found.items()} == {
        (20240101, 6): (10.0, 2_000_000), (20240101, 7): (15.0, None), (20240301, 6): (10.0, None),
    }
    # Enrichment that comes after its energy replaces the row without any.
    mart.apply(raw_eia({}).limit(0), raw_enrichment({"location": "US-TX"}, {"location": "US-TX", "population": 7}))
    rows = mart.read().where("location_key = 7").collect()
    assert sorted(r.population for r in rows) == [7, 2_000_000] and {r.metric_key for r in rows} == {rows[0].metric_key}
    assert dt.date(2024, 1, 1) in {r.period_date for r in mart.read(incremental.CUBE).collect()}
