"""Streams: landing with restart and retry, dedupe, and hourly counts."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from wattlake.streaming import arrivals


def _events(spark, *rows):
    data = [(i, t, 1, "view", 1.0, "{}") for i, t in rows]
    frame = spark.createDataFrame(data, "event_id long, ts string, user_id long, event_type string, value double, props string")
    return frame.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1)


def _records(spark, first: int, n: int):
    texts = [
        (i, json.dumps({"location": "US-CA", "period": "2024-01", "temperature_fahrenheit": i, "population": 5}))
        for i in range(first, first + n)
    ]
    return spark.createDataFrame(texts, "id long, value string").coalesce(1)


def test_landing_goes_on_and_repeats_safely(spark, tmp_path):
    folder, raw, checkpoint = (str(tmp_path / p) for p in ("in", "raw", "checkpoint"))

    def run():
        schema = _records(spark, 0, 1).schema
        lines = arrivals.read_files(spark, folder, schema, "*.parquet", files_per_batch=1)
        arrivals.append_enrichment(lines, raw, checkpoint, keep=("id",)).awaitTermination()
        return spark.read.parquet(raw)

    _records(spark, 0, 3).write.mode("append").parquet(folder)
    _records(spark, 3, 2).write.mode("append").parquet(folder)
    landed = run()
    assert landed.count() == 5 and landed.select("batch_id").distinct().count() == 2
    _records(spark, 5, 4).write.mode("append").parquet(folder)
    assert run().count() == 9
    # The commit of the last batch is lost: it runs again and replaces its own rows.
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].rename(tmp_path / "lost-commit")
    hidden = tmp_path / "checkpoint" / "commits" / f".{commits[-1].name}.crc"
    if hidden.exists():
        hidden.rename(tmp_path / "lost-commit.crc")
    again = run()
    assert again.count() == 9 and again.select("id").distinct().count() == 9
    assert again.filter("temperature_unit = 'fahrenheit'").count() == 9


def test_dedupe_and_hours(spark, tmp_path):
    folder = str(tmp_path / "events")
    hours = ["00:10", "00:50", "01:20", "03:30", "04:40"]
    rows = [(i, f"2024-01-01 {h}:00") for i, h in enumerate(hours)]
    _events(spark, *rows, *rows[:3]).write.parquet(folder)
    stream = arrivals.read_files(spark, folder, arrivals.EVENTS, "*.parquet")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c1")
    arrivals.write_available(arrivals.first_arrivals(stream), out, checkpoint).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]
    counts = arrivals.hourly_counts(arrivals.read_files(spark, folder, arrivals.EVENTS, "*.parquet"))
    out, checkpoint = str(tmp_path / "hours"), str(tmp_path / "c2")
    arrivals.write_available(counts, out, checkpoint).awaitTermination()
    found = {r.window_start.hour: r.n for r in spark.read.parquet(out).collect()}
    # The watermark stands at 03:40: the hours from 03:00 on are still open.
    assert found == {0: 4, 1: 2}


def test_two_streams_into_one_table_keep_all_rows(spark, tmp_path):
    for name, first, n in (("a", 0, 5), ("b", 5, 3)):
        _records(spark, first, n).write.parquet(str(tmp_path / name))
        lines = arrivals.read_files(spark, str(tmp_path / name), _records(spark, 0, 1).schema, "*.parquet")
        arrivals.append_enrichment(
            lines, str(tmp_path / "raw"), str(tmp_path / f"checkpoint-{name}"), keep=("id",)
        ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 8
