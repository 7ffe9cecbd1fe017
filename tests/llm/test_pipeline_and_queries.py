from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tools import check_oracle
from wattlake.llm import registry


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    verdict, rows, _ = check_oracle.verdict_of(
        entry.queries()[name](spark, sf_dir), check_oracle.connect(sf_dir), name
    )
    assert verdict == "ok" and rows


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_stages_filter_and_keep_the_columns(spark, sf_dir):
    first = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # More columns, whose names the operators use themselves.
    docs = first.selectExpr("*", "1 AS key", "'x' AS node", "doc_id AS row")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf_dir)
        assert docs.schema.names == before.schema.names
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < counts[0]
    clean = {r.doc_id: r.text for r in docs.collect()}
    raw = {r.doc_id: r.text for r in first.collect()}
    changed = [i for i in clean if clean[i] != raw[i]]
    assert changed and all("<" in clean[i] for i in changed)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == set(clean)


def test_near_copies_from_four_fifths_up_go(spark, sf_dir):
    words = [f"w{i}" for i in range(200)]
    own = [f"x{i}" for i in range(40)]
    # The second text has 18 % appended, the third three words changed, the fourth too much appended.
    texts = [words, words + own[:36], [*words[:50], "a", *words[51:100], "b", *words[101:150], "c", *words[151:]]]
    texts += [words + [f"y{i}" for i in range(90)]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts, start=1)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]


def test_rows_are_judged_by_themselves_where_ids_are_null_or_repeated(spark, sf_dir):
    def text(seed):
        return " ".join(f"word{(seed * 7919 + i * i * 31) % 100_003}" for i in range(80))

    item = next(r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if len(r.text.split()) > 10)
    rows = [
        (None, text(1)), (None, "too short"), (None, f"{text(2)} {item}"), (None, None),
        # An id with a clean, a short and a contaminated text.
        (7, text(3)), (7, "short"), (7, f"{text(4)} {item}"),
        # Repeated rows, and a copy with a smaller id in a later row.
        (9, text(5)), (9, text(5)), (8, text(5)), (None, text(5)),
    ]
    docs = spark.createDataFrame([(*r, "host", "x") for r in rows], "doc_id long, text string, source string, row_key0 string")
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.near_duplicates, corpus_pipeline.decontamination):
        docs = stage(spark, docs.repartition(3), sf_dir)
        assert docs.columns == ["doc_id", "text", "source", "row_key0"]
    kept = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    assert kept == sorted([(None, text(1)), (7, text(3)), (8, text(5))], key=str)


def test_pipeline_of_an_empty_table(spark, sf_dir, tmp_path):
    for table in ("documents", "benchmark"):
        frame = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        (frame.limit(0) if table == "documents" else frame).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_sql_runs_on_the_given_views(sf_dir):
    connection: duckdb.DuckDBPyConnection = check_oracle.connect(sf_dir)
    for sql in registry.SQL.values():
        connection.execute(f"EXPLAIN {sql}")


def test_the_join_drops_its_shuffles(spark, sf_dir, monkeypatch):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen = []
    found = corpus_pipeline.jaccard_join.near_duplicates

    def spied(*args, **more):
        seen.append(spark.conf.get(key))
        return found(*args, **more)

    monkeypatch.setattr(corpus_pipeline.jaccard_join, "near_duplicates", spied)
    before = spark.conf.get(key, None)
    docs = spark.createDataFrame([(i, "a b c d e f g") for i in range(4)], "doc_id long, text string")
    assert corpus_pipeline.near_duplicates(spark, docs, sf_dir).count() == 1
    assert seen == ["true"] and spark.conf.get(key, None) == before
