"""Queries of this package with production settings, over whole tables, and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import (
    decontaminate,
    importance,
    jaccard_join,
    language,
    licences,
    line_quality,
    packing,
    pii,
    runs,
    suffix_tree,
    token_count,
    token_files,
    whitening,
)
from wattlake.session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TOKEN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), digest=True)


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_folder(spark, 'token-files')}/files"
    token_files.write(table(spark, sf_dir, "documents"), path)
    return token_files.read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query(
    "op5_decontamination",
    f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, len(w[s:s + 9]) AS n, array_to_string(w[s:s + 9], ' ') AS k
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0
),
hit AS (
  SELECT DISTINCT x.doc_id, x.s, x.n, win.item
  FROM (
    SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS k
    FROM d, (SELECT DISTINCT n FROM win) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(s)
  ) AS x JOIN win ON win.n = x.n AND win.k = x.k
),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
  CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op7_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(spark, table(spark, sf_dir, "documents"))


@query(
    "op8_quality_rules",
    f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_TOKEN}') AS w FROM documents
),
windows AS (
  SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, w[s], w[s + 1], w[s + 2]) AS n
  FROM d, unnest(range(1, len(w) - 1)) AS t(s)
),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([s, s + 1, s + 2]) AS p FROM windows WHERE n > 1) GROUP BY doc_id
),
raw_lines AS (
  SELECT doc_id, host, line, array_to_string(regexp_extract_all(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TOKEN}'), ' ') AS norm,
    len(regexp_extract_all(line, '{_TOKEN}')) AS n
  FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_TOKEN}')
),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM raw_lines GROUP BY doc_id),
line_counts AS (SELECT doc_id, host, norm, sum(n) AS n FROM raw_lines GROUP BY ALL),
lines AS (
  SELECT * FROM line_counts JOIN (
    SELECT doc_id, md5(array_to_string(list_sort(list(norm)), chr(10))) AS lines_of
    FROM line_counts GROUP BY doc_id
  ) USING (doc_id)
),
common AS (
  SELECT host, norm, arg_min(lines_of, doc_id) AS stays FROM lines
  GROUP BY host, norm HAVING count(DISTINCT lines_of) >= 5
),
removed AS (
  SELECT doc_id, sum(n) AS removed FROM lines JOIN common USING (host, norm)
  WHERE lines_of <> stays GROUP BY doc_id
),
figures AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(removed, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN removed USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND 100 * (n_words - removed_words) >= 30 * n_words AND n_words - removed_words >= 50 AS kept
FROM figures
""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(spark, table(spark, sf_dir, "documents"))


def _licence_rows() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(
        f"({i}, {quote(licence)}, {quote(text)})" for i, (licence, text) in enumerate(licences.TEMPLATES)
    )


@query(
    "op10_licence_scan",
    f"""
WITH t AS (SELECT * FROM (VALUES {_licence_rows()}) AS v(template, licence, text)),
u AS (
  SELECT DISTINCT doc_id, text AS unit FROM (
    SELECT doc_id, unnest(list_append(string_split(coalesce(text, ''), chr(10)), coalesce(text, ''))) AS text
    FROM documents)
),
tw AS (SELECT template, licence, {_WORDS} AS w FROM t),
tb AS (SELECT DISTINCT template, licence, w[i] || ' ' || w[i + 1] AS bigram
  FROM tw, unnest(range(1, len(w))) AS s(i)),
uw AS (SELECT doc_id, unit, {_WORDS.replace("text", "unit")} AS w FROM u),
ub AS (SELECT DISTINCT doc_id, unit, w[i] || ' ' || w[i + 1] AS bigram
  FROM uw, unnest(range(1, len(w))) AS s(i)),
us AS (SELECT doc_id, unit, count(*) AS m FROM ub GROUP BY doc_id, unit),
ts AS (SELECT template, count(*) AS n FROM tb GROUP BY template),
found AS (
  SELECT doc_id, unit, template, licence, count(*) AS shared FROM ub JOIN tb USING (bigram) GROUP BY ALL
),
scored AS (
  SELECT doc_id, unit, licence, 2.0 * CAST(shared AS DOUBLE) / (m + n) AS dice
  FROM found JOIN us USING (doc_id, unit) JOIN ts USING (template) WHERE 200 * shared >= 80 * (m + n)
),
best AS (
  SELECT doc_id, count(DISTINCT unit) AS n_units,
    array_to_string(list_sort(list(DISTINCT licence)), ',') AS licences, max(dice) AS best_dice
  FROM scored GROUP BY doc_id
)
SELECT DISTINCT d.doc_id, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units, coalesce(licences, '') AS licences,
  coalesce(best_dice, 0.0) AS best_dice
FROM documents AS d LEFT JOIN best USING (doc_id)
""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(spark, table(spark, sf_dir, "documents"))


@query("op6_suffix_tree_scores")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(spark, table(spark, sf_dir, "documents"))


@query("op1_personal_data")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(spark, table(spark, sf_dir, "documents"))
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(text(F.col("base")), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


@query("op9_importance_resampling")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(
        spark,
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        (F.col("quality") == 1) & (F.col("toxic") == 0),
    )


@query("op11_spectrum_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings"))


def tiled(doc_id: object, words: list[bytes]) -> list[bytes]:
    """Words of a tenth of the documents repeat from some place on, as the contract of op12 says."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n or doc_id is None:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a : a + p]
    return words[:a] + (root * ((n - a) // p + 1))[: n - a]


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.find_runs(table(spark, sf_dir, "documents"), prepare=tiled))


@query("op13_language_id")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return language.identify(spark, documents, ~held_out).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
