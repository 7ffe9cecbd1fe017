"""From raw documents to packed training sequences, with the operators of wattlake.llm.

Stages run one after the other, each on all that the one before has kept. Every row has its own
verdict, also where ids are null or repeated: such rows get a key, by which they are judged and
dropped. All columns of documents go along.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import decontaminate, jaccard_join, line_quality, packing, pii
from wattlake.session import shuffles_dropped, work_folder

#: Most ids that are sent to all executors to drop their documents; beyond, Spark shuffles.
BROADCAST_IDS = 1_000_000
#: Near copies of the stage: Jaccard similarity of five-word shingles, in hundredths.
NEAR_WORDS, NEAR_PERCENT = 5, 80

#: Different texts of a host from which on a line is common to them, however large the host.
COMMON_TEXTS = 5


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents with a column that tells all rows apart, and that column's name.

    It is doc_id where no id is null or repeated, for which ids alone are counted. Otherwise the
    rows are written with a key: once written it stays the same in every job and on every retry.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("doc_id IS NULL OR n > 1").isEmpty():
        return docs, "doc_id"
    key = next(name for name in (f"row_key{i}" for i in itertools.count()) if name not in docs.columns)
    path = f"{work_folder(docs.sparkSession, 'keyed')}/docs"
    docs.withColumn(key, F.monotonically_increasing_id()).write.parquet(path)
    return docs.sparkSession.read.parquet(path), key


def _without(docs: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """Documents whose key is not among the dropped ones (their column doc_id), without a key added.

    The keys are written first: their check of size and the join then read a small table, where
    each would else run the whole operator.
    """
    spark = docs.sparkSession
    path = f"{work_folder(spark, 'dropped')}/ids"
    dropped.select(F.col("doc_id").alias("dropped_id")).distinct().write.parquet(path)
    ids = spark.read.parquet(path)
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    kept = docs.join(ids, docs[key] == ids["dropped_id"], "left_anti")
    return kept if key == "doc_id" else kept.drop(key)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repetitive, short and depleted documents."""
    docs, key = _keyed(docs)
    judged = line_quality.judge(spark, docs, id_col=key, least_docs=COMMON_TEXTS, host_percent=None)
    return _without(docs, key, judged.where("NOT kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: that with the least id, null ids last."""
    docs, key = _keyed(docs)
    with shuffles_dropped(spark):
        found = jaccard_join.near_duplicates(spark, docs, NEAR_WORDS, NEAR_PERCENT, id_col=key)
        if key == "doc_id":
            return _without(docs, key, found.where("component_id <> doc_id"))
    # The order of keys is that of files; the row that stays goes by its id.
    path = f"{work_folder(spark, 'groups')}/rows"
    ids = docs.select(F.col(key).alias("row"), F.col("doc_id").alias("id"))
    found.select(F.col("doc_id").alias("row"), "component_id").join(ids, "row").write.parquet(path)
    rows = spark.read.parquet(path)
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    first = rows.groupBy("component_id").agg(F.min(order)["row"].alias("stays"))
    others = rows.join(first, "component_id").where("row <> stays")
    return _without(docs, key, others.select(F.col("row").alias("doc_id")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    docs, key = _keyed(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs, items, id_col=key)
    return _without(docs, key, found.where("contaminated"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind; n_chars follows."""
    return pii.find(spark, docs, masked=tuple(docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all pieces with their place in the packed sequences."""
    return packing.pack(spark, docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

# SQL has neither the hashing of the join at whole size, nor the model, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each result is written and read again by the next."""
    folder = work_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
