"""Quality selection by importance resampling.

Two generative models over hashed word n-grams (one and two words), one of target texts and one of
all texts, give each text the log of the ratio of its probabilities. Adding Gumbel noise to it and
taking the k largest is a sample without replacement, weighted by that ratio. The noise is a
function of the id, so a sample can be drawn again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.arrow import id_and_text, map_in_arrow
from wattlake.llm.text import chunks, combine, words_of
from wattlake.session import work_folder

BUCKETS = 1 << 16
#: Most target documents that the target model is fitted on, those with the smallest id hashes.
TARGET_ROWS = 200_000
#: Counts of the raw text at which a bucket's ratio is halfway between neutral and observed.
PRIOR = 20.0


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all one- and two-word n-grams, and the text of each."""
    words = words_of(texts, lower=True)
    h = words.hashes
    owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
    if len(h) < 2:
        return (h % np.uint64(BUCKETS)).astype(np.int64), owner
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = combine(h[inside], h[inside + 1])
    codes = np.concatenate([combine(h), pairs]) % np.uint64(BUCKETS)
    return codes.astype(np.int64), np.concatenate([owner, owner[inside]])


def ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log of target over raw probability of each bucket; neutral without a target."""
    if not target.sum():
        return np.zeros(BUCKETS)
    share = target.sum() / raw.sum()
    return np.log((target + PRIOR * share) / (raw + PRIOR) / share)


def bucket_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each bucket in all texts and in those marked as target: at most BUCKETS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            flags = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
            for rows, texts in chunks(batch):
                codes, owner = features(texts)
                counts[0] += np.bincount(codes, minlength=BUCKETS)
                mine = flags[rows.start : rows.start + len(texts)][owner]
                counts[1] += np.bincount(codes[mine], minlength=BUCKETS)
        seen = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(counts[0][seen]), pa.array(counts[1][seen])],
            names=["bucket", "raw", "target"],
        )

    summed = (
        map_in_arrow(docs.select("text", "target"), run, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toArrow()
    )
    out = np.zeros((2, BUCKETS))
    where = summed["bucket"].to_numpy()
    out[0, where], out[1, where] = summed["raw"].to_numpy(), summed["target"].to_numpy()
    return out[0], out[1]


def cut_of_top(scored: DataFrame, k: int, few: int = 10_000) -> tuple[float, object] | None:
    """(key, doc_id) of the last of the k rows with the largest keys, ties by the least id.

    Counts in 1024 intervals narrow the range of the k-th key, until few rows are in it.
    """
    span = scored.agg(F.min("key"), F.max("key")).first()
    low, high = span[0], span[1]
    if low is None or k < 1:
        return None
    above = 0
    while True:
        width = (high - low) / 1024
        inside = scored.where((F.col("key") >= low) & (F.col("key") <= high))
        if not width or low + width == low or inside.limit(few + 1).count() <= few:
            break
        bin_of = F.least(F.floor((F.col("key") - low) / width), F.lit(1023))
        counts = {r["b"]: r["n"] for r in inside.groupBy(bin_of.alias("b")).agg(F.count("*").alias("n")).collect()}
        for b in range(1023, -1, -1):
            n = counts.get(b, 0)
            if above + n >= k:
                break
            above += n
        # A little wider than the interval, so that rounding loses no row; recount what is above.
        new_low, new_high = max(low, low + width * (b - 0.01)), min(high, low + width * (b + 1.01))
        if (new_low, new_high) == (low, high):
            break
        low, high = new_low, new_high
        above = scored.where(F.col("key") > high).count()
    rows = inside.select("key", "doc_id").orderBy(F.col("key").desc(), "doc_id").limit(k - above).collect()
    return (rows[-1]["key"], rows[-1]["doc_id"]) if rows else None


def resample(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    is_target,
    share: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
) -> DataFrame:
    """doc_id, log_ratio, gumbel_key, kept for each row.

    labels has rows with an id; is_target is a condition on them. kept marks the k rows with the
    largest keys, k being ``share`` of all rows (by default the share of targets among the labelled
    rows; all rows without labels). A null text counts as empty: its ratio is 0. Rows that repeat
    an id share their noise, and are kept alike where their texts are alike; a null id has noise
    as well. An empty table gives no rows; other columns are not read.
    """
    own = labels.select(
        F.col(f"`{label_id_col}`").alias("doc_id"), F.coalesce(is_target, F.lit(False)).alias("target")
    )
    targets = (
        own.where("target").select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_ROWS)
    )
    if share is None:
        tally = own.agg(F.count("*"), F.count_if("target")).first()
        share = tally[1] / tally[0] if tally[0] else 1.0
    source = id_and_text(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    marked = source.join(
        F.broadcast(targets.withColumn("target", F.lit(True))), "doc_id", "left"
    ).select("text", F.coalesce("target", F.lit(False)).alias("target"))
    ratio = spark.sparkContext.broadcast(ratios(*bucket_counts(marked)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch):
                codes, owner = features(texts)
                total = np.bincount(owner, ratio.value[codes], minlength=len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(rows.start, len(texts)), pa.array(total, pa.float64())],
                    names=["doc_id", "log_ratio"],
                )

    # The upper 53 bits of a hash as a number between 0 and 1, both excluded.
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("gumbel")), 11) + 0.5) / float(1 << 53)
    path = f"{work_folder(spark, 'importance')}/scored"
    map_in_arrow(source, run, f"doc_id {kind}, log_ratio double").withColumn(
        "key", F.col("log_ratio") - F.log(-F.log(uniform))
    ).write.parquet(path)
    scored = spark.read.parquet(path)
    cut = cut_of_top(scored, round(share * scored.count()))
    kept = F.lit(False)
    if cut is not None:
        key, last = cut
        tie = F.col("doc_id").isNull() if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(True))
        kept = (F.col("key") > key) | ((F.col("key") == key) & tie)
    return scored.select("doc_id", "log_ratio", F.col("key").alias("gumbel_key"), kept.alias("kept"))
