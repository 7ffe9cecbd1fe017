"""Quality rules: repetition within a text, and lines that recur across the documents of a host.

Each text is read once. Its figures and its distinct normalised lines (words in lower case) are
written as hashes; from then on Spark counts the documents of a host that hold a line, takes the
lines above the limits away, and rejects documents of which too little is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.arrow import id_and_text, map_in_arrow
from wattlake.llm.text import chunks, combine, mix, words_of
from wattlake.session import work_folder

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _before(flags: np.ndarray) -> np.ndarray:
    """Number of set flags before each position."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _repeats(keys: np.ndarray) -> np.ndarray:
    """For each key the number of earlier equal keys, cut at 1; and whether a later one exists."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros((2, len(keys)), bool)
    out[0, order[1:]] = same
    out[1, order[:-1]] = same
    return out


def figures(texts: list[bytes]) -> tuple[dict[str, np.ndarray], tuple[np.ndarray, ...]]:
    """The figures of each text, and its distinct lines: (text, hash, words) for each.

    Texts without words have zeros and no lines.
    """
    n = len(texts)
    words = words_of(texts, lower=False)
    counts = np.diff(words.first)
    owner = np.repeat(np.arange(n), counts)
    text = words.text_start
    code_points = _before((words.data & 0xC0) != 0x80)
    symbols = _before(_SYMBOL[words.data])
    out = {
        "n_words": counts,
        "word_chars": np.bincount(
            owner, code_points[words.end] - code_points[words.start], minlength=n
        ).astype(np.int64),
        "n_symbols": symbols[text[1:]] - symbols[text[:-1]],
    }

    # Lines that hold a word.
    newline = np.flatnonzero(words.data == 10)
    line_of_word = np.searchsorted(newline, words.start)
    opens = np.flatnonzero(np.diff(line_of_word, prepend=-1))
    line = line_of_word[opens]
    line_start = np.concatenate([[0], newline + 1])[line]
    line_owner = owner[opens]
    raw = combine(words.hashes_of(line_start, newline[line]), line_owner.astype(np.uint64))
    again = _repeats(raw)[0]
    out["n_dup_lines"] = np.bincount(line_owner[again], minlength=n)

    # Words in three-word windows that occur twice or more in the text.
    h = words.hashes
    repeat = np.zeros(len(h), bool)
    if len(h) > 2:
        inside = np.flatnonzero(owner[2:] == owner[:-2])
        keys = combine(h[inside], h[inside + 1], h[inside + 2], owner[inside].astype(np.uint64))
        often = inside[_repeats(keys).any(axis=0)]
        for k in range(3):
            repeat[often + k] = True
    out["n_repeat_words"] = np.bincount(owner[repeat], minlength=n)

    # Normalised lines: lower-case words in their order.
    lower = words_of(texts, lower=True).hashes
    place = np.arange(len(h)) - np.repeat(opens, np.diff(np.append(opens, len(h))))
    marked = mix(lower + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    line_hash = mix(np.add.reduceat(marked, opens)) if len(opens) else marked
    line_words = np.diff(np.append(opens, len(h)))
    _, where, inverse = np.unique(
        combine(line_hash, line_owner.astype(np.uint64)), return_index=True, return_inverse=True
    )
    total = np.bincount(inverse, line_words, minlength=len(where)).astype(np.int64)
    order = np.argsort(line_owner[where], kind="stable")
    where, total = where[order], total[order]
    return out, (line_owner[where], line_hash[where].view(np.int64), total)


def _measured(docs: DataFrame, host_col: str, id_col: str, text_col: str) -> DataFrame:
    source = id_and_text(docs, id_col, text_col, host_col).withColumnRenamed(host_col, "host")
    source = source.withColumn("host", F.coalesce(F.col("host").cast("string"), F.lit("")))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for rows, texts in chunks(batch):
                part = batch.slice(rows.start, len(texts))
                values, (owner, hashes, lengths) = figures(texts)
                cuts = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(texts)), pa.int64()),
                        part.column("doc_id"),
                        part.column("host").cast(pa.string()),
                        *(pa.array(values[name], pa.int64()) for name in _FIGURES),
                        pa.ListArray.from_arrays(cuts, pa.array(hashes, pa.int64())),
                        pa.ListArray.from_arrays(cuts, pa.array(lengths, pa.int64())),
                    ],
                    names=["row", "doc_id", "host", *_FIGURES, "line", "line_words"],
                )
                row += len(texts)

    return map_in_arrow(
        source,
        run,
        f"row long, doc_id {kind}, host string, {', '.join(f'{c} long' for c in _FIGURES)}, "
        "line array<long>, line_words array<long>",
    )


def judge(
    spark: SparkSession,
    docs: DataFrame,
    host_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    least_docs: int = 5,
    host_percent: int | None = None,
    least_left_percent: int = 30,
    least_words: int = 50,
    most_repeat_percent: int = 50,
) -> DataFrame:
    """The figures of each row with base_failed, removed_words and kept.

    base_failed: fewer than least_words words, or more than most_repeat_percent of the words in
    three-word windows that recur in the text. A line is common if least_docs texts of its host or
    more hold it, however large the host; texts of the same lines count once. Its words are removed
    but for one of these texts, that of the least id, so that of a group of near copies one is
    left whole. A document of which less than least_left_percent of the words or fewer than
    least_words are left is depleted. kept is false for a document that fails or is depleted.

    With host_percent a line is common if least_docs documents of its host or more hold it and
    these are more than that share of the host's documents; its words are removed from all.

    A null text has no words and fails. A null host is the host of the empty name. Repeated rows
    count as documents of their own; an empty table gives no rows; other columns are not read.
    """
    path = f"{work_folder(spark, 'line-quality')}/measured"
    _measured(docs, host_col, id_col, text_col).write.parquet(path)
    measured = spark.read.parquet(path)

    lines = measured.select(
        "row",
        "doc_id",
        "host",
        F.xxhash64(F.sort_array("line")).alias("lines_of"),
        F.explode(F.arrays_zip("line", "line_words")).alias("l"),
    ).select(
        "row", "doc_id", "host", "lines_of", F.col("l.line").alias("line"), F.col("l.line_words").alias("words")
    )
    held = _held_beyond(lines, least_docs, host_percent, measured)
    removed = held.groupBy("row").agg(F.sum("words").alias("removed_words"))
    failed = (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > most_repeat_percent * F.col("n_words")
    )
    left = F.col("n_words") - F.col("removed_words")
    return (
        measured.drop("line", "line_words", "host")
        .join(removed, "row", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
        .withColumn("base_failed", failed)
        .withColumn(
            "kept",
            ~failed & (100 * left >= least_left_percent * F.col("n_words")) & (left >= least_words),
        )
        .drop("row")
    )


def _held_beyond(
    lines: DataFrame, least_docs: int, host_percent: int | None, measured: DataFrame
) -> DataFrame:
    """Lines of documents whose words are removed: row, words."""
    if host_percent is None:
        # Counted in two steps, so that no task gets all documents of a line.
        common = (
            lines.groupBy("host", "line", "lines_of")
            .agg(F.min("doc_id").alias("least"))
            .groupBy("host", "line")
            .agg(F.count("*").alias("n_texts"), F.min(F.struct("least", "lines_of")).alias("first"))
            .where(F.col("n_texts") >= least_docs)
            .select("host", "line", F.col("first.lines_of").alias("stays"))
        )
        return lines.join(common, ["host", "line"]).where("lines_of <> stays").select("row", "words")
    hosts = measured.groupBy("host").agg(F.count("*").alias("host_docs"))
    common = (
        lines.groupBy("host", "line")
        .agg(F.count("*").alias("n_docs"))
        .where(F.col("n_docs") >= least_docs)
        .join(hosts, "host")
        .where(100 * F.col("n_docs") > host_percent * F.col("host_docs"))
        .select("host", "line")
    )
    return lines.join(common, ["host", "line"]).select("row", "words")
