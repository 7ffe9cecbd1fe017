"""Per-row work on texts in Arrow batches; Spark partitions, retries and writes it."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.session import bound_arrow_batches


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """The columns that an operator reads, so that the scan reads no others."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        *(F.col(f"`{c}`").alias(c) for c in more),
    )


#: What a Python worker keeps from task to task, by name, as functions that give it up.
KEPT: dict[str, Callable[[], None]] = {}


def release() -> None:
    """Hand memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_in_arrow(
    table: DataFrame,
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    keeps: str = "",
) -> DataFrame:
    """mapInArrow for workers that live on: a task first drops what other operators keep in its
    worker, all but ``keeps``, and hands its free memory back at the end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, forget in KEPT.items():
            if name != keeps:
                forget()
        try:
            yield from run(batches)
        finally:
            release()

    bound_arrow_batches(table.sparkSession)
    return table.mapInArrow(task, schema)


def map_batches(
    docs: DataFrame, each: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply a function to each Arrow batch; batches without rows are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from each(batch)

    return map_in_arrow(docs, run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of at most that many rows."""
    for begin in range(0, batch.num_rows, size):
        yield batch.slice(begin, size)
