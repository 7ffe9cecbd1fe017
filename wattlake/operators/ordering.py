"""Row numbers of a total order without one task for all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.session import work_folder

# Rows of one partition are numbered in the lower bits of Spark's growing id.
_PLACE_BITS = 33


def numbered(rows: DataFrame, order: Sequence[Column | str], position: str = "position") -> DataFrame:
    """The rows with their place in the order, from 1, as ``row_number`` over all rows gives it.

    The rows are range-partitioned and sorted, and written with the number of their partition and
    their place in it, so that both hold for every later job and on every retry. Each partition's
    rows are counted, and the sum of those before it is its offset: a window over one row for each
    partition, however large the table. A window over the rows would sort all of them in one task.

    Rows that are equal in all of ``order`` get consecutive numbers in any order, and stay in one
    partition; end the order with a unique column. NULLs are placed as ``order`` says. An empty
    table gives no rows; a column named like the position is refused.
    """
    if position in rows.columns:
        raise ValueError(f"the table has a column {position!r}")
    part, place, offset = (_free_name(rows, name) for name in ("_partition", "_place", "_before"))
    path = f"{work_folder(rows.sparkSession, 'numbered')}/rows"
    rows.orderBy(*order).select(
        "*",
        F.spark_partition_id().alias(part),
        F.monotonically_increasing_id().bitwiseAND((1 << _PLACE_BITS) - 1).alias(place),
    ).write.parquet(path)
    written = rows.sparkSession.read.schema(
        rows.select("*", F.lit(0).alias(part), F.lit(0).cast("long").alias(place)).schema
    ).parquet(path)
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        written.groupBy(part)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(part, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(offset))
    )
    # One row for each shuffle partition is a proven small side.
    return written.join(F.broadcast(offsets), part).select(
        *(F.col(f"`{c}`") for c in rows.columns),
        (F.col(offset) + F.col(place) + 1).alias(position),
    )


def _free_name(rows: DataFrame, name: str) -> str:
    while name in rows.columns:
        name += "_"
    return name
