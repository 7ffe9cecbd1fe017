"""Joins that stay whole and balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side with at most this many rows of a fact-like width stays far below the 8 GB limit
# of a broadcast and fits beside the other memory of an executor.
BROADCAST_ROWS = 200_000
# Rows of a key from which on it is hot, and the number of keys that can be: a key is only hot
# with more than a 65,536th of all rows, so there are fewer of these, however large the table.
PART_ROWS = 1_000_000
HOT_KEYS = 65_536


def bounded_rows(table: DataFrame, limit: int = BROADCAST_ROWS) -> int | None:
    """Number of rows if it is at most ``limit``, else None; reads no more than that."""
    rows = table.limit(limit + 1).count()
    return rows if rows <= limit else None


def small_side(table: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast only for a table whose number of rows is known or checked."""
    size = bounded_rows(table) if rows is None else rows
    return F.broadcast(table) if size is not None and size <= BROADCAST_ROWS else table


def join_time(pivoted: DataFrame, dim_time: DataFrame, rows: int | None = None) -> DataFrame:
    """Inner join with the calendar on the period's date."""
    days = dim_time.select("time_key", F.col("date").alias("period_date"))
    return pivoted.join(small_side(days, rows), "period_date")


def join_location(pivoted: DataFrame, dim_location: DataFrame, rows: int | None = None) -> DataFrame:
    """Inner join with the location dimension; codes it does not have are dropped."""
    codes = dim_location.select("location_key", F.col("location_code").alias("location"))
    return pivoted.join(small_side(codes, rows), "location")


def left_join_aggregates(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two sides that are both grouped by the keys: one row at most to match,
    both sides already partitioned by the keys."""
    return left.join(right, list(keys), "left")


def _with_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a NULL in a key, asked for as joins ask, so that Spark sees equal scans."""
    return table.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))


def hot_keys(
    table: DataFrame, keys: Sequence[str], part_rows: int = PART_ROWS, most: int = HOT_KEYS
) -> tuple[DataFrame, DataFrame]:
    """The number of parts of each key, and the keys of more than one part: keys, ``_parts``.

    Rows of a key are counted with a partial sum in every task. A part is part_rows rows, or the
    ``most``-th part of the table where that is more; so fewer than ``most`` keys have several.
    Keys with a NULL are left out, since they match nothing.
    """
    counts = _with_keys(table, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    share = counts.agg((F.sum("_n") / F.lit(most)).alias("share")).scalar()
    rows = F.greatest(F.lit(float(part_rows)), F.coalesce(share, F.lit(0.0)))
    parts = counts.select(*keys, F.ceil(F.col("_n") / rows).cast("long").alias("_parts"))
    return parts, parts.where("_parts > 1")


def spread_rows(
    table: DataFrame, keys: Sequence[str], hot: DataFrame, unlike: Sequence[str] = ()
) -> DataFrame:
    """The table with ``_part``: 0, and for a hot key the number of one of its parts.

    The number comes from the values of the whole row and not from its place, so a repeated
    task gives the same. ``unlike`` names columns that are not hashed (maps and variants cannot be).
    """
    values = [F.col(f"`{c}`") for c in table.columns if c not in unlike]
    found = table.join(F.broadcast(hot), list(keys), "left")
    # The hash is taken of hot rows only; the coalesce tells Spark that no part is NULL.
    part = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*values), F.col("_parts")))
    return found.withColumn("_part", F.coalesce(part, F.lit(0).cast("long"))).drop("_parts")


def left_join_fanout(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    left_rows: int | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Left join whose right side may have very many rows for a key.

    AQE cannot split a skewed right side of a left join, so it is done in one of two exact
    ways. Where the left side has a known small bound (``left_rows``) it goes to the right
    side's tasks, which then need no shuffle at all; left rows without any match are added.
    Otherwise the rows of each key are counted. A hot key's rows are spread over as many parts as
    it has times ``part_rows``, by a hash of the whole row with ``spread_by`` among its columns; its
    left rows go to each part. All other keys have one part and join as usual. Rows of a hot key
    that are equal in every column share a part.
    """
    if part_rows < 1:
        raise ValueError("part_rows must be positive")
    keys = list(keys)
    fields = [c for c in right.columns if c not in (*keys, spread_by)]
    if left_rows is not None and left_rows <= BROADCAST_ROWS:
        matched = right.drop(spread_by).join(F.broadcast(left), keys)
        present = right.select(*keys).distinct()
        missing = left.join(present, keys, "left_anti")
        nulls = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in fields]
        columns = [*left.columns, *fields]
        return matched.select(*columns).unionByName(missing.select(*left.columns, *nulls))

    parts, hot = hot_keys(right, keys, part_rows)
    spread = spread_rows(_with_keys(right, keys), keys, hot).drop(spread_by)
    spread = spread.withColumn("_hit", F.lit(True))
    everywhere = left.join(parts, keys, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1))
    )
    # Hash the left side, a few rows for each key and part: the right side needs no sort. A part
    # may be empty; only a key without any row leaves its left rows unmatched.
    joined = everywhere.hint("shuffle_hash").join(spread, [*keys, "_part"], "left")
    return joined.where("_hit OR _parts IS NULL").select(*left.columns, *fields)


def latest_by(table: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The one newest row for each key, by ``order`` descending.

    A maximum combines inside every task before the shuffle; a ranking window would bring
    all rows of a key into one task.
    """
    rest = [c for c in table.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return table.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*").select(
        *table.columns
    )
