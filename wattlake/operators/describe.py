"""Summary statistics with exact percentiles that never gather or sort a column.

A sketch gives an interval around each rank. From then on each round counts the rows below the
interval and in equal parts of it, with the least and the largest value of each part; prefix sums
over these counts, some thousand numbers, say which part holds the rank, and its least and largest
value are the next interval. The rank is found when they are equal. A rank outside of its interval
widens it to the whole column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
SKETCH_ACCURACY = 10_000
#: Equal parts of an interval that a round counts.
PARTS = 1024
#: A round that leaves more than this share of an interval's rows makes the next one sketch again.
SLOW = 0.25
_LARGEST = 1.7976931348623157e308


def first_pass(
    rows: DataFrame, columns: Sequence[str], probabilities: dict[str, float],
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Moments of every column and a narrow range around each percentile, in one scan.

    A mergeable sketch per column misses a rank by at most count/accuracy, so a range that
    reaches two such steps to both sides holds the rank. A column with no more values than
    the sketch has steps is taken whole.
    """
    margin = 2.0 / accuracy
    low = [max(0.0, p - margin) for p in probabilities.values()]
    high = [min(1.0, p + margin) for p in probabilities.values()]

    def statistics(name: str) -> Column:
        x = _value(name)
        sketch = F.percentile_approx(x, F.array(*(F.lit(p) for p in low + high)), F.lit(accuracy))
        return F.struct(
            F.lit(name).alias("column"),
            F.count(x).alias("count"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            sketch.alias("sketch"),
        )

    whole = F.col("count") <= accuracy
    ends = []
    for i, (name, p) in enumerate(probabilities.items()):
        lo = F.col("min") if p <= margin else F.get("sketch", F.lit(i))
        hi = F.col("max") if p >= 1 - margin else F.get("sketch", F.lit(len(low) + i))
        ends += [
            F.when(whole, F.col("min")).otherwise(lo).alias(f"lo_{name}"),
            F.when(whole, F.col("max")).otherwise(hi).alias(f"hi_{name}"),
        ]
    return (
        rows.agg(F.array(*(statistics(c) for c in columns)).alias("all"))
        .select(F.inline("all"))
        .select("*", *ends)
        .drop("sketch")
    )


def _value(name: str) -> Column:
    """A column as double; NaN is a missing value."""
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x), x)


@dataclass
class _Search:
    """The search for the values of two neighbouring ranks of a column."""

    column: str
    name: str
    count: int
    position: float
    whole: tuple[float, float]
    low: float
    high: float
    inside: float = math.inf
    found: tuple[float, float] | None = None
    is_slow: bool = False

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.position), math.ceil(self.position)

    def value(self) -> float:
        low, high = self.found
        # Equal ends need no arithmetic, which infinite ones would not stand.
        return low if low == high else low + (high - low) * (self.position - self.ranks[0])

    def advance(self, below: int, parts: list[tuple[int, float, float]]) -> None:
        """Take the part that holds the ranks; parts are (rows, least, largest value), in order."""
        first, last = self.ranks
        inside = sum(rows for rows, _, _ in parts)
        if not below <= first or not last < below + inside:
            self.low, self.high = self.whole
            self.inside = math.inf
            return
        ends, seen = [], below
        for rank in (first, last):
            for rows, least, largest in parts:
                if rank < seen + rows:
                    ends.append((rows, least, largest))
                    break
                seen += rows
            else:  # cannot be: the ranks are inside
                raise ArithmeticError("a rank was lost")
            seen = below
        if ends[0] == ends[1] and ends[0][1] < ends[0][2]:
            rows, self.low, self.high = ends[0]
            self.is_slow, self.inside = rows > SLOW * inside, rows
        elif ends[0] == ends[1]:
            self.found = (ends[0][1], ends[0][1])
        else:
            # The last value of one part and the first of the next.
            self.found = (ends[0][2], ends[1][1])


def _part_of(value: Column, low: Column, high: Column) -> Column:
    """-1 below the interval, PARTS above, else the part from 0 on; monotone in the value."""
    finite_low, finite_high = F.greatest(low, F.lit(-_LARGEST)), F.least(high, F.lit(_LARGEST))
    # Halves, so that the width of the whole range of doubles does not overflow.
    width = finite_high / 2 - finite_low / 2
    share = F.when(width > 0, (value / 2 - finite_low / 2) / width).otherwise(F.lit(0.0))
    part = F.floor(F.greatest(F.lit(0.0), F.least(share * PARTS, F.lit(PARTS - 1.0)))).cast("int")
    # The ends are parts of their own where rounding would join them.
    part = F.when(value == high, PARTS - 1).when(value == low, 0).otherwise(part)
    return F.when(value < low, -1).when(value > high, PARTS).otherwise(part)


def _count_parts(rows: DataFrame, searches: list[_Search]) -> None:
    """One round of all searches: a scan, an aggregate of at most some thousand rows a column."""
    columns = sorted({s.column for s in searches})
    of = {c: [s for s in searches if s.column == c] for c in columns}
    most = max(map(len, of.values()))
    # A found or missing search stands still on an empty interval.
    pad = [(math.inf, -math.inf)] * most
    bounds = [
        (c, *(x for pair in ([(s.low, s.high) for s in of[c] if s.found is None] + pad)[:most] for x in pair))
        for c in columns
    ]
    names = [f"{end}{i}" for i in range(most) for end in ("low", "high")]
    schema = "column string, " + ", ".join(f"{n} double" for n in names)
    limits = rows.sparkSession.createDataFrame(bounds, schema)
    value = F.col("value")
    grouped = (
        rows.select(*(_value(c).alias(c) for c in columns))
        .unpivot([], columns, "column", "value")
        .where(value.isNotNull())
        .join(F.broadcast(limits), "column")
        .select("column", "value", *(_part_of(value, F.col(f"low{i}"), F.col(f"high{i}")).alias(f"part{i}") for i in range(most)))
        .groupBy("column", *(f"part{i}" for i in range(most)))
        .agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("least"), F.max("value").alias("largest"))
        .collect()
    )
    for c in columns:
        for i, search in enumerate(s for s in of[c] if s.found is None):
            below, parts = 0, {}
            for r in (r for r in grouped if r["column"] == c):
                if r[f"part{i}"] < 0:
                    below += r["rows"]
                elif r[f"part{i}"] < PARTS:
                    n, least, largest = parts.get(r[f"part{i}"], (0, math.inf, -math.inf))
                    parts[r[f"part{i}"]] = (n + r["rows"], min(least, r["least"]), max(largest, r["largest"]))
            search.advance(below, [parts[k] for k in sorted(parts)])


def _sketch_again(rows: DataFrame, slow: list[_Search], accuracy: int) -> None:
    """Narrow the intervals in which equal parts do not part the rows, by ranks in a sketch.

    As many numbers a search as it takes to have both ranks between them; the next count checks it.
    """
    shares = [i / 64 for i in range(65)]
    x = {s.column: _value(s.column) for s in slow}
    figures = [
        F.struct(
            F.percentile_approx(
                F.when(x[s.column].between(s.low, s.high), x[s.column]), F.array(*map(F.lit, shares)), F.lit(accuracy)
            ).alias("cuts"),
            F.count_if(x[s.column] < s.low).alias("below"),
            F.count_if(x[s.column].between(s.low, s.high)).alias("inside"),
        ).alias(f"s{i}")
        for i, s in enumerate(slow)
    ]
    answer = rows.agg(*figures).first()
    for s, (cuts, below, inside) in zip(slow, answer):
        place = (s.position - below) / inside
        under = [c for share, c in zip(shares, cuts) if share < place - 2 / accuracy]
        over = [c for share, c in zip(shares, cuts) if share > place + 2 / accuracy]
        s.low, s.high = max([s.low, *under]), min([s.high, *over])
        s.is_slow = False


def exact_percentiles(
    rows: DataFrame, columns: Sequence[str], ranges: DataFrame, probabilities: dict[str, float],
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Exact percentiles (column, name, value), interpolated linearly between ranks.

    Runs now: each round scans the columns once and brings the counts of parts to the driver, at
    most PARTS for each percentile and column, whatever the number of rows. Nulls and NaN do not
    count; a column without values has NULL.
    """
    searches = [
        _Search(r["column"], name, r["count"], p * (r["count"] - 1), (r["min"], r["max"]), r[f"lo_{name}"], r[f"hi_{name}"])
        for r in ranges.collect()
        for name, p in probabilities.items()
        if r["column"] in columns and r["count"]
    ]
    while open_ones := [s for s in searches if s.found is None]:
        if slow := [s for s in open_ones if s.is_slow]:
            _sketch_again(rows, slow, accuracy)
        _count_parts(rows, open_ones)
    values = {(s.column, s.name): s.value() for s in searches}
    return rows.sparkSession.createDataFrame(
        [(c, n, values.get((c, n))) for c in columns for n in probabilities],
        "column string, name string, value double",
    )


def describe(
    rows: DataFrame, columns: Sequence[str], accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max of each column, one row for each.

    The rows are scanned once for the moments and once for each round of the percentiles (two or
    three, as a rule), now: give a stored table rather than a long plan.
    """
    figures = first_pass(rows, columns, QUARTILES, accuracy)
    # One row a column: the scan behind it runs once.
    moments = rows.sparkSession.createDataFrame(figures.collect(), figures.schema)
    quartiles = (
        exact_percentiles(rows, columns, moments, QUARTILES, accuracy)
        .groupBy("column")
        .pivot("name", list(QUARTILES))
        .agg(F.first("value"))
    )
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", *QUARTILES, "max"
    )
