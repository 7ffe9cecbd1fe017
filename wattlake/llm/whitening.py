"""Whitening of embeddings by the leading eigenvectors of their covariance.

Vectors become integer vectors x = floor(scale * c). The fit list holds each distinct x once; its
sums and centred second moments are added up in tasks as exact integers while they fit, so that
they do not depend on the order of rows or on a repeated task. What the driver gets is one
number for each pair of dimensions, however many rows there are.

The spectrum is sliced on that matrix V: the signs of D in P(V - s I)P' = LDL' count the
eigenvalues above s (Sylvester), bisection on the counts isolates each leading eigenvalue, Rayleigh
quotient iteration then converges cubically to it, and two more counts beside the result certify
its number. Eigenvalues that no shift parts in double precision form a cluster, which gets an
orthonormal basis by subspace iteration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.arrow import map_in_arrow
from wattlake.session import work_folder

EPS = np.finfo(float).eps
#: Entries of vectors that are worked on at once in a task.
BLOCK_ENTRIES = 1 << 18
_WIDTHS = (1, 2, 4, 8)


# The spectrum of a symmetric matrix


def inertia(a: np.ndarray) -> tuple[int, int]:
    """Numbers of positive and of negative eigenvalues, from a pivoted LDL' with 1x1 and 2x2 blocks."""
    a = np.array(a, float)
    a /= np.abs(a).max(initial=0) or 1.0
    n, k, positive, negative = len(a), 0, 0, 0
    bound = (1 + np.sqrt(17)) / 8
    while k < n:
        below = np.abs(a[k + 1 :, k])
        r = k + 1 + int(np.argmax(below)) if len(below) else k
        largest = below[r - k - 1] if len(below) else 0.0
        size, swap = 1, k
        # Of a matrix scaled to 1, what lies so far below rounding is zero.
        if largest > 1e-100 and abs(a[k, k]) < bound * largest:
            column = np.abs(a[k:, r])
            column[r - k] = 0
            across = column.max()
            if abs(a[k, k]) * across >= bound * largest * largest:
                pass
            elif abs(a[r, r]) >= bound * across:
                swap = r
            else:
                size, swap = 2, r
        to = k + size - 1
        if swap != to:
            a[[to, swap]] = a[[swap, to]]
            a[:, [to, swap]] = a[:, [swap, to]]
        block, rest = a[k : k + size, k : k + size], a[k + size :, k : k + size]
        if size == 1:
            pivot = block[0, 0]
            positive += pivot > 0
            negative += pivot < 0
            if pivot:
                a[k + 1 :, k + 1 :] -= np.outer(rest[:, 0], rest[:, 0] / pivot)
        else:
            # Chosen so that its determinant is negative: one eigenvalue on each side.
            positive += 1
            negative += 1
            # Over the entry beside the diagonal, which is the largest of its column.
            aside = block[1, 0]
            p, q = block[0, 0] / aside, block[1, 1] / aside
            inverse = np.array([[q, -1.0], [-1.0, p]]) / ((p * q - 1.0) * aside)
            a[k + 2 :, k + 2 :] -= rest @ inverse @ rest.T
        k += size
    return int(positive), int(negative)


def _above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of v are larger than the shift."""
    return inertia(v - shift * np.eye(len(v)))[0]


def _solve(v: np.ndarray, shift: float, right: np.ndarray, norm: float) -> np.ndarray:
    """(v - shift I)^-1 right, the shift moved by rounding's size where the matrix is singular."""
    for step in (0.0, 1.0, -2.0, 5.0, -11.0):
        try:
            out = np.linalg.solve(v - (shift + step * EPS * norm) * np.eye(len(v)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(out).all():
            return out
    return right


def _refine(v: np.ndarray, low: float, high: float, done: np.ndarray, norm: float):
    """Rayleigh quotient iteration from the middle of an interval; None if it leaves the interval."""
    x = np.random.Generator(np.random.PCG64(len(v))).standard_normal(len(v))
    shift, best = (low + high) / 2, None
    for step in range(12):
        x = x - done @ (done.T @ x)
        if not np.linalg.norm(x):
            return None
        x = _solve(v, shift, x / np.linalg.norm(x), norm)
        x /= np.abs(x).max()
        x = x - done @ (done.T @ x)
        x /= np.linalg.norm(x) or 1.0
        value = float(x @ v @ x)
        # Two inverse iterations point x into the interval before the shift follows it.
        if step < 1:
            continue
        if not low <= value <= high:
            return None
        error = float(np.linalg.norm(v @ x - value * x))
        if best is not None and error >= best[0]:
            break
        best, shift = (error, value, x), value
    error, value, x = best
    return (value, x) if error <= 64 * EPS * norm * np.sqrt(len(v)) else None


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit eigenvectors as columns.

    The sign of a vector is set so that its entry of largest size is positive.
    """
    n = len(v)
    k = min(k, n)
    values, vectors = np.zeros(k), np.zeros((n, k))
    norm = float(np.abs(v).sum(axis=1).max()) if n else 0.0
    if not norm:
        return values, np.eye(n)[:, :k]
    # Shifts closer than margin cannot be told apart; slack is the error that a value may have.
    margin, slack = 8 * n * EPS * norm, 80 * n * EPS * norm
    at = 0
    while at < k:
        # More than at eigenvalues are above low, at most at are above high.
        low, high = -norm - margin, norm + margin
        over_low, over_high = n, 0
        found = None
        while found is None and high - low > margin:
            middle = (low + high) / 2
            count = _above(v, middle)
            if count > at:
                low, over_low = middle, count
            else:
                high, over_high = middle, count
            if over_low == at + 1 and over_high == at:
                found = _refine(v, low, high, vectors[:, :at], norm)
                # The counts on both sides of it have to confirm its number; else the interval
                # goes on shrinking, down to a cluster.
                if found and not (_above(v, found[0] - slack) > at >= _above(v, found[0] + slack)):
                    found = None
        if found is not None:
            values[at], vectors[:, at] = found
            at += 1
            continue
        # A cluster: all its eigenvalues lie within rounding of one shift.
        size = max(over_low - at, 1)
        rng = np.random.Generator(np.random.PCG64(n))
        basis, shift = rng.standard_normal((n, size)), (low + high) / 2
        for _ in range(6):
            basis -= vectors[:, :at] @ (vectors[:, :at].T @ basis)
            basis = np.linalg.qr(_solve(v, shift, basis, norm))[0]
        basis -= vectors[:, :at] @ (vectors[:, :at].T @ basis)
        basis = np.linalg.qr(basis)[0]
        for column in basis.T[: k - at]:
            values[at], vectors[:, at] = float(column @ v @ column), column
            at += 1
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    tops = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[tops, np.arange(k)] < 0, -1.0, 1.0)


# Vectors in Arrow batches


def _integers(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, integer vectors) of the usable rows, by length of the vector."""
    column = batch.column("vector")
    sizes = np.where(
        column.is_null().to_numpy(zero_copy_only=False),
        -1,
        np.diff(column.offsets.to_numpy(zero_copy_only=False)),
    )
    offsets = column.offsets.to_numpy(zero_copy_only=False)
    # Null entries become NaN.
    entries = column.values.to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(entries * scale)
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        step = max(1, BLOCK_ENTRIES // int(size))
        for begin in range(0, len(rows), step):
            part = rows[begin : begin + step]
            block = scaled[offsets[part][:, None] + np.arange(size)]
            good = (np.abs(block) < 2.0**63).all(axis=1)
            if good.any():
                yield int(size), part[good], block[good].astype(np.int64)


def _packed(vectors: np.ndarray) -> Iterator[pa.Array]:
    """Vectors as bytes, each in the narrowest integer that holds all its entries."""
    top = np.maximum(vectors.max(axis=1), ~vectors.min(axis=1))
    width = np.searchsorted([1 << 7, 1 << 15, 1 << 31], top, side="right")
    for w in np.unique(width):
        own = np.ascontiguousarray(vectors[width == w].astype(f"<i{_WIDTHS[w]}"))
        cuts = np.arange(len(own) + 1, dtype=np.int32) * (own.shape[1] * _WIDTHS[w])
        yield pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(cuts), pa.py_buffer(own)])


def _unpacked(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """Blocks of the integer vectors that _packed made, all of one length."""
    column = batch.column("x").cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    width = np.diff(offsets) // size
    step = max(1, BLOCK_ENTRIES // size)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        for begin in range(0, len(rows), step):
            part = offsets[rows[begin : begin + step]].astype(np.int64)
            raw = data[part[:, None] + np.arange(size * w)]
            yield np.ascontiguousarray(raw).view(f"<i{w}").astype(np.int64)


# The fit


@dataclass
class Fit:
    """n distinct vectors, their sums, the largest spread of an entry, and the leading components."""

    n: int
    sums: list[int]
    spread: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows of x on the components over the root of their variance; NaN without variance."""
        mean = np.array([s / self.n for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.values > 0, 1 / np.sqrt(np.maximum(self.values, 0)), np.nan)
        return ((x - mean) @ self.vectors) * scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sum over dimensions of (n x - sum)^2; None beyond a long."""
        bound = self.n * self.spread
        if bound * bound * len(self.sums) < 2**63:
            away = self.n * x - np.array(self.sums, np.int64)
            return (away * away).sum(axis=1).tolist()
        away = self.n * x.astype(object) - np.array(self.sums, object)
        return [d if d < 2**63 else None for d in (away * away).sum(axis=1).tolist()]


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int], int]:
    """Rows, sums and the largest spread of a dimension, as exact integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, object)
        low = high = None
        for batch in batches:
            for x in _unpacked(batch, size):
                n += len(x)
                least, most = x.min(axis=0), x.max(axis=0)
                fits = max(-int(least.min()), int(most.max()), 1) * len(x) < 2**63
                total = total + (x.sum(axis=0) if fits else x.astype(object).sum(axis=0)).astype(object)
                low = least if low is None else np.minimum(low, least)
                high = most if high is None else np.maximum(high, most)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(size), pa.int32()),
                    pa.array([n] * size, pa.int64()),
                    pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
                    pa.array(low, pa.int64()),
                    pa.array(high, pa.int64()),
                ],
                names=["i", "n", "total", "low", "high"],
            )

    rows = (
        map_in_arrow(fit.select("x"), run, "i int, n long, total decimal(38,0), low long, high long")
        .groupBy("i")
        .agg(F.sum("n"), F.sum("total"), F.min("low"), F.max("high"))
        .orderBy("i")
        .collect()
    )
    return rows[0][1], [int(r[2]) for r in rows], max(r[4] - r[3] for r in rows)


def _covariance(fit: DataFrame, n: int, sums: list[int], spread: int) -> np.ndarray:
    """Second moments about the mean over n.

    Vectors are centred on the integer nearest to the mean before they are multiplied; the rest
    of the shift, below one half, is taken off at the end, in integers where they were exact.
    """
    size = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    exact = n * (spread + 1) ** 2 < 2**63
    # Products of integers are exact in double precision as long as their sum stays below 2**53.
    step = max(1, min(BLOCK_ENTRIES // size, 2**53 // (spread + 1) ** 2))
    kind = np.int64 if exact else np.float64
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), kind)
        shift = np.array(centre, object)
        for batch in batches:
            for x in _unpacked(batch, size):
                # Beyond 2**62 a difference could leave the range of int64.
                y = (x - shift.astype(np.int64)) if spread < 2**62 else (x.astype(object) - shift)
                y = y.astype(float)
                for begin in range(0, len(y), step):
                    part = y[begin : begin + step]
                    total += (part.T @ part).astype(kind)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(upper[0], pa.int32()),
                pa.array(upper[1], pa.int32()),
                pa.array(total[upper]),
            ],
            names=["i", "j", "product"],
        )

    summed = (
        map_in_arrow(fit.select("x"), run, f"i int, j int, product {'long' if exact else 'double'}")
        .groupBy("i", "j")
        .agg(F.sum("product").alias("product"))
        .toArrow()
    )
    out = np.zeros((size, size))
    rest = [s - n * c for s, c in zip(sums, centre)]
    for i, j, product in zip(*(summed[c].to_pylist() for c in ("i", "j", "product"))):
        if exact:
            value = (n * product - rest[i] * rest[j]) / (n * n)
        else:
            value = product / n - (rest[i] / n) * (rest[j] / n)
        out[i, j] = out[j, i] = value
    return out


def _identity_error(fit: DataFrame, found: Fit) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity, over its rows."""
    own = np.flatnonzero(found.values > 0)
    if not len(own):
        return None
    size, k = len(found.sums), len(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whitened rows are centred; what rounding leaves of the mean is row k.
        total = np.zeros((k + 1, k))
        for batch in batches:
            for x in _unpacked(batch, size):
                z = found.whiten(x)[:, own]
                total[:k] += z.T @ z
                total[k] += z.sum(axis=0)
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())],
            names=["i", "j", "total"],
        )

    total = np.zeros((k + 1, k))
    for r in map_in_arrow(fit.select("x"), run, "i int, j int, total double").groupBy("i", "j").agg(
        F.sum("total").alias("total")
    ).collect():
        total[r["i"], r["j"]] = r["total"]
    mean = total[k] / found.n
    return float(np.abs(total[:k] / found.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    spark: SparkSession,
    table: DataFrame,
    components: int = 4,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """A row for each usable vector and component: id, component (from 1), n, deviation, whitened,
    explained, identity_error.

    A row is usable if its vector is not null, holds no null, infinite or NaN entry, none whose
    scaled value leaves the range of a long, and has the length that most distinct vectors have
    (the longer of two lengths as frequent); an empty vector is not usable. Other rows give
    nothing, a table without usable rows gives no rows. n is the number of distinct vectors,
    deviation the exact sum of (n x - sum)^2 over dimensions (null beyond a long), whitened the
    centred vector on the component over the root of its variance (null without variance),
    explained the share of the variance (null if there is none), identity_error the largest error
    of the whitened covariance over components with variance. Fewer dimensions give fewer
    components. Repeated rows and ids are kept, null ids too; other columns are not read.
    """
    source = table.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    )
    kind = source.schema["id"].dataType.simpleString()
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = (
        f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, _, x in _integers(batch, scale):
                for packed in _packed(x):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(packed), size), pa.int32()), packed], names=["size", "x"]
                    )

    path = f"{work_folder(spark, 'whitening')}/fit"
    map_in_arrow(source.select("vector"), integers, "size int, x binary").distinct().write.parquet(path)
    every = spark.read.parquet(path)
    common = every.groupBy("size").count().orderBy(F.col("count").desc(), F.col("size").desc()).first()
    if common is None:
        return spark.createDataFrame([], schema)
    size = common["size"]
    fit = every.where(F.col("size") == size)
    n, sums, spread = _sums(fit, size)
    v = _covariance(fit, n, sums, spread)
    values, vectors = leading(v, components)
    trace = float(np.trace(v))
    # What is within rounding of zero is no variance.
    values = np.where(values > 64 * EPS * trace, values, 0.0)
    found = Fit(n, sums, spread, values, vectors, trace)
    error = _identity_error(fit, found)
    k = len(values)
    share = [float(e) / trace if trace else None for e in values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, rows, x in _integers(batch, scale):
                if own != size:
                    continue
                z, m = found.whiten(x), len(rows)
                where = pa.array(np.repeat(rows, k))
                deviation = pa.array(found.deviations(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(where),
                        pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        pa.array(np.full(m * k, n), pa.int64()),
                        deviation.take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(z.ravel(), mask=np.isnan(z.ravel())),
                        pa.array(share * m, pa.float64()),
                        pa.array([error] * (m * k), pa.float64()),
                    ],
                    names=names,
                )

    return map_in_arrow(source, project, schema)
