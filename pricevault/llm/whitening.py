"""Whitening of embeddings with an exact covariance from bit planes.

Entries become integers. Each block of rows is shifted, dimension by dimension, to start at zero,
and the bits of one value of all rows are packed into 64-bit words: one word row for each dimension and
bit. The sum of products of two dimensions is then a sum over pairs of planes of
2^(a+b) times the number of rows in which both bits are set, an AND and a popcount over words. Blocks
undo their shift in integers, Spark adds the blocks, and the driver centres the integer sums
before anything is rounded: only d * d numbers are left by then.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPONENTS = 32
#: Fixed point of the entries: floor(64 * c) + 1000000.
SCALE, SHIFT = 64.0, 1_000_000
#: Entries beyond it would not fit a long; a longer vector would not fit the driver's eigenproblem.
LARGEST, MOST_DIMS = 2.0**55, 4096
#: Rows of a block of bit planes, and words of planes that are ANDed at a time.
BLOCK_ROWS, STEP_WORDS = 1 << 13, 1 << 18

SUMS = "i int, j int, total decimal(38,0)"


def usable(vectors: pa.Array) -> np.ndarray:
    """Marks of the rows whose vector is there and holds finite numbers only."""
    good = vectors.is_valid().to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    owner = np.repeat(np.arange(len(vectors)), pa.compute.list_value_length(vectors).fill_null(0).to_numpy())
    bad = ~np.isfinite(flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
    good[owner[bad]] = False
    return good


def fixed_point(vectors: pa.Array, dims: int) -> np.ndarray:
    """floor(64 * c) of usable vectors, as a (rows, dims) table of longs; shorter vectors end in zeros."""
    sizes = pa.compute.list_value_length(vectors).to_numpy()
    flat = np.floor(vectors.flatten().cast(pa.float64()).to_numpy() * SCALE)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError("an entry times 64 is beyond the range of the fixed-point form")
    flat = flat.astype(np.int64)
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def bit_planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, dimension and weight (power of two) of the planes of non-negative columns."""
    rows, dims = values.shape
    words, owner, power = [], [], []
    most = values.max(axis=0)
    for bit in range(int(most.max()).bit_length()):
        used = np.flatnonzero(most >> bit)
        bits = np.zeros((len(used), -(-rows // 64) * 64), np.uint8)
        bits[:, :rows] = ((values[:, used] >> bit) & 1).T
        words.append(np.packbits(bits, axis=1, bitorder="little").view("<u8"))
        owner.append(used)
        power.append(np.full(len(used), bit))
    if not words:
        return np.zeros((0, -(-rows // 64)), "<u8"), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(words), np.concatenate(owner), np.concatenate(power)


def cross_products(values: np.ndarray) -> list[list[int]]:
    """Exact sums of products of each two columns of non-negative integers, by AND and popcount."""
    dims = values.shape[1]
    planes, owner, power = bit_planes(values)
    total = np.zeros((dims, dims), object)
    step = max(1, STEP_WORDS // max(1, planes.shape[1]))
    for p in range(len(planes)):
        for q in range(p, len(planes), step):
            common = np.bitwise_count(planes[p] & planes[q : q + step]).sum(axis=1, dtype=np.int64)
            for weight in np.unique(power[q : q + step]):
                mine = power[q : q + step] == weight
                where = owner[q : q + step][mine]  # one plane of a dimension for each weight
                found = common[mine].astype(object) << int(power[p] + weight)
                total[owner[p], where] += found
                if q <= p < q + step and weight == power[p]:
                    found = found.copy()
                    found[where == owner[p]] = 0  # the plane with itself counts once
                total[where, owner[p]] += found
    return total.tolist()


def _sums(dims: int):
    """Task code: (i, j) -> sum of z_i * z_j; (-1, j) -> sum of z_j; (-1, -1) -> rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], int] = {}

        def add(i: int, j: int, value: int) -> None:
            totals[i, j] = totals.get((i, j), 0) + value

        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                z = fixed_point(batch.column(0).slice(first, BLOCK_ROWS), dims)
                low = z.min(axis=0)
                y = z - low
                products = cross_products(y)
                sums, low, rows = [int(x) for x in y.sum(axis=0)], low.tolist(), len(z)
                add(-1, -1, rows)
                for i in range(dims):
                    add(-1, i, sums[i] + rows * low[i])
                    for j in range(i, dims):
                        add(i, j, products[i][j] + low[i] * sums[j] + low[j] * sums[i] + rows * low[i] * low[j])
        if totals:
            keys, values = zip(*totals.items(), strict=True)
            i, j = zip(*keys, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(map(str, values)).cast(pa.decimal128(38, 0))], ["i", "j", "total"]
            )

    return run


@dataclass(frozen=True)
class Whitener:
    """A fit: rows, sums of floor(64c), projection (dims, components), explained shares."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    explained: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.sums)

    def project(self, z: np.ndarray) -> np.ndarray:
        return (z - self.sums / self.n) @ self.axes

    def deviation(self, z: np.ndarray) -> list[int]:
        """Sum over dimensions of (n*z - sums)^2, exact."""
        most = max(int(z.max(initial=0)) * self.n, -int(z.min(initial=0)) * self.n)
        if (most + int(np.abs(self.sums).max(initial=0))) ** 2 * self.dims < 1 << 62:
            return ((self.n * z - self.sums) ** 2).sum(axis=1).tolist()
        wide = self.n * z.astype(object) - self.sums.astype(object)
        return (wide * wide).sum(axis=1).tolist()


def centred(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance (divisor n): n * products - sums * sums in integers, one rounding each."""
    dims = len(sums)
    out = np.zeros((dims, dims))
    for (i, j), value in products.items():
        out[i, j] = out[j, i] = (n * value - sums[i] * sums[j]) / (n * n)
    return out


def fit_whitening(vectors: DataFrame, dims: int, components: int = COMPONENTS) -> Whitener | None:
    """Fit over all rows of ``vectors`` (one usable ``vector`` column); None without rows."""
    parts = vectors.select("vector").mapInArrow(_sums(dims), SUMS)
    rows = parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()  # (d + 1)(d + 2) / 2 rows
    found = {(r.i, r.j): int(r.total) for r in rows}
    n = found.pop((-1, -1), 0)
    if not n:
        return None
    sums = [found.pop((-1, j)) for j in range(dims)]
    cov = centred(n, sums, found)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    spread = values > max(values.max(initial=0.0), 0.0) * dims * np.finfo(float).eps
    scale = np.where(spread, 1 / np.sqrt(np.where(spread, values, 1.0)), np.nan)
    trace = np.trace(cov)
    kind = np.int64 if max(map(abs, sums), default=0) < 1 << 62 else object
    return Whitener(n, np.array(sums, kind), axes * scale, np.maximum(values, 0.0) / trace if trace > 0 else np.zeros(len(values)))


def _second_moments(fit: Whitener):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = np.flatnonzero(~np.isnan(fit.axes).any(axis=0))
        total = np.zeros((len(spread),) * 2)
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                w = fit.project(fixed_point(batch.column(0).slice(first, BLOCK_ROWS), fit.dims))[:, spread]
                total += w.T @ w
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "total"])

    return run


def identity_error(vectors: DataFrame, fit: Whitener) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over components with spread."""
    parts = vectors.select("vector").mapInArrow(_second_moments(fit), "i int, j int, total double")
    goal = F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)
    summed = parts.groupBy("i", "j").agg((F.sum("total") / fit.n).alias("value"))
    worst = summed.agg(F.max(F.abs(F.col("value") - goal)).alias("worst")).first().worst
    return float(worst or 0.0)


def _whitened(fit: Whitener, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                z = fixed_point(part.column(1), fit.dims)
                w = fit.project(z)
                rows, count = w.shape
                if not count:
                    continue
                at = pa.array(np.repeat(np.arange(rows), count))
                deviation = pa.array(map(str, fit.deviation(z))).cast(pa.decimal128(38, 0))
                values = pa.array(w.reshape(-1), mask=np.isnan(w).reshape(-1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(at),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * count, fit.n)),
                        deviation.take(at),
                        values,
                        pa.array(np.tile(fit.explained, rows)),
                        pa.array(np.full(rows * count, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def _keep_usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(usable(batch.column(1))))


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each usable vector and component: ``vec_id``, ``component`` (from 1), ``n``,
    ``deviation`` (decimal), ``whitened``, ``explained``, ``identity_error``.

    The fit is over all usable vectors. Entries c become floor(64c) + 1000000; the constant cancels
    in every centred value. Sums and products are exact; eigenvectors are unit, of either sign (the entry of
    largest size is positive). ``deviation`` is the exact sum of (n*x - S)^2.

    Vectors that are null or hold nulls, NaN or infinities are dropped. A vector shorter than the longest
    counts as ending in zeros. A component without spread (eigenvalue zero to double precision) has
    a NULL ``whitened`` and takes no part in ``identity_error``. Null ids and repeated rows are
    vectors like others. No usable vectors, or only empty ones, give an empty result. Extra columns are
    not read. Vectors of more than 4,096 dimensions, and entries beyond 2^49, stop the job.
    """
    slim = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector"))
    kept = slim.mapInArrow(_keep_usable, slim.schema)
    kind = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    dims = slim.where("vector IS NOT NULL").mapInArrow(_keep_usable, slim.schema).agg(F.max(F.size("vector"))).first()[0] or 0
    if dims > MOST_DIMS:
        raise ValueError(f"vectors of {dims} dimensions; at most {MOST_DIMS} are handled")
    fit = fit_whitening(kept, dims, components) if dims else None
    if fit is None:
        return rows.sparkSession.createDataFrame([], kind)
    return kept.mapInArrow(_whitened(fit, identity_error(kept, fit)), T.StructType.fromDDL(kind))
