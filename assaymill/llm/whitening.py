"""Whitening of embeddings from a polarisation covariance.

Entries become whole numbers, ``x = floor(256 c)``, so every sum is exact and does not depend on the
order of rows. Over the distinct vectors Spark adds up, in two passes, the sums S of each
dimension, and then the squares of the centred values ``n x - S`` for each dimension and of the
centred sums of each pair of dimensions. As ``2 a b = (a + b)^2 - a^2 - b^2``, differences
of these variances are all cross-covariances. Tasks add in numpy, in words of 64 bits; Spark adds
the tasks' totals by 32-bit limb, so nothing overflows at any size. The driver gets one total per
pair of dimensions, whatever the number of rows, assembles the matrix and calls ``eigh``.

Cases: rows whose vector is NULL, or holds a NULL, NaN or infinite entry, are dropped, and so are
rows that have not the commonest length (the greater one at a tie). Equal vectors count once in the
fit and all get a result. Entries whose 256-fold leaves the range of 64 bits are taken as its ends.
Components without variance have NULL in ``whitened``. A ``deviation`` that exceeds 64 bits is
NULL. Empty tables give empty ones. ``transform`` keeps the input's columns but those of its own names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.llm.common import append_columns, ship_package
from assaymill.session import materialize

SCALE = 256
#: Rows that are worked on at a time, divided by the number of dimensions.
CELLS = 1 << 21
_LIMB = 32
_LONG = 1 << 63
_TOTALS = "i int, j int, limb int, part bigint"


def usable(vector: str) -> Column:
    """Whether a vector is there and all its entries are finite."""
    def wrong(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    return F.coalesce(~F.exists(vector, lambda c: wrong(c.cast("double"))), F.lit(False))


def quantised(vector: str) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: components in columns, by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    fit_list: DataFrame | None

    @property
    def dims(self) -> int:
        return len(self.sums)

    def usable_components(self) -> np.ndarray:
        """Components whose eigenvalue is more than the rounding error of the decomposition."""
        noise = self.trace * self.dims * np.finfo(float).eps
        return self.values > noise

    def explained(self, component: int) -> float | None:
        return float(self.values[component] / self.trace) if self.trace > 0 else None


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _largest(cells: np.ndarray) -> int:
    if cells.size == 0:
        return 0
    return max(abs(int(cells.max())), abs(int(cells.min())))


def _column_sums(cells: np.ndarray) -> list[int]:
    """Exact sums of the columns of an integer matrix, as Python integers."""
    if cells.dtype == object:
        return [int(v) for v in cells.sum(axis=0)]
    high, low = (cells >> _LIMB).sum(axis=0), (cells & ((1 << _LIMB) - 1)).sum(axis=0)
    return [(int(h) << _LIMB) + int(l) for h, l in zip(high, low)]


def _square_sums(cells: np.ndarray) -> list[int]:
    """Exact sums of squares of the columns."""
    most = _largest(cells)
    if most < 1 << 31:
        return _column_sums(cells * cells)
    if cells.dtype == object or most >= 1 << 61:
        cells = cells.astype(object)
        return _column_sums(cells * cells)
    high, low = cells >> 31, cells & ((1 << 31) - 1)
    parts = (_column_sums(high * high), _column_sums(high * low), _column_sums(low * low))
    return [(a << 62) + (b << 32) + c for a, b, c in zip(*parts)]


def centred(x: np.ndarray, n: int, sums: Sequence[int]) -> np.ndarray:
    """``n x - S`` without overflow: 64 bits where they do, Python integers elsewhere."""
    reach = _largest(x) * n + max((abs(s) for s in sums), default=0)
    if reach < 1 << 61:
        return x * np.int64(n) - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _limbs(i: int, j: int, value: int) -> Iterator[tuple[int, int, int, int]]:
    """A total as signed 32-bit limbs, so that sums of them stay within 64 bits."""
    sign, left, limb = (-1 if value < 0 else 1), abs(value), 0
    while left:
        yield i, j, limb, sign * (left & ((1 << _LIMB) - 1))
        left >>= _LIMB
        limb += 1


def _totals(vectors: DataFrame, dims: int, per_batch) -> dict[tuple[int, int], int]:
    """Exact totals by index pair: ``per_batch(matrix)`` yields ``(i, j, total)``; Spark adds them."""
    rows_at_once = max(1, CELLS // max(1, dims))

    def run(batches):
        found: dict[tuple[int, int], int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                matrix = _matrix(batch.column(0).slice(at, rows_at_once), dims)
                for i, j, total in per_batch(matrix):
                    found[i, j] = found.get((i, j), 0) + total
        rows = [limb for (i, j), total in found.items() for limb in _limbs(i, j, total)]
        for at in range(0, len(rows), 100_000):
            columns = zip(*rows[at : at + 100_000])
            arrays = [pa.array(c, pa.int64() if k == 3 else pa.int32()) for k, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "limb", "part"])

    added = vectors.mapInArrow(run, _TOTALS).groupBy("i", "j", "limb").agg(F.sum("part").alias("part"))
    totals: dict[tuple[int, int], int] = {}
    for i, j, limb, part in added.collect():  # one row per pair of dimensions and limb
        totals[i, j] = totals.get((i, j), 0) + (part << (_LIMB * limb))
    return totals


def _pair_squares(n: int, sums: Sequence[int], dims: int):
    def per_batch(x: np.ndarray):
        c = centred(x, n, sums)
        for i in range(dims):
            yield i, i, _square_sums(c[:, i : i + 1])[0]
            for j, total in enumerate(_square_sums(c[:, i + 1 :] + c[:, i : i + 1]), i + 1):
                yield i, j, total

    return per_batch


def covariance(totals: dict[tuple[int, int], int], n: int, dims: int) -> np.ndarray:
    """The matrix from squares of centred values and of centred pair sums, rounded once an entry."""
    v = np.zeros((dims, dims))
    for i in range(dims):
        own = totals.get((i, i), 0)
        v[i, i] = own / n**3
        for j in range(i + 1, dims):
            cross = totals.get((i, j), 0) - own - totals.get((j, j), 0)
            v[i, j] = v[j, i] = cross / (2 * n**3)
    return v


def fit(df: DataFrame, vector: str = "embedding") -> Whitening:
    """Sums, covariance and components of the distinct vectors of ``df``."""
    ship_package(df.sparkSession)
    whole = df.where(usable(vector)).select(quantised(vector).alias("x"))
    distinct = materialize(whole.distinct(), "whiten-fit")
    # The commonest length counts all usable rows, not only distinct ones.
    lengths = whole.groupBy(F.size("x").alias("dims")).count()
    found = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    dims = found["dims"] if found else 0
    fit_list = distinct.where(F.size("x") == dims)
    n = fit_list.count() if dims else 0
    if n == 0:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, None)

    totals = _totals(fit_list, dims, lambda x: ((0, j, t) for j, t in enumerate(_column_sums(x))))
    sums = tuple(totals.get((0, j), 0) for j in range(dims))
    squares = _totals(fit_list, dims, _pair_squares(n, sums, dims))
    v = covariance(squares, n, dims)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1].copy(), vectors[:, ::-1].copy()
    largest = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[largest, np.arange(dims)])
    trace = sum(squares.get((i, i), 0) for i in range(dims)) / n**3
    return Whitening(n, sums, values, vectors, trace, fit_list)


def _project(df: DataFrame, x: str, model: Whitening, components: int) -> DataFrame:
    """Add ``deviation`` and ``whitened`` (an array) for the quantised vectors ``x``."""
    n, sums, dims = model.n, model.sums, model.dims
    k = min(components, dims)
    good = model.usable_components()[:k]
    scale = np.where(good, 1 / np.sqrt(np.where(good, model.values[:k], 1)), np.nan)
    basis = model.vectors[:, :k] * scale
    fields = [
        T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType())),
    ]

    def start():
        def step(column):
            c = centred(_matrix(column, dims), n, sums)
            if _largest(c) ** 2 * dims < _LONG:
                deviation = pa.array((c.astype(np.int64) ** 2).sum(axis=1))
            else:
                exact = (c.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([int(e) if e < _LONG else None for e in exact], pa.int64())
            z = (c / n).astype(float) @ basis
            flat = pa.array(z.ravel(), mask=np.isnan(z.ravel()))
            ends = pa.array(np.arange(0, z.size + 1, k, dtype=np.int32))
            return [deviation, pa.ListArray.from_arrays(ends, flat)]

        return step

    return append_columns(df, [x], fields, start)


def transform(
    df: DataFrame, model: Whitening, vector: str = "embedding", components: int = 4
) -> DataFrame:
    """The usable rows of the fitted length with ``deviation`` and ``whitened``, an array."""
    own = {"deviation", "whitened"}
    kept = F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in own])
    rows = df.where(usable(vector)).select(kept.alias("_row"), quantised(vector).alias("_x"))
    if model.n == 0:
        nothing = [F.lit(None).cast("bigint").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")]
        return rows.limit(0).select("_row.*", *nothing)
    rows = rows.where(F.size("_x") == model.dims)
    return _project(rows, "_x", model, components).select("_row.*", "deviation", "whitened")


def identity_error(model: Whitening, components: int = 4) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity, measured on the data.

    Spark's ``covar_pop`` centres before it multiplies. Components without variance are left out.
    """
    k = min(components, model.dims)
    used = [i for i in range(k) if model.usable_components()[i]]
    if not used:
        return None
    z = _project(model.fit_list, "x", model, components)
    pairs = [(i, j) for i in used for j in used if i <= j]
    found = z.agg(
        *[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs]
    ).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened_components(
    df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", components: int = 4
) -> DataFrame:
    """One row per usable vector and component: the fit, the transform and how well it whitens."""
    model = fit(df, vector)
    rows = transform(df.select(id_col, vector), model, vector, components)
    error = identity_error(model, components)
    shares = [model.explained(c) for c in range(min(components, model.dims))]
    explained = F.array(*[F.lit(s).cast("double") for s in shares]) if shares else F.lit(None).cast("array<double>")
    one = rows.select(id_col, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return one.select(
        id_col,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
