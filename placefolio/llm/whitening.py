"""Whitening of embeddings: exact sums, a distributed covariance, and eigenvectors refined from single to double precision.

A vector takes part as whole numbers, floor(256 * c). Covariances are over the distinct vectors, so copies weigh nothing.
The d x d covariance is the only thing that reaches the driver besides d sums; it does not grow with the rows.

Null vectors and those with null or non-finite entries are dropped. All other rows stay, repeated ones too. A vector
shorter than the longest counts as going on with zeros. Without rows the result is empty. A component whose eigenvalue is
zero up to rounding (always so with one distinct vector) has nothing to divide by: its whitened value is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructField, StructType

from placefolio.llm.common import fresh
from placefolio.llm.vectors import SCALE, as_doubles, dimensions, matrix, whole_rows
from placefolio.session import staged

_EPS = np.finfo(np.float64).eps
_ROUNDS = 12
_LOW = 2 ** 32


@dataclass
class Whitening:
    """What was fitted: distinct vectors ``n``, their exact ``sums``, all eigenvalues, one eigenvector per row of ``vectors``."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def explained(self) -> list[float | None]:
        return [float(v / self.trace) if self.trace > 0 else None for v in self.values[:len(self.vectors)]]

    @property
    def usable(self) -> np.ndarray:
        """Components whose eigenvalue is not zero up to rounding."""
        top = self.values[0] if len(self.values) else 0.0
        return self.values[:len(self.vectors)] > max(len(self.values) * _EPS * top, 0.0)


def _refined(a: np.ndarray, x: np.ndarray, floor: float) -> np.ndarray:
    """Eigenvectors of ``a`` from approximate ones, by matrix products only (Ogita and Aishima).

    A round squares the error of vectors whose eigenvalues lie apart. Eigenvalues closer than the error at the start are a
    cluster: its vectors are only made orthogonal to each other, so that they come to span the right space. Inside it the
    matrix is then shifted by the cluster's mean, and the small matrix that is left is solved by itself, again from
    single precision.
    """
    same = groups = None
    for _ in range(_ROUNDS):
        r = np.eye(len(a)) - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        if groups is None:
            error = 2 * (np.linalg.norm(s - np.diag(values), 2) + np.linalg.norm(a, 2) * np.linalg.norm(r, 2))
            order = np.argsort(-values, kind="stable")
            ends = np.flatnonzero(-np.diff(values[order]) > max(2 * error, floor)) + 1
            groups = np.split(order, ends)
            number = np.empty(len(a), np.int64)
            for k, group in enumerate(groups):
                number[group] = k
            same = number[:, None] == number[None, :]
        gap = np.where(same, 1.0, values[None, :] - values[:, None])
        step = np.where(same, r / 2, (s + values[None, :] * r) / gap)
        x = x + x @ step
        if np.abs(step).max() < 4 * _EPS * len(a):
            break
    for group in groups:
        if 1 < len(group) < len(a):
            basis = x[:, group]
            inner = basis.T @ (a @ basis)
            x[:, group] = basis @ eigenvectors((inner + inner.T) / 2, floor)
    # The rotations leave rounding behind. A group of all is a matrix that is hardly more than rounding.
    return x + x @ (np.eye(len(a)) - x.T @ x) / 2


def eigenvectors(a: np.ndarray, floor: float = 0.0) -> np.ndarray:
    """Eigenvectors (columns) of a symmetric matrix: solved in single precision, refined in double precision.

    ``floor`` is the size of a matrix that is nothing but rounding: any basis is right for it.
    """
    floor = max(floor, 4 * _EPS * np.abs(a).max(initial=0.0))
    shifted = a - np.eye(len(a)) * (np.trace(a) / max(len(a), 1))
    size = np.abs(shifted).max(initial=0.0)
    if size <= floor:
        return np.eye(len(a))
    start = np.linalg.eigh((shifted / size).astype(np.float32))[1].astype(np.float64)
    return _refined(shifted / size, start, floor / size)


def principal(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from the largest down and their unit eigenvectors as rows; the largest entry of each is positive."""
    x = eigenvectors(covariance)
    x = x / np.linalg.norm(x, axis=0)
    values = np.einsum("ij,ij->j", x, covariance @ x)
    order = np.argsort(-values, kind="stable")
    rows = x[:, order].T
    sign = np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)]) if len(rows) else np.ones(0)
    return values[order], rows * sign[:, None]


def _packed(df: DataFrame, vector: str, dims: int) -> DataFrame:
    """``x binary``: every distinct vector once, each in the narrowest type that holds its numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets, flat = whole_rows(batch["v"])
            x = matrix(offsets, flat, dims)
            most = np.maximum(x.max(axis=1, initial=0), -(x.min(axis=1, initial=0) + 1))
            left = np.ones(len(x), bool)
            for kind in ("<i1", "<i2", "<i4", "<i8"):
                mine = left & (most <= np.iinfo(kind).max)
                left &= ~mine
                if mine.any():
                    # The first byte is the width, so that vectors of different types differ.
                    width = int(kind[2])
                    raw = np.empty((mine.sum(), 1 + width * dims), np.uint8)
                    raw[:, 0], raw[:, 1:] = width, x[mine].astype(kind).view(np.uint8).reshape(mine.sum(), -1)
                    ends = np.arange(mine.sum() + 1, dtype=np.int32) * raw.shape[1]
                    yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(
                        pa.binary(), len(raw), [None, pa.py_buffer(ends), pa.py_buffer(raw)])], ["x"])

    return df.select(as_doubles(vector).alias("v")).mapInArrow(run, "x binary").distinct()


def _unpacked(column: pa.Array, dims: int) -> Iterator[np.ndarray]:
    """Matrices of the packed vectors, one for each width."""
    size = 1 + np.array([1, 2, 4, 8]) * dims
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2], np.uint8)
    for kind, wide in zip(("<i1", "<i2", "<i4", "<i8"), size):
        starts = ends[:-1][np.diff(ends) == wide]
        if len(starts):
            picked = raw[(starts + 1)[:, None] + np.arange(wide - 1)[None, :]]
            yield np.ascontiguousarray(picked).view(kind).astype(np.int64)


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension; two parts per number, so no sum overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            for x in _unpacked(batch["x"], dims) if batch.num_rows else ():
                n += len(x)
                high += (x >> 32).sum(axis=0)
                low += (x & (_LOW - 1)).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(dims), pa.int32()), "n": pa.array([n] * dims, pa.int64()),
                                              "high": pa.array(high), "low": pa.array(low)})

    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    rows = (fit.mapInArrow(run, "dim int, n long, high long, low long").groupBy("dim").agg(wide("n"), wide("high"), wide("low"))
            .orderBy("dim").collect())
    return (int(rows[0]["n"]), [int(r["high"]) * _LOW + int(r["low"]) for r in rows]) if rows else (0, [0] * dims)


def _gram(fit: DataFrame, dims: int, mean: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """Sum over the vectors of (x - mean)(x - mean)', each projected first if ``project`` is given.

    A task adds up its own vectors; the rows of these small matrices are added by row number, in the order of the tasks.
    """
    size = dims if project is None else len(project)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = np.zeros((size, size))
        for batch in batches:
            for x in _unpacked(batch["x"], dims) if batch.num_rows else ():
                centred = x - mean
                if project is not None:
                    centred = centred @ project.T
                total += centred.T @ centred
        if total.any():
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"row": pa.array(range(size), pa.int32()), "task": pa.array([task] * size, pa.int32()),
                                              "values": pa.array([r.tobytes() for r in total], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, total = None, None
        for batch in batches:
            for r, values in zip(batch["row"].to_pylist(), batch["values"]):
                if r != row and row is not None:
                    yield pa.RecordBatch.from_pydict({"row": pa.array([row], pa.int32()), "values": [total.tobytes()]})
                part = np.frombuffer(values.as_py())
                row, total = r, part if r != row else total + part
        if row is not None:
            yield pa.RecordBatch.from_pydict({"row": pa.array([row], pa.int32()), "values": [total.tobytes()]})

    parts = fit.mapInArrow(partial, "row int, task int, values binary")
    rows = parts.repartition("row").sortWithinPartitions("row", "task").mapInArrow(add, "row int, values binary").collect()
    out = np.zeros((size, size))
    for r in rows:
        out[r["row"]] = np.frombuffer(bytes(r["values"]))
    return (out + out.T) / 2


def fit(df: DataFrame, vector: str = "embedding", components: int | None = None) -> Whitening:
    """Fit over the distinct vectors of ``df``. ``components`` limits what is projected; eigenvalues are all computed."""
    dims = dimensions(df, vector)
    distinct = staged(_packed(df, vector, dims), "whitening")
    n, sums = _sums(distinct, dims) if dims else (0, [])
    if not n:
        return Whitening(0, sums, np.zeros(0), np.zeros((0, dims)), 0.0, None)
    mean = np.array([s / n for s in sums])
    covariance = _gram(distinct, dims, mean) / n
    values, vectors = principal(covariance)
    found = Whitening(n, sums, values, vectors[:components], float(np.trace(covariance)), None)
    keep = found.usable
    if keep.any():
        project = found.vectors[keep] / np.sqrt(values[:len(keep)][keep])[:, None]
        found.identity_error = float(np.abs(_gram(distinct, dims, mean, project) / n - np.eye(keep.sum())).max())
    return found


def transform(df: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """All columns of the rows with a whole vector, ``whitened`` (one double per component) and ``deviation``.

    ``deviation`` is the exact sum of (n * x - sums)^2, null if it has over 38 digits. New columns get underscores in
    front where their names are taken.
    """
    names = df.columns
    v, whitened = fresh("v", names), fresh("whitened", names)
    deviation = fresh("deviation", [*names, whitened])
    schema = StructType([*df.schema.fields, StructField(whitened, ArrayType(DoubleType())),
                         StructField(deviation, DecimalType(38, 0))])
    n, dims, keep = model.n, model.vectors.shape[1], model.usable
    mean = np.array([s / n for s in model.sums]) if n else np.zeros(dims)
    scale = np.where(keep, 1 / np.sqrt(np.where(keep, model.values[:len(keep)], 1.0)), np.nan)
    project, sums = model.vectors * scale[:, None], np.array(model.sums, object)
    largest = max((abs(s) for s in model.sums), default=0)

    def deviations(x: np.ndarray) -> pa.Array:
        most = n * int(np.abs(x.astype(np.float64)).max(initial=0.0)) + largest
        if most * most * max(dims, 1) < 2 ** 62:
            return pa.array(((n * x - sums.astype(np.int64)) ** 2).sum(axis=1)).cast(pa.decimal128(38, 0), safe=False)
        from decimal import Context, Decimal
        exact = [int(d) for d in ((n * x.astype(object) - sums) ** 2).sum(axis=1)]
        return pa.array([Decimal(d) if d < 10 ** 38 else None for d in exact], pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, offsets, flat = whole_rows(batch[v])
            if not len(rows):
                continue
            x = matrix(offsets, flat, dims)
            out = (x - mean) @ project.T
            values = pa.array(out.ravel(), mask=np.isnan(out).ravel())
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * out.shape[1])
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*(kept[c] for c in names), pa.ListArray.from_arrays(ends, values), deviations(x)],
                                             [*names, whitened, deviation])

    return df.withColumn(v, as_doubles(vector)).mapInArrow(run, schema)


def component_rows(df: DataFrame, components: int, vector: str = "embedding") -> DataFrame:
    """Fit and transform, then a row for each component, numbered from 1: the columns of ``df`` but the vector, ``component``,
    ``n``, ``deviation`` (null if it exceeds a long), ``whitened``, ``explained`` and ``identity_error``."""
    model = fit(df, vector, components)
    shares = model.explained
    rest = [c for c in df.columns if c != vector]
    wide = transform(df, model, vector)
    whitened, deviation = wide.columns[-2:]
    explained = F.array(*[F.lit(s).cast("double") for s in shares]) if shares else F.array().cast("array<double>")
    return (wide.select(*rest, deviation, F.posexplode(whitened).alias("at", "value"))
            .select(*rest, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                    F.col(deviation).try_cast("long").alias("deviation"), F.col("value").alias("whitened"),
                    F.get(explained, F.col("at")).alias("explained"),
                    F.lit(model.identity_error).cast("double").alias("identity_error")))
