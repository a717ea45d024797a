"""Embedding vectors as whole numbers in numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SCALE = 256
# Numbers whose sums of products stay below this are added exactly as doubles.
EXACT = 2.0 ** 53


def as_doubles(column: str) -> Column:
    return F.col(column).cast("array<double>")


def whole_rows(vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``rows, offsets, x`` of the vectors that are not null and hold finite numbers only.

    ``x`` has floor(scale * c) of every component, at most 2^63 in size, vector after vector; ``rows`` are their places.
    """
    n = len(vectors)
    if not n:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)
    offsets = np.asarray(vectors.offsets.to_numpy(), np.int64)
    values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    keep = np.asarray(vectors.is_valid().to_numpy(zero_copy_only=False), bool) & (bad[offsets[1:]] == bad[offsets[:-1]])
    rows, size = np.flatnonzero(keep), np.diff(offsets)
    flat = values[_places(offsets[:-1][rows], size[rows])] if len(rows) < n else values[offsets[0]:offsets[-1]]
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(flat * scale), -2.0 ** 63, 2.0 ** 63 - 1024).astype(np.int64)
    return rows, np.concatenate([[0], np.cumsum(size[rows])]), x


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers from each start on, as many as its size says."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def matrix(offsets: np.ndarray, x: np.ndarray, dims: int) -> np.ndarray:
    """One row of ``dims`` numbers per vector; a shorter vector goes on with zeros."""
    size = np.diff(offsets)
    if len(size) and (size == dims).all():
        return x.reshape(-1, dims)
    out = np.zeros((len(size), dims), np.int64)
    out[np.repeat(np.arange(len(size)), size), _places(np.zeros(len(size), np.int64), size)] = x
    return out


def dimensions(df: DataFrame, column: str) -> int:
    """Length of the longest vector, 0 without any."""
    return df.agg(F.max(F.size(F.col(column)))).first()[0] or 0


def narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest of the four integer types that holds them."""
    most = max((int(x.max()), -int(x.min()) - 1)) if x.size else 0
    return x.astype(next(t for t in ("<i1", "<i2", "<i4", "<i8") if most < 2 ** (8 * int(t[2]) - 1)))
