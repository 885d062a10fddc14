"""Vectors as whole numbers: which rows take part, and a batch of them as a matrix.

Rows take part whose vector is not null and holds neither null nor non-finite components, nor one that is too large to become
a 64-bit integer (2^62 or more after scaling). Vectors shorter than the longest count as if zeros followed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that are worked on at once.
BLOCK = 4096
#: Components are smaller than this after scaling.
TOO_LARGE = 2.0**62


def taking_part(rows: DataFrame, vector: str, scale: int) -> DataFrame:
    """Rows that take part, with the vector as an array of doubles or floats."""
    df = rows if dict(rows.dtypes)[vector] in ("array<float>", "array<double>") else rows.withColumn(vector, F.col(vector).cast("array<double>"))
    fails = lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) >= F.lit(TOO_LARGE / scale))
    return df.where(F.col(vector).isNotNull() & ~F.exists(vector, fails))


def longest(rows: DataFrame, vector: str) -> int:
    return rows.agg(F.coalesce(F.max(F.size(vector)), F.lit(0))).first()[0]


def whole_numbers(column: pa.Array, width: int, scale: int, add: int = 0) -> np.ndarray:
    """floor(scale * x) + add of each component, (rows, width) as int64."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.float64)
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        x = flat.reshape(len(sizes), width)
    else:
        x = np.zeros((len(sizes), width))
        at = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)
        x[np.repeat(np.arange(len(sizes)), sizes), at] = flat
    return np.floor(x * scale).astype(np.int64) + add


def blocks(batches: Iterator[pa.RecordBatch], vector: str, width: int, scale: int, add: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of at most BLOCK rows, each with its matrix."""
    for batch in batches:
        for k in range(0, batch.num_rows, BLOCK):
            piece = batch.slice(k, BLOCK)
            yield piece, whole_numbers(piece.column(piece.schema.get_field_index(vector)), width, scale, add)


def safe_ints(x: np.ndarray, most: int) -> np.ndarray:
    """x as it is if numbers up to `most` in absolute value fit a 64-bit integer, else as Python's integers of any size."""
    return x if most < 2**62 else x.astype(object)


def reach(x: np.ndarray) -> int:
    """The largest absolute value."""
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def try_long(c: Column) -> Column:
    """A decimal as a long; null where it does not fit."""
    return c.try_cast("long")
