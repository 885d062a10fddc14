"""Whitening of vectors through an exact covariance: digit-slice matrix products.

Components become whole numbers x. A first pass adds them up: n and the sums S of each dimension. A second pass forms the
deviations n * x - S, which are whole numbers too, cuts them into limbs of 20 bits (the highest is signed), and multiplies limb
by limb with float64 BLAS: products of 40 bits over at most 4,096 rows stay under 2^53, so every result is exact. Limb products
are shifted and added as integers of any size in the task, and leave it in digits of 48 bits, which a shuffle grouped by matrix
place adds up. The driver gets one number for each place of the matrix, whatever the number of rows, divides by n^3, correctly
rounded, and decomposes it. A third pass whitens all rows and measures their covariance, which shows the error.

Rows whose vector does not take part (vectors.py) are left out; missing components of shorter vectors count as 0 before scaling.
Components without variance (eigenvalue not above rounding) are left out, so n = 1 or equal vectors give no rows, as does an
empty table. The sign of a component makes its entry of largest absolute value positive, the first of those if tied.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, widened
from .vectors import blocks, longest, reach, safe_ints, taking_part, try_long

SCALE, ADD, COMPONENTS = 1024, 100_000, 8
#: Bits of a limb; with 4,096 rows in a block 2 * 20 + 12 = 52 bits are exact in a double.
LIMB = 20
#: Bits of the digits in which sums leave a task: 2^15 tasks' digits fit a long, and Spark adds them as decimals.
DIGIT = 48


def limbs(d: np.ndarray) -> list[np.ndarray]:
    """d as float64 matrices whose sum, each shifted by LIMB bits more than the one before, is d; all but the last are from 0 to 2^20 - 1."""
    out, rest = [], d
    while True:
        high = rest >> LIMB
        if reach(rest) < 1 << LIMB:
            return [*out, rest.astype(np.float64)]
        out.append((rest - (high << LIMB)).astype(np.float64))
        rest = high


def exact_products(d: np.ndarray) -> np.ndarray:
    """d.T @ d of whole numbers of any size, as Python's integers. d has at most 4,096 rows."""
    cut = limbs(d)
    total = np.zeros((d.shape[1], d.shape[1]), object)
    for a in range(len(cut)):
        for b in range(a, len(cut)):
            product = (cut[a].T @ cut[b]).astype(np.int64).astype(object)
            total = total + ((product if a == b else product + product.T) << (LIMB * (a + b)))
    return total


def _digits(v: int) -> list[int]:
    """Signed digits of a whole number, lowest first."""
    sign, v, out = (-1 if v < 0 else 1), abs(v), []
    while v:
        out.append(sign * (v & ((1 << DIGIT) - 1)))
        v >>= DIGIT
    return out


def _added(rows: DataFrame, fn) -> dict[tuple[int, int], int]:
    """Whole numbers by place (i, j), which tasks gave in digits, added up."""
    digits = rows.mapInArrow(fn, "i int, j int, k int, v long").groupBy("i", "j", "k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    out: dict[tuple[int, int], int] = {}
    for r in digits.collect():
        out[r["i"], r["j"]] = out.get((r["i"], r["j"]), 0) + (int(r["v"]) << (DIGIT * r["k"]))
    return out


def _as_digits(values: dict[tuple[int, int], int]) -> pa.RecordBatch:
    rows = [(i, j, k, x) for (i, j), v in values.items() for k, x in enumerate(_digits(v))]
    i, j, k, v = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(k, pa.int32()), pa.array(v, pa.int64())], ["i", "j", "k", "v"])


@dataclass(frozen=True)
class Whitening:
    """n, sums (Python's integers), components (width, c), eigenvalues (c), and the trace, of all vectors that were fitted."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    scale: int = SCALE
    add: int = ADD

    @property
    def width(self) -> int:
        return len(self.sums)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S."""
        most = self.n * reach(x) + max(map(abs, self.sums), default=0)
        wide = safe_ints(x, most)
        return self.n * wide - (self.sums.astype(np.int64) if wide.dtype != object else self.sums)[None, :]

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        centred = (deviations / self.n).astype(np.float64)
        return centred @ (self.components / np.sqrt(self.eigenvalues))


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, add: int = ADD) -> Whitening:
    """The whitening of all rows that take part. At most `components` components, by falling eigenvalue."""
    good = taking_part(rows.select(vector), vector, scale)
    width = longest(good, vector)
    none = Whitening(0, np.zeros(width, object), np.zeros((width, 0)), np.zeros(0), 0.0, scale, add)
    if not width:
        return none

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, np.zeros(width, object)
        for piece, x in blocks(batches, vector, width, scale, add):
            n += piece.num_rows
            s = s + safe_ints(x, len(x) * reach(x)).sum(0).astype(object)
        yield _as_digits({(0, k): int(v) for k, v in enumerate(s)} | {(1, 0): n})

    found = _added(good, sums)
    n = found.get((1, 0), 0)
    if not n:
        return none
    first = Whitening(n, np.array([found.get((0, k), 0) for k in range(width)], object), none.components, none.eigenvalues, 0.0, scale, add)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for _, x in blocks(batches, vector, width, scale, add):
            total = total + exact_products(first.deviations(x))
        yield _as_digits({(i, j): int(total[i, j]) for i in range(width) for j in range(i, width)})

    found = _added(good, products)
    covariance = np.zeros((width, width))
    for (i, j), v in found.items():
        covariance[i, j] = covariance[j, i] = v / n**3
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    # What is left of an eigenvalue of zero after rounding.
    kept = int((values[:components] > max(values[0], 0) * width * np.finfo(float).eps).sum())
    axes = axes[:, :kept]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(kept)] < 0, -1.0, 1.0)
    return Whitening(n, first.sums, axes, values[:kept], sum(v for (i, j), v in found.items() if i == j) / n**3, scale, add)


def identity_error(rows: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows.

    Whitened values are centred already; what rounding leaves of their means is taken off too."""
    c = len(model.eigenvalues)
    if not c:
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((c + 1, c))
        for _, x in blocks(batches, vector, model.width, model.scale, model.add):
            z = model.whitened(model.deviations(x))
            total += np.vstack([z.sum(0), z.T @ z])
        i, j = (a.ravel() for a in np.indices(total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    good = taking_part(rows.select(vector), vector, model.scale)
    total = np.zeros((c + 1, c))
    for r in good.mapInArrow(moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r["i"], r["j"]] = r["v"] / model.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(c)).max())


def transform(rows: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """(vec_id, deviation decimal(38,0), whitened array<double>) of rows that take part. A deviation beyond 38 digits is null."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, x in blocks(batches, vector, model.width, model.scale, model.add):
            d = model.deviations(x)
            wide = safe_ints(d, d.shape[1] * reach(d) ** 2)
            squares = (wide * wide).sum(1)
            deviation = pa.array(squares).cast(pa.decimal128(38, 0)) if squares.dtype != object else pa.array([Decimal(v) if v < 10**38 else None for v in squares.tolist()], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([piece.column(0), deviation, pa.array(list(model.whitened(d)), pa.list_(pa.float64()))], ["vec_id", "deviation", "whitened"])

    schema = widened(rows.select("vec_id"), "deviation decimal(38,0), whitened array<double>")
    return taking_part(rows.select("vec_id", vector), vector, model.scale).mapInArrow(each, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    model = fit(rows)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues]).cast("array<double>")
    each = transform(rows, model).select("vec_id", "deviation", explained.alias("shares"), F.posexplode("whitened").alias("k", "whitened"))
    return each.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), try_long(F.col("deviation")).alias("deviation"), "whitened",
        F.element_at("shares", F.col("k") + 1).alias("explained"), F.lit(identity_error(rows, model)).alias("identity_error"),
    )


QUERIES = {"op13_whitening": op13_whitening}
ORACLES: dict[str, str] = {}
