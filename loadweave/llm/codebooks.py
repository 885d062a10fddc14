"""Compression of vectors to codes: parts of each vector are replaced by the number of the nearest entry of a codebook.

All arithmetic is in whole numbers. Each round broadcasts the codebooks; tasks compute all squared distances of a block by norm
expansion, |x|^2 - 2 x.c + |c|^2, with integer matrix products, and take the first smallest. Sums and counts of each entry are
added up within a task and merged by a shuffle grouped by part, entry and place, which has as many keys as the codebooks have
numbers. Only codebooks reach the driver; the table is read once a round and never rewritten.

Rows whose vector does not take part (vectors.py) are left out. Ties of distance go to the lower entry; entries start as the
parts of the smallest vec_ids, of repeated ones the smaller vector first, null last. With fewer rows than entries there are
fewer entries. An empty table gives no rows. Errors beyond 38 digits are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, table, widened
from .vectors import blocks, longest, reach, safe_ints, taking_part, try_long

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Labels whose totals may be broadcast (some 30 bytes each).
BROADCAST_LABELS = 200_000
_WIDE = pa.decimal128(38, 0)


def _decimals(x: np.ndarray) -> pa.Array:
    """Whole numbers of any size as decimals; null beyond 38 digits."""
    if x.dtype != object:
        return pa.array(x).cast(_WIDE)
    return pa.array([Decimal(int(v)) if abs(int(v)) < 10**38 else None for v in x], _WIDE)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows (n, w) to all entries (k, w), exactly."""
    most = max(reach(x), reach(entries))
    x, c = (safe_ints(a, 4 * max(1, x.shape[1]) * most * most) for a in (x, entries))
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows (n, parts * w) and codebooks (parts, k, w): each part's entry (n, parts), and the summed distances (n)."""
    parts, _, w = books.shape
    codes, error = np.zeros((len(x), parts), np.int64), np.zeros(len(x), np.int64)
    for p in range(parts):
        d = distances(x[:, p * w : (p + 1) * w], books[p])
        codes[:, p] = d.argmin(1)
        least = d[np.arange(len(x)), codes[:, p]]
        error = error + (least if least.dtype != object and reach(error) + reach(least) < 2**62 else least.astype(object))
    return codes, error


def entry_sums(x: np.ndarray, codes: np.ndarray, entries: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts (parts, entries) and sums (parts, entries, w) of a block; sums are Python's integers, so blocks can be added without end."""
    parts = codes.shape[1]
    counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, w), object)
    for p in range(parts):
        counts[p] = np.bincount(codes[:, p], minlength=entries)
        # A matrix product with the indicator of each entry adds up the rows of all entries at once.
        own = x[:, p * w : (p + 1) * w]
        chosen = (codes[:, p][:, None] == np.arange(entries)).astype(np.int64)
        sums[p] = (chosen.T @ safe_ints(own, len(x) * reach(own))).astype(object)
    return counts, sums


class Codebooks:
    """(parts, entries, w) whole numbers for vectors of `width` components, padded to a multiple of the number of parts."""

    def __init__(self, books: np.ndarray):
        self.books = books

    @property
    def width(self) -> int:
        return self.books.shape[0] * self.books.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def _first(rows: DataFrame, vector: str, parts: int, entries: int, scale: int) -> Codebooks:
    w = -(-longest(rows, vector) // parts)
    wanted = rows.select("vec_id", F.col(vector).cast("array<double>").alias("x")).orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    books = np.zeros((parts, len(wanted), w), np.int64)
    for k, r in enumerate(wanted):
        x = np.zeros(parts * w, np.int64)
        x[: len(r["x"])] = np.floor(np.array(r["x"]) * scale).astype(np.int64)
        books[:, k] = x.reshape(parts, w)
    return Codebooks(books)


def fit(rows: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks of rows (vec_id and a vector column), fitted on all that take part. A round replaces each entry by the floor of the mean of its parts."""
    good = taking_part(rows.select("vec_id", vector), vector, scale)
    model = _first(good, vector, parts, entries, scale)
    vectors = good.select(vector)
    for _ in range(rounds if model.books.size else 0):
        sent = rows.sparkSession.sparkContext.broadcast(model.books)

        def gathered(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            books = sent.value
            n, k, w = books.shape
            counts, sums = np.zeros((n, k), np.int64), np.zeros((n, k, w), object)
            for _, x in blocks(batches, vector, n * w, scale):
                more = entry_sums(x, nearest(x, books)[0], k, w)
                counts, sums = counts + more[0], sums + more[1]
            p, e, at = (a.ravel() for a in np.indices(sums.shape))
            some = counts[p, e] > 0
            yield pa.RecordBatch.from_arrays([pa.array(a[some], pa.int32()) for a in (p, e, at)] + [pa.array(counts[p, e][some]), _decimals(sums.ravel()[some])], ["p", "e", "at", "n", "s"])

        part_sums = vectors.mapInArrow(gathered, "p int, e int, at int, n long, s decimal(38,0)")
        books = model.books.astype(object)
        for r in part_sums.groupBy("p", "e", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
            books[r["p"], r["e"], r["at"]] = int(r["s"]) // r["n"]
        model = Codebooks(books.astype(np.int64))
        sent.unpersist()
    return model


def encode(rows: DataFrame, model: Codebooks, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error decimal(38,0)) of rows that take part. code: two hexadecimal digits a part."""
    schema = widened(rows.select("vec_id", "label"), "code string, error decimal(38,0)")
    sent = rows.sparkSession.sparkContext.broadcast(model.books)
    width, digits = model.width, np.array([f"{k:02x}" for k in range(max(1, model.books.shape[1]))])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, x in blocks(batches, vector, width, scale):
            codes, error = nearest(x, sent.value)
            text = ["".join(r) for r in digits[codes].tolist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(text, pa.string()), _decimals(error)], ["vec_id", "label", "code", "error"])

    good = taking_part(rows.select("vec_id", "label", vector), vector, scale)
    return good.mapInArrow(coded, schema)


def decode(coded: DataFrame, model: Codebooks, scale: int = SCALE) -> DataFrame:
    """coded with `vector`: the doubles that its code stands for."""
    sent = coded.sparkSession.sparkContext.broadcast(model.books)
    schema = widened(coded.select("vec_id", "code"), "vector array<double>")

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        for batch in batches:
            codes = np.array([[int(c[k : k + 2], 16) for k in range(0, len(c), 2)] for c in batch.column(1).to_pylist()], np.int64).reshape(batch.num_rows, -1)
            found = books[np.arange(books.shape[0]), codes].reshape(batch.num_rows, -1) / scale
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(found), pa.list_(pa.float64()))], ["vec_id", "code", "vector"])

    return coded.select("vec_id", "code").mapInArrow(restored, schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """coded with label_error: error summed over equal labels, nulls together. Totals are partial sums; they are broadcast while they are few."""
    totals = settled(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label"))
    few = totals.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    return coded.join(F.broadcast(totals) if few else totals, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")


def op11_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    model = fit(rows)
    coded = settled(encode(rows, model))
    return with_label_error(coded).select("vec_id", "code", try_long(F.col("error")).alias("error"), try_long(F.col("label_error")).alias("label_error"), F.lit(model.sha256()).alias("codebooks_sha256"))


def _sql() -> str:
    """The rounds one after another, each a table of assignments and one of entries; vectors of equal length that PARTS divides."""
    near = lambda k: f"near{k} AS MATERIALIZED (SELECT r, label, vec_id, p, arg_min(e, (list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e)) AS e, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d FROM parts JOIN book{k} USING (p) GROUP BY r, label, vec_id, p)"
    steps = []
    for k in range(ROUNDS):
        steps.append(near(k))
        steps.append(f"mean{k} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT p, e, i, floor(sum(x[i]) / count(*))::BIGINT AS m FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM parts JOIN near{k} USING (r, p)) GROUP BY p, e, i) GROUP BY p, e)")
        steps.append(f"book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (p, e))")
    return f"""
WITH good AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS z FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, vec_id, label, p, z[p * len(z) // {PARTS} + 1 : (p + 1) * len(z) // {PARTS}] AS x FROM good, range({PARTS}) t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {ENTRIES}),
{', '.join(steps)},
{near(ROUNDS)},
said AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS s FROM book{ROUNDS}),
coded AS (SELECT r, vec_id, label, string_agg(format('{{:02x}}', e::INTEGER), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY r, vec_id, label)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, s AS codebooks_sha256 FROM coded, said
"""


ORACLE = _sql()
QUERIES = {"op11_codebooks": op11_codebooks}
ORACLES = {"op11_codebooks": ORACLE}
