"""Near-duplicates by SimHash: tiled exact comparison of fingerprints.

A fingerprint takes each text's 3-word shingles. Different fingerprints are dealt into tiles by the bit counts of their two
halves. Two fingerprints within the radius have bit counts that differ by the radius at most, over both halves together, so
only such pairs of tiles are compared; all others are skipped. Tiles are compared with exclusive-or and bit counts in numpy,
block by block, where sorted blocks are skipped in the same way by the bit counts of their quarters. Large tiles are split
by a hash, so no task's share depends on how often one bit count occurs. Each pair of tiles returns a spanning forest of its links,
never all pairs; connected components then follow from the forests. Equal fingerprints count once throughout.

Cases: null and empty texts have fingerprint 0 and are linked like any other; texts of one or two words have one shingle;
repeated rows repeat; a null doc_id takes part, but is nobody's smallest doc_id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_rows, column_of, fresh, map_batches, settled, sized, table, widened
from .components import components

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Fingerprints of a tile, about, and of a block within it.
TILE, BLOCK = 32_768, 512


def fingerprint(text: str | None) -> int:
    import xxhash

    words = (text or "").encode().lower().split()  # on bytes, both know ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: -SHINGLE] + 1]).tolist()
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - SHINGLE + 1
    places = list(zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True))
    for k in range(0, n, 8192):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in places[k : k + 8192]], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with `fingerprint`, the 64 bits as a long."""
    kept = docs.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in column_of(batch, "text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "fingerprint"])

    return map_batches(kept, run, widened(kept, "fingerprint long"))


def _quarters(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _blocks(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """x sorted by its quarters' bit counts, in blocks, and each block's lowest and highest counts."""
    q = _quarters(x)
    order = np.lexsort(q.T[::-1])
    x, q = x[order], q[order]
    at = range(0, len(x), BLOCK)
    return [x[k : k + BLOCK] for k in at], np.array([q[k : k + BLOCK].min(0) for k in at]), np.array([q[k : k + BLOCK].max(0) for k in at])


def forest(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges that connect whatever links between a and b (or within a, if b is None) connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    left, lo, hi = _blocks(a)
    right, lo2, hi2 = (left, lo, hi) if b is None else _blocks(b)
    edges = []
    for i, x in enumerate(left):
        gap = np.maximum(0, np.maximum(lo2 - hi[i], lo[i] - hi2)).sum(1)
        for j in np.flatnonzero(gap <= radius).tolist():
            if b is None and j < i:
                continue
            close = np.bitwise_count(x[:, None] ^ right[j][None, :]) <= radius
            if b is None and j == i:
                close = np.triu(close, 1)
            if not close.any():
                continue
            # The smallest label reaches all that the block links, in as many rounds as its longest chain needs.
            labels, other, n = np.arange(len(x)), np.full(close.shape[1], len(x)), len(x)
            same = b is None and j == i
            while True:
                before = labels.sum(), other.sum()
                other = np.minimum(other, np.where(close, labels[:, None], n).min(0))
                labels = np.minimum(labels, np.where(close, other[None, :], n).min(1))
                if same:
                    labels = other = np.minimum(labels, other)
                if before == (labels.sum(), other.sum()):
                    break
            xs, ys = x.tolist(), right[j].tolist()
            touched = [(xs[k], xs[t]) for k, t in enumerate(labels.tolist()) if t < n and k != t] + [(ys[k], xs[t]) for k, t in enumerate(other.tolist()) if t < n and not (same and k == t)]
            for u, v in touched:
                if (p := root(u)) != (q := root(v)):
                    parent[p] = q
                    edges.append((u, v))
    return edges


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): forests that connect the fingerprints (column `fingerprint`, no repeats) as links of at most `radius` bits do."""
    low = F.bit_count(F.col("fingerprint").bitwiseAND(F.lit(0xFFFFFFFF)))
    halves = distinct.select("fingerprint", F.bit_count("fingerprint").alias("bits"), low.alias("low")).withColumn("high", F.col("bits") - F.col("low"))
    # At most 33 x 33 rows, whatever the input.
    sizes = halves.groupBy("high", "low").count().select("high", "low", F.ceil(F.col("count") / TILE).cast("int").alias("parts"))
    tiled = halves.join(F.broadcast(sizes), ["high", "low"]).withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    tiles = settled(tiled.groupBy("high", "low", "part").agg(F.collect_list("fingerprint").alias("prints")))
    names = sizes.select("high", "low", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    # Pairs of tiles, each once: the other tile is ahead by bits of the high half, or of the low half if those are equal.
    steps = [(h, k) for h in range(radius + 1) for k in range(h - radius, radius - h + 1) if h or k >= 0]
    ahead = names.withColumn("step", F.explode(F.array(*[F.struct(F.lit(h).alias("h"), F.lit(k).alias("k")) for h, k in steps])))
    ahead = ahead.select(F.struct("high", "low", "part").alias("a"), (F.col("high") + F.col("step.h")).alias("high"), (F.col("low") + F.col("step.k")).alias("low"))
    pairs = ahead.join(names, ["high", "low"]).select("a", F.struct("high", "low", "part").alias("b")).where("a.high < b.high or a.low < b.low or a.part <= b.part")
    named = tiles.select(F.struct("high", "low", "part").alias("name"), "prints")
    spark = distinct.sparkSession
    width = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    both = pairs.join(named.select(F.col("name").alias("a"), F.col("prints").alias("x")), "a").join(named.select(F.col("name").alias("b"), F.col("prints").alias("y")), "b")
    both = both.select("x", F.when(F.col("a") != F.col("b"), F.col("y")).alias("y"), F.xxhash64("a", "b").alias("deal")).repartition(width, "deal")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = (batch.column(c)[k] for c in (0, 1))
                as_array = lambda v: v.values.to_numpy().view(np.uint64)
                edges = np.array(forest(as_array(x), as_array(y) if y.is_valid else None, radius), np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0].copy()), pa.array(edges[:, 1].copy())], ["u", "v"])

    with batch_rows(spark, 64):
        return settled(both.mapInArrow(run, "u long, v long"))


def grouped(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, fingerprint, root, component_id) for each row of docs. root, a fingerprint, names the component;
    component_id is its smallest doc_id, which two components share where rows of different texts share a doc_id."""
    rows = docs.select("doc_id", "text", _text_hash().alias("text_hash"))
    rows = settled(fingerprints(rows).select("doc_id", "text_hash", "fingerprint"))
    distinct = settled(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    linked = components(links(distinct, radius)).select(F.col("node").alias("fingerprint"), "root")
    rooted = distinct.join(linked, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = rooted.select("fingerprint", "root").join(named, "root")
    return rows.join(of_print, "fingerprint").select("doc_id", "text_hash", "fingerprint", "root", "component_id")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs; component_id is the smallest doc_id of its component."""
    return grouped(docs, radius).select("doc_id", "fingerprint", "component_id")


def representatives(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of docs, unchanged, of each component: of its smallest doc_id, and where rows of that doc_id have several of
    the component's texts, the text of the smallest hash.

    Rows without a doc_id cannot stand for others and are kept. Rows that go are named by doc_id and hash of their text and taken
    out by an anti-join, so texts stay where they are when few rows go. Of repeated rows one stays; where they differ in other
    columns, any of them. Columns may have any names and types."""
    hashed, doc, of_hash = fresh(docs, "hash", "of_doc", "of_hash")
    found = grouped(docs, radius).where(F.col("doc_id").isNotNull())
    found = settled(found.groupBy("doc_id", "text_hash", "root", "component_id").agg(F.count(F.lit(1)).alias("n")))
    least = found.where(F.col("doc_id") == F.col("component_id")).groupBy("root", "component_id").agg(F.min("text_hash").alias("text_hash"))
    stays = least.select(F.col("component_id").alias("doc_id"), "text_hash")
    named = lambda df: settled(df.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(of_hash)))
    lost = named(found.join(stays, ["doc_id", "text_hash"], "left_anti"))
    repeated = sized(named(found.where("n > 1").join(stays, ["doc_id", "text_hash"], "left_semi")))
    on = (F.col("doc_id") == F.col(doc)) & (F.col(hashed) == F.col(of_hash))
    left = docs.withColumn(hashed, _text_hash()).join(sized(lost), on, "left_anti")
    once = left.join(repeated, on, "left_semi").dropDuplicates(["doc_id", hashed])
    return left.join(repeated, on, "left_anti").unionByName(once).drop(hashed)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op5_simhash": op5_simhash}
ORACLES: dict[str, str] = {}
