"""Repeated 100-byte strings by distributed prefix doubling over every position.

op3's query thins positions to anchors first (suffixdedup.py). This is the method without that: it gives the same ranges, at
a cost that README states as measured, and tests hold one against the other.

* A position starts as the pair of its first 8 and next 8 bytes, which are numbers in the order of the bytes.
* Spark sorts positions by their pairs. The new rank is the place where a pair's run starts in that order, so ranks keep
  the order of the strings, and equal ranks mean equal bytes: no fingerprints are involved.
* A position whose pair is unique leaves: no longer string from there repeats. It is the missing partner that makes others
  unique too.
* Pairs at offsets 16, 32 and last 36 double ranks of 16 bytes to 32, 64 and then 100, the threshold.

Every round is a table in the shared folder, so lost executors cost no earlier round. Positions meet their partners by blocks
of a document, so no task holds a whole one; a rank that a third of all positions share is one sorted run, which spills.

Cases: null and empty texts have no bytes; texts under 100 bytes lose nothing; of rows that share a doc_id only places count,
so equal rows do not make each other's strings repeats; a null doc_id counts as smallest; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column_of, discard, flat_bytes, map_batches, settled
from .suffixdedup import FIRST, LENGTH

#: Bytes of the first ranks, half of them in each number of the pair.
START = 16
#: Positions of a document that meet their partners together, and that a task packs at once.
BLOCK = 1 << 16
_HALF = START // 2


def _numbers(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place as a signed number of the same order."""
    windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, _HALF))
    return (windows.view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def _positions(docs: DataFrame) -> DataFrame:
    """(doc, copy, at, rank, next) of every position that 16 bytes start at, in texts of at least 100. copy tells rows of a doc_id apart."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("doc"), "text").where(F.octet_length("text") >= LENGTH)
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc").orderBy("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch)
            keys = zip(column_of(batch, "doc").to_pylist(), column_of(batch, "copy").to_pylist(), strict=True)
            for k, (doc, copy) in enumerate(keys):
                text = data[offsets[k] : offsets[k + 1]]
                for start in range(0, len(text) - START + 1, BLOCK):
                    numbers = _numbers(text[start : start + BLOCK + START - 1])
                    n = len(numbers) - _HALF
                    arrays = [np.full(n, doc), np.full(n, copy, np.int32), np.arange(start, start + n), numbers[:n], numbers[_HALF:]]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["doc", "copy", "at", "rank", "next"])

    return map_batches(rows.select("doc", "copy", "text"), run, "doc long, copy int, at long, rank long, next long")


def _ranked(pairs: DataFrame) -> DataFrame:
    """(doc, copy, at, rank): pairs in order, each named by where its run starts; unique ones leave."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = pairs.repartitionByRange(parts, "rank", "next").sortWithinPartitions("rank", "next")
    same = Window.partitionBy("rank", "next")
    named = order.withColumn("place", F.monotonically_increasing_id())
    named = named.select("doc", "copy", "at", F.min("place").over(same).alias("name"), F.count(F.lit(1)).over(same).alias("n"))
    return named.where("n > 1").select("doc", "copy", "at", F.col("name").alias("rank"))


def _paired(ranked: DataFrame, offset: int) -> DataFrame:
    """Each position with the rank at the offset from it; positions without one are unique and leave."""
    block = F.floor(F.col("at") / BLOCK)
    # The positions at a block's start are partners of the block before too.
    near = (F.col("at") % BLOCK < offset) & (block > 0)
    rows = ranked.withColumn("block", F.explode(F.when(near, F.array(block, block - 1)).otherwise(F.array(block))))
    ahead = Window.partitionBy("doc", "copy", "block").orderBy("at").rangeBetween(offset, offset)
    return rows.withColumn("next", F.first("rank").over(ahead)).where(F.col("next").isNotNull() & (F.col("block") == block)).drop("block")


def ranks(docs: DataFrame) -> DataFrame:
    """(doc, copy, at, rank) of all positions whose 100 bytes also start elsewhere; equal rank, equal bytes."""
    found = settled(_ranked(_positions(docs)))
    length = START
    while length < LENGTH:
        offset = min(length, LENGTH - length)
        longer = settled(_ranked(_paired(found, offset)))
        discard(found)
        found, length = longer, length + offset
    return found


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_removed, n_spans) of each row with repeats: bytes in strings that start earlier too, and their maximal runs."""
    found = ranks(docs)
    place = F.struct("doc", "at")
    again = place > F.min(place).over(Window.partitionBy("rank"))
    repeated = found.select("doc", "copy", "at", again.alias("again")).where("again")
    text = Window.partitionBy("doc", "copy").orderBy("at")
    lengths = F.least(F.lit(LENGTH), F.coalesce(F.lead("at").over(text) - F.col("at"), F.lit(LENGTH)))
    starts = F.coalesce(F.col("at") - F.lag("at").over(text) > LENGTH, F.lit(True))
    runs = repeated.select("doc", "copy", lengths.alias("length"), starts.cast("long").alias("starts"))
    out = runs.groupBy("doc", "copy").agg(F.sum("length").cast("long").alias("n_removed"), F.sum("starts").alias("n_spans"))
    return out.select(F.when(F.col("doc") != FIRST, F.col("doc")).alias("doc_id"), "n_removed", "n_spans")
