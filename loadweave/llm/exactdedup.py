"""Exact duplicates, native: heavy hitters leave before the shuffle, everything else is grouped by an ordinary one.

A slim table (doc_id, digest, row number) is written once. Spark's frequent-items sketch, a Misra-Gries summary (counters that
are decremented together when they run out), finds digests that may be frequent, in two levels of merging. Their sizes and
winners are then counted exactly, and these verified rows (at most as many as the sketch tracks) are broadcast, so rows of
heavy digests are settled where they are read. Rows of other digests are shuffled by digest; no such group is larger than a
small share of a partition, since the sketch reports all that are.

Texts are equal when their SHA-256 is. A null text is empty. Of equal texts the row with the largest doc_id stays; a null
doc_id is smaller than any other, and of rows with one doc_id and one text exactly one stays. An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, settled, sized, table

#: Digests that the sketch tracks: at least so many, and so many for each shuffle partition, and at most so many.
TRACKED_LEAST, TRACKED_A_PARTITION, TRACKED_MOST = 4096, 8, 65_536
#: Sketches are merged in so many groups before the groups are.
MERGE_GROUPS = 64


def digest_of(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes; null is empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def tracked(spark: SparkSession) -> int:
    return min(TRACKED_MOST, max(TRACKED_LEAST, TRACKED_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def frequent(hashes: DataFrame, h: str, at_most: int) -> DataFrame:
    """(item): every value of column h that more than about 7 / (4 / 3 at_most) of the rows have, and perhaps others; at most
    `at_most` rows. A value is only a candidate: how often it really occurs is for the caller to count."""
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("part")
    parts = hashes.groupBy(part).agg(F.expr(f"approx_top_k_accumulate(`{h}`, {at_most})").alias("sketch"))
    # Grouped by a constant, so that a table without rows gives no sketch; combining none is an error in Spark.
    merged = parts.groupBy(F.lit("all").alias("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {at_most}), {at_most})").alias("found"))
    return merged.select(F.explode("found").alias("x")).where("x.count > 1").select("x.item")


def heavy_groups(rows: DataFrame, at_most: int) -> DataFrame:
    """(digest, group_size, best) of frequent digests, counted exactly. best: the row that stays, (doc_id, row_no)."""
    hashed = rows.withColumn("h", F.xxhash64("digest"))
    candidates = hashed.join(F.broadcast(frequent(hashed, "h", at_most)), F.col("h") == F.col("item"), "left_semi")
    groups = candidates.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row_no")).alias("best"))
    return settled(groups.where("group_size > 1"))


def classes(docs: DataFrame) -> DataFrame:
    """A row for each row of docs (doc_id, text, any others): doc_id, digest, keep_id, group_size, kept."""
    rows = docs.select("doc_id", digest_of(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row_no"))
    rows = settled(rows)
    heavy = F.broadcast(heavy_groups(rows, tracked(docs.sparkSession)))
    whole = Window.partitionBy("digest")
    light = rows.join(heavy, "digest", "left_anti").withColumns({"group_size": F.count(F.lit(1)).over(whole), "best": F.max(F.struct("doc_id", "row_no")).over(whole)})
    every = rows.join(heavy, "digest").unionByName(light)
    return every.select("doc_id", "digest", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row_no") == F.col("best.row_no")).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts, all columns as they were.

    Rows that go are named by digest and doc_id and taken out by an anti-join, so that texts stay where they are when few rows
    go. Rows that share the winner's doc_id too are then made one; where they differ in other columns, any of them stays."""
    digest, other, doc = fresh(docs, "digest", "lost_digest", "lost_doc")
    found = settled(classes(docs))
    named = lambda df: df.select(F.col("digest").alias(other), F.col("doc_id").alias(doc))
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    lost = named(found.where(~same)).distinct()
    repeated = named(found.where(same).groupBy("digest", "doc_id").count().where("count > 1"))
    on = (F.col(digest) == F.col(other)) & F.col("doc_id").eqNullSafe(F.col(doc))
    left = docs.withColumn(digest, digest_of(F.col("text"))).join(sized(lost), on, "left_anti")
    repeated = sized(repeated)
    once = left.join(repeated, on, "left_semi").dropDuplicates(["doc_id", digest])
    return left.join(repeated, on, "left_anti").unionByName(once).drop(digest)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW same AS (PARTITION BY t)
"""

QUERIES = {"op12_exact_dedup": op12_exact_dedup}
ORACLES = {"op12_exact_dedup": ORACLE}
