"""What the corpus operators share: reading tables, Arrow batches, lineage cuts and text columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that Spark hands to Python at once. Documents average a few kB, so a batch stays at a few MB.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds what a Python worker holds: Spark's default of 10,000 rows is too many for long texts. A smaller setting stays.

    The setting stays lowered, as plans that are returned run later."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it plans hand so many rows at once to Python; then the caller's setting holds again. Plans made here must run here."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """df.mapInArrow for columns of any names: Spark itself takes none with a dot or a backtick, so these go by other names inside."""
    small_batches(df.sparkSession)
    odd = [c for c in df.columns if "." in c or "`" in c]
    if not odd:
        return df.mapInArrow(fn, schema)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    inside = dict(zip(odd, fresh(df, *[f"odd_{k}" for k in range(len(odd))]), strict=True))
    fields = [T.StructField(inside.get(f.name, f.name), f.dataType, f.nullable) for f in schema]
    return df.toDF(*[inside.get(c, c) for c in df.columns]).mapInArrow(fn, T.StructType(fields)).toDF(*schema.names)


def widened(df: DataFrame, more: str) -> T.StructType:
    """df's schema and then the columns of a DDL string."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that df has no column of."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Whole texts; null is empty."""
    return ["" if x is None else x for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def flat_bytes(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and len + 1 offsets into them, without a copy; null is empty."""
    array = column_of(batch, column)
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: spark.checkpoint.dir, set to a temporary one only where it is unset on a local master (tests)."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: on a cluster it must name a folder that all hosts share")
        import tempfile

        found = tempfile.mkdtemp(prefix="loadweave-checkpoint-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(found)
    return found


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and written as a table in the shared folder, so lost executors cost no recomputation."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a few numbers each that may be broadcast: some 60 MB.
BROADCAST_ROWS = 1_000_000


def sized(df: DataFrame) -> DataFrame:
    """df, marked for broadcasting if it was counted to have at most BROADCAST_ROWS rows. For narrow rows only."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def discard(*frames: DataFrame) -> None:
    """Deletes the folders of settled() tables that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        for file in df.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file.rpartition("/")[0])
            if "/table-" in folder.toString():
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def held_out(parts: int, rest: int) -> Column:
    """crc32(doc_id as text) mod parts = rest; a null doc_id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == rest, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, at_most: int) -> DataFrame:
    """(doc_id, text, y, w) of labelled rows outside the held-out quarter, chosen by a hash of doc_id: about at_most / 2 with
    each label at most. w is how many labelled rows a row stands for.

    Whole rows are taken or left by the hash, so a run over the same tables learns from the same rows. The labels taken are
    few whatever the input's size, which is why they, not the texts, are sent around."""
    labels = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(4, 2)).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    share = F.lit(1.0)
    for y, n in labels.groupBy("y").count().collect():
        share = F.when(F.col("y") == y, F.lit(min(1.0, at_most / 2 / n))).otherwise(share)
    chosen = labels.withColumn("share", share).where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("share") * 1_000_000)
    return docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "y", (1 / F.col("share")).alias("w"))), "doc_id")
