"""Files through Hadoop's file systems, so that paths of any store work, from the driver. Only names and few files pass here, never tables."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it does not exist."""
    p, fs = _path(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file; one that has the target's name already is replaced."""
    a, fs = _path(spark, source)
    b, _ = _path(spark, target)
    fs.mkdirs(b.getParent())
    if fs.exists(b):
        fs.delete(b, False)
    if not fs.rename(a, b):
        raise OSError(f"cannot rename {source} to {target}")


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copies a file or a folder, between stores too."""
    a, from_fs = _path(spark, source)
    b, to_fs = _path(spark, target)
    if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, a, to_fs, b, False, spark._jsc.hadoopConfiguration()):
        raise OSError(f"cannot copy {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
