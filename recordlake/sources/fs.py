"""File-system probes through the session's Hadoop configuration (any scheme Spark reads:
``file:``, ``hdfs:``, object stores). Metadata only: existence and directory listings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(sc._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty when ``path`` is missing)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def delete(spark: SparkSession, path: str) -> None:
    """Remove ``path`` recursively (no error when it is missing)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the plain files directly under ``path`` (empty when missing)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isFile()]


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a Hadoop glob (one listing; empty when nothing matches)."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return sorted(st.getPath().toString() for st in found) if found is not None else []
