"""Small file-system helpers through the session's Hadoop configuration.

They work on any Hadoop-compatible store (HDFS, object stores) the cluster
is configured for, not just the local disk.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    try:
        jvm = spark.sparkContext._jvm
    except Exception as e:  # noqa: BLE001 - remote (Connect) sessions have no JVM handle
        raise RuntimeError("the candle store needs a classic Spark session (file-system access)") from e
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def has_data(spark: SparkSession, path: str) -> bool:
    """True when the folder holds at least one visible parquet file (any depth)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if name.endswith(".parquet") and not name.startswith((".", "_")):
            return True
    return False


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a top-level ``column=value`` partition folder, from the listing only."""
    prefix = f"{column}="
    return sorted(d[len(prefix):] for d in child_dirs(spark, path) if d.startswith(prefix))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def delete_if_empty(spark: SparkSession, path: str) -> bool:
    """Remove a folder that holds nothing; the file system refuses any other."""
    fs, p = _fs(spark, path)
    try:
        return bool(fs.delete(p, False))
    except Exception:  # noqa: BLE001 - not empty
        return False


def size_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under a path (0 when absent), from the file system's summary."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0
    return int(fs.getContentSummary(p).getLength())
