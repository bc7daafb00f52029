"""Batch scans of the base tables.

Every read goes through ``spark.read.parquet`` so Catalyst can prune columns
and push filters into the scan; nothing is cached or collected here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(root, name))


def stored_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change in ms) of the files under ``path``, from the
    store's own listing: no job, no row is read."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found, folders = [], [root]
    while folders:
        for status in fs.listStatus(folders.pop()):
            name = status.getPath().getName()
            if status.isDirectory():
                folders.append(status.getPath())
            elif not name.startswith(("_", ".")):
                found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def stored_bytes(spark: SparkSession, path: str) -> int:
    return sum(size for _, size, _ in stored_files(spark, path))
