"""Table sinks on shared storage.

Only plain Parquet and Spark's own writers are used: dynamic
partition overwrite (so a replayed micro-batch rewrites exactly the
partitions it owns), and versioned directories with an append-only manifest
as the commit point of a refresh.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Codec of the tables that rows pass through on their way to a mart.
CODEC = "zstd"


def overwrite_partitions(df: DataFrame, path: str, partition_by) -> None:
    """Replace only the partitions present in ``df`` (idempotent per batch)."""
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", CODEC)
     .partitionBy(*partition_by)
     .parquet(path))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a Parquet table, or an empty frame if nothing was written yet. Any
    other failure of the storage is an error."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


MANIFEST_SCHEMA = T.StructType([
    T.StructField("mart", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("refreshed_at", T.TimestampType()),
])


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/_manifest", MANIFEST_SCHEMA)


def current_versions(spark: SparkSession, root: str) -> DataFrame:
    """Newest committed version per mart; of a version committed twice the later one."""
    m = manifest(spark, root)
    return (m.groupBy("mart")
            .agg(F.max_by(F.struct("version", "row_count", "path"), F.struct("version", "refreshed_at", "path")).alias("v"))
            .select("mart", "v.*"))


def next_version(spark: SparkSession, root: str, mart: str) -> int:
    row = manifest(spark, root).where(F.col("mart") == mart).agg(F.max("version")).first()
    return 0 if row[0] is None else row[0] + 1


def version_path(root: str, mart: str, version: int) -> str:
    """A folder of its own for every attempt, so that a refresh that failed
    before its commit can be run again."""
    return f"{root}/{mart}/v{version:06d}-{uuid.uuid4().hex[:8]}"


def commit_versions(spark: SparkSession, root: str, written: dict[str, tuple[int, str]]) -> None:
    """Commit already written versions ``{mart: (version, path)}`` with one
    manifest append (a single job, so no two commits race on the folder)."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(mart, version, spark.read.parquet(path).count(), path, now)  # footer metadata only
            for mart, (version, path) in written.items()]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_manifest")



def read_current(spark: SparkSession, root: str, mart: str) -> DataFrame:
    row = current_versions(spark, root).where(F.col("mart") == mart).first()
    if row is None:
        raise KeyError(f"mart {mart!r} has not been refreshed")
    return spark.read.parquet(row["path"])


# Published silver layouts (A7, A8): the SCD1 table by transaction date, the
# SCD2 tables by country, so readers that filter on them prune partitions.
SILVER_LAYOUT = {
    "transactions": "transaction_date",
    "users": "country",
    "merchants": "country",
}


def publish_partitioned(df: DataFrame, path: str, column: str) -> None:
    """Overwrite ``path`` partitioned by ``column``.

    The ``rebalance`` hint shuffles rows by the partition value so a folder
    gets a few large files instead of one per input task, and lets AQE split a
    hot value (one country holding most users) over several writer tasks
    instead of one.
    """
    (df.hint("rebalance", column)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "static")  # the whole table, whatever the session says
     .partitionBy(column)
     .parquet(path))


def write_concurrently(jobs: dict[str, tuple[DataFrame, str]]) -> None:
    """Run independent table writes as concurrent Spark jobs.

    The three feeds' tables do not depend on one another; submitting them
    from separate driver threads lets small jobs (the SCD2 tables) use the
    cores a large one (the SCD1 table) leaves idle between its stages.
    """
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(df.write.parquet, path) for df, path in jobs.values()]
        for f in futures:
            f.result()
