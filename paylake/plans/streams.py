"""End-to-end stream runs: land files -> bronze -> silver.

Used by the registered streaming queries and the tests. Each run gets its own
folder under the shared work folder, so runs never collide and nothing is
deleted.
"""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.sources.feeds import FEED_COLUMNS, FeedConfig, land_files, land_turns, load_feed_config
from paylake.sources.tables import stored_bytes
from paylake.streaming.ingest import read_table_stream, start_bronze
from paylake.streaming.silver import SilverTarget, start_silver
from paylake.streaming.state import buckets_for

DELIMITER = "|"


def feed_config(feed: str, landing: str, bronze: str, partition_by: str | None = None) -> FeedConfig:
    return FeedConfig(source_name=feed, active=True, target_table=bronze, partition_by=partition_by,
                      file_format="text", schema_location=None, delimiter=DELIMITER, header=True,
                      multiline=False, source_path=landing)


def as_landed(raw: DataFrame, feed: str) -> DataFrame:
    """Raw feed as text columns in feed-schema order; the fixture's sequence
    travels as a trailing ``seq`` column."""
    if "ingestion_at" in raw.columns:
        raw = raw.withColumn("seq", F.date_format("ingestion_at", "yyyy-MM-dd HH:mm:ss")).drop("ingestion_at")
    cols = [*FEED_COLUMNS[feed], "seq"]
    return raw.select(*[F.col(c).cast("string").alias(c) for c in cols])


def land(raw: DataFrame, feed: str, landing: str, files: int, split_by: Column | None = None,
         order: list[Column] | None = None) -> None:
    """Write the feed as delimited files; with ``order``, the rows of each
    condition are landed in turn (later files arrive later). By default rows
    are spread by a hash of all their columns, so a key's changes fall into
    different files, and so into different batches. A feed of many files is
    landed in as many turns as there are batches, each written by the tasks that
    read the feed; one of few files is dealt by file."""
    in_turns = split_by is None and files > BATCHES and feed_bytes(raw) > BATCHES * LANDING_FILE_BYTES
    for cond in (order or [F.lit(True)]):
        landed = as_landed(raw.where(cond), feed)
        spread = F.crc32(F.concat_ws("|", *landed.columns))
        if in_turns:
            land_turns(landed, landing, F.pmod(spread, F.lit(BATCHES)), BATCHES, DELIMITER)
        else:
            land_files(landed, landing, F.pmod(spread, F.lit(files)) if split_by is None else split_by, files, DELIMITER)


def ingest(spark: SparkSession, feed: str, landing: str, work: str, partition_by: str | None = None, **admit) -> FeedConfig:
    """Stream landed files into bronze; by default in batches of :func:`batch_bytes`."""
    cfg = feed_config(feed, landing, f"{work}/bronze/{feed}", partition_by)
    q = start_bronze(spark, cfg, f"{work}/_checkpoints/bronze_{feed}", extra_columns=("seq",),
                     **(admit or {"max_bytes_per_trigger": batch_bytes(spark, landing)}))
    q.awaitTermination()
    return cfg


def silver(spark: SparkSession, feed: str, bronze_path: str, work: str, sequence_by: str = "seq",
           sequence_type: str | None = None, run_log_path: str | None = None, whole: bool = False, **kw) -> SilverTarget:
    """Keep silver up from the bronze table, in batches of :func:`batch_bytes` (or the ``whole`` table in one)."""
    if kw.get("keep_state"):
        kw.setdefault("state_buckets", buckets_for(stored_bytes(spark, bronze_path)))
    target = SilverTarget(feed=feed, root=f"{work}/silver/{feed}", quarantine_path=f"{work}/silver/quarantine",
                          sequence_by=sequence_by, sequence_type=sequence_type, run_log_path=run_log_path,
                          source_table=f"bronze.{feed}", **kw)
    stream = read_table_stream(spark, bronze_path, max_bytes_per_trigger=None if whole else batch_bytes(spark, bronze_path))
    q = start_silver(stream, target, f"{work}/_checkpoints/silver_{feed}")
    q.awaitTermination()
    return target


SEQUENCE_TYPES = {"transactions": "timestamp_ntz", "users": "int", "merchants": "int"}


def land_and_ingest(spark: SparkSession, raw: DataFrame, feed: str, work: str, files: int | None = None,
                    order: list[Column] | None = None, partition_by: str | None = None) -> FeedConfig:
    """Land ``raw`` as delimited files and stream them into a bronze table."""
    files = files or landing_files(raw)
    landing = f"{work}/landing/{feed}"
    land(raw, feed, landing, files, order=order)
    return ingest(spark, feed, landing, work, partition_by)


LANDING_FILE_BYTES = 64 << 20
BATCHES = 4
LARGEST_BATCH_BYTES = 16 << 30


def feed_bytes(raw: DataFrame) -> int:
    """Bytes of the stored feed that ``raw`` reads."""
    spark = raw.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in raw.inputFiles()}
    return sum(stored_bytes(spark, f) for f in folders)


def landing_files(raw: DataFrame) -> int:
    """Files by the size of the stored feed, and enough for several batches."""
    return max(4, feed_bytes(raw) // LANDING_FILE_BYTES)


def batch_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a micro-batch: a quarter of what waits, within a bound that a
    cluster's batch shall not exceed."""
    return max(1, min(-(-stored_bytes(spark, path) // BATCHES), LARGEST_BATCH_BYTES))


def run_feed(spark: SparkSession, raw: DataFrame, feed: str, work: str, files: int | None = None,
             order: list[Column] | None = None, partition_by: str | None = None,
             run_log_path: str | None = None, **options) -> SilverTarget:
    """Land ``raw`` as files, stream it through bronze and silver."""
    cfg = land_and_ingest(spark, raw, feed, work, files, order, partition_by)
    return silver(spark, feed, cfg.target_table, work, "seq", SEQUENCE_TYPES[feed], run_log_path, **options)


def write_config(spark: SparkSession, work: str, feeds: dict[str, tuple[str | None, bool]], active) -> str:
    """A feed config in the shared folder: feed -> (partition column, multiline)."""
    rows = [dataclasses.asdict(dataclasses.replace(
        feed_config(feed, f"{work}/landing/{feed}", f"{work}/bronze/{feed}", column),
        active=feed in active, multiline=multiline, schema_location=f"{work}/schema/{feed}"))
        for feed, (column, multiline) in feeds.items()]
    path = f"{work}/config"
    spark.createDataFrame([(json.dumps(rows),)], "s string").coalesce(1).write.text(path)
    return path


def run_ingest(spark: SparkSession, config_path: str, work: str, feeds=tuple(FEED_COLUMNS)) -> dict[str, FeedConfig]:
    """Ingest every feed that the config lists as active (A1-A5): looked up,
    read with its remembered schema, appended to its target table."""
    done = {}
    for feed in feeds:
        cfg = load_feed_config(spark, config_path, feed)
        if cfg is None:
            continue
        start_bronze(spark, cfg, f"{work}/_checkpoints/bronze_{feed}").awaitTermination()
        done[feed] = cfg
    return done
