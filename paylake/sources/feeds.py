"""Delimited payment feeds: configuration, schemas, readers and landing (A1-A4).

A feed is described by one config record (``source_name, active,
target_table, partition_by, file_format, schema_location, delimiter, header,
multiline, source_path``). Configs are read with Spark from a JSON file, so
the path may be on any shared file system.

Open-source file streams need a schema up front, so every feed has an
explicit all-string schema (A3); rows that do not fit keep their text in
``_corrupt_record``.
"""

from __future__ import annotations

import dataclasses

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.operators.clean import MERCHANT_COLUMNS, TRANSACTION_COLUMNS, USER_COLUMNS

CORRUPT_COLUMN = "_corrupt_record"
FEED_COLUMNS = {
    "transactions": TRANSACTION_COLUMNS,
    "users": USER_COLUMNS,
    "merchants": MERCHANT_COLUMNS,
}


@dataclasses.dataclass(frozen=True)
class FeedConfig:
    source_name: str
    active: bool
    target_table: str
    partition_by: str | None
    file_format: str
    schema_location: str | None
    delimiter: str
    header: bool
    multiline: bool
    source_path: str

    @property
    def reader_format(self) -> str:
        """``text`` feeds are delimited text, read as CSV."""
        return "csv" if self.file_format == "text" else self.file_format


def load_feed_config(spark: SparkSession, path: str, source_name: str) -> FeedConfig | None:
    """First active record for ``source_name`` (A1).

    Returns ``None`` for a known but inactive feed (the caller skips it) and
    raises for a name that has no record at all (S18).
    """
    configs = spark.read.option("multiLine", True).json(path)
    named = configs.where(F.col("source_name") == source_name)
    row = named.where(F.col("active")).limit(1).collect()
    if row:
        rec = row[0].asDict()
        fields = {f.name for f in dataclasses.fields(FeedConfig)}
        return FeedConfig(**{k: rec.get(k) for k in fields})
    if named.limit(1).count() == 0:
        raise KeyError(f"no feed config named {source_name!r}")
    return None


def feed_schema(feed: str, extra: tuple[str, ...] = ()) -> T.StructType:
    cols = [*FEED_COLUMNS[feed], *extra]
    return T.StructType([T.StructField(c, T.StringType()) for c in cols]
                        + [T.StructField(CORRUPT_COLUMN, T.StringType())])


def _reader(spark_reader, cfg: FeedConfig, schema: T.StructType):
    return (spark_reader.format(cfg.reader_format)
            .schema(schema)
            .option("sep", cfg.delimiter)
            .option("header", str(bool(cfg.header)).lower())
            .option("multiLine", str(bool(cfg.multiline)).lower())
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN))


def with_lineage(df: DataFrame) -> DataFrame:
    """Ingestion time and source file name (A4)."""
    return (df.withColumn("ingestion_at", F.current_timestamp())
            .withColumn("source_file", F.col("_metadata.file_name")))


def admission(reader, max_files: int | None = None, max_bytes: int | None = None):
    """Bound a micro-batch by files or by bytes."""
    if max_bytes:
        return reader.option("maxBytesPerTrigger", max_bytes)
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def read_feed_stream(spark: SparkSession, cfg: FeedConfig, schema: T.StructType, max_files_per_trigger: int | None = None,
                     max_bytes_per_trigger: int | None = None, archive: str | None = None) -> DataFrame:
    """Incremental read of new files only (A2, G8); the checkpoint remembers
    which files were taken. With ``archive`` the files of committed batches are
    moved there, so that listing the source does not take longer for ever."""
    r = admission(_reader(spark.readStream, cfg, schema), max_files_per_trigger, max_bytes_per_trigger)
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return with_lineage(r.load(cfg.source_path))


def land_files(df: DataFrame, path: str, split_by, files: int, delimiter: str = "|") -> None:
    """Write a feed as ``files`` delimited files with header, one per value of
    ``split_by`` (an integer Column in ``[0, files)``): test landing (FIXTURES §5).

    The split value is the number of the task, so each becomes exactly one
    file; nothing is sampled or sorted for it.
    """
    cols = df.columns
    (df.withColumn("_split", split_by.cast("int"))
     .repartitionById(files, F.col("_split"))
     .select(*cols)
     .write.mode("append")
     .option("sep", delimiter).option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))


def land_turns(df: DataFrame, path: str, turn, turns: int, delimiter: str = "|") -> None:
    """Write a feed as packed delimited files with header in ``turns`` turns, the
    rows of each value of ``turn`` (an integer Column in ``[0, turns)``) after
    those of the one before. The tasks that read the feed write it: no row moves."""
    for k in range(turns):
        (df.where(turn == k)
         .write.mode("append")
         .option("sep", delimiter).option("header", "true").option("compression", "gzip")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .csv(path))


def remembered_schema(spark: SparkSession, cfg: FeedConfig) -> T.StructType:
    """Feed schema kept at ``cfg.schema_location`` (A3).

    The first run takes the column names from the landed files' header (every
    column as text, no type inference) and stores the schema as JSON; later
    runs, streaming ones included, reuse the stored schema so a new file
    cannot silently change it.
    """
    import json

    if cfg.schema_location:
        try:
            text = spark.read.text(cfg.schema_location).first()
        except AnalysisException as e:  # nothing stored yet; any other failure is an error
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            text = None
        if text is not None:
            return T.StructType.fromJson(json.loads(text[0]))
    header = (spark.read.option("sep", cfg.delimiter).option("header", "true")
              .option("multiLine", str(bool(cfg.multiline)).lower()).csv(cfg.source_path).schema)
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in header]
                          + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    if cfg.schema_location:
        (spark.createDataFrame([(schema.json(),)], "s string").coalesce(1)
         .write.mode("overwrite").text(cfg.schema_location))
    return schema
