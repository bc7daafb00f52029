"""Bronze ingest of feeds whose files change their columns (A3).

Every file is read by the names in its own header, so columns may come in any
order, be missing, or be new. Files are read with numbered columns; the first
row of each file is its header, found with a map-side partial aggregate (one row
per file), and joined back to the file's rows. Known columns are taken by name;
the rest goes, as name -> value, into a rescued-data map, so nothing that a
file holds is lost. Every set of unknown names is recorded once as a new version
of the feed's schema, with the file that brought it.

A batch is written under its own ``batch_id``, so a replay rewrites it.

Edge cases: a file without rows after its header adds none; names are trimmed
and compared without regard to case; of a name that a header holds twice the
first column counts, the others are rescued as ``name#2``, ..; a row with more
fields than its header keeps them in the map as ``#n``; an empty field is null
and is not rescued.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from paylake.session import fresh_dir
from paylake.sources.feeds import FeedConfig, admission
from paylake.sources.sinks import overwrite_partitions, read_or_empty

RESCUED = "_rescued_data"
MAX_FIELDS = 64
VERSIONS = "feed string, version int, added array<string>, columns array<string>, seen_in string, batch_id bigint"


def _names(fields: Column) -> Column:
    """A header's names: trimmed, lower case, later ones of a name numbered."""
    clean = F.transform(fields, lambda x, i: F.when(x.isNull() | (F.trim(x) == ""), F.concat(F.lit("#"), (i + 1).cast("string"))).otherwise(F.lower(F.trim(x))))
    earlier = lambda x, i: F.size(F.filter(F.slice(clean, F.lit(1), i), lambda y: y == x))
    return F.transform(clean, lambda x, i: F.when(earlier(x, i) == 0, x).otherwise(F.concat(x, F.lit("#"), (earlier(x, i) + 1).cast("string"))))


def by_header(batch: DataFrame, known: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows by name, headers) of a batch of numbered columns ``_0``, ``_1``, ..
    with ``source_path`` and ``_row``, which grows inside each file."""
    fields = F.array(*[F.col(c) for c in batch.columns if c[1:].isdigit()])
    rows = batch.select("source_path", "_row", fields.alias("fields"))
    headers = rows.groupBy("source_path").agg(F.min(F.struct("_row", "fields")).alias("h"))
    used = F.array_max(F.transform(F.col("h.fields"), lambda x, i: F.when(x.isNotNull(), i + 1).otherwise(0)))
    names = _names(F.slice("h.fields", F.lit(1), F.greatest(used, F.lit(1))))
    headers = headers.select("source_path", F.col("h._row").alias("_header_row"), names.alias("names"))
    met = rows.join(headers, "source_path").where(F.col("_row") != F.col("_header_row"))
    labels = F.transform("fields", lambda _, i: F.coalesce(F.get("names", i), F.concat(F.lit("#"), (i + 1).cast("string"))))
    met = met.withColumn("by_name", F.map_from_arrays(labels, "fields"))
    rest = F.map_filter("by_name", lambda k, v: v.isNotNull() & ~k.isin(*[c.lower() for c in known]))
    out = met.select(*[F.col("by_name")[c.lower()].alias(c) for c in known], F.when(F.size(rest) > 0, rest).alias(RESCUED),
                     F.element_at(F.split("source_path", "/"), -1).alias("source_file"))
    return out, headers


def schema_versions(spark: SparkSession, location: str) -> DataFrame:
    return read_or_empty(spark, location, T._parse_datatype_string(VERSIONS))


def _record(spark: SparkSession, location: str, feed: str, known: list[str], headers: DataFrame, batch_id: int) -> None:
    """A new schema version if the headers hold names no version has."""
    versions = schema_versions(spark, location).where((F.col("feed") == feed) & (F.col("batch_id") != batch_id))
    last = versions.orderBy(F.desc("version")).first()
    have = list(last["columns"]) if last else list(known)
    lower = [c.lower() for c in have]
    found = headers.select(F.explode("names").alias("name"), "source_path").where(~F.col("name").isin(lower) & ~F.startswith("name", F.lit("#")))
    fresh = found.groupBy("name").agg(F.min("source_path").alias("path")).orderBy("name").collect()  # as many rows as new columns
    rows = [] if last else [(feed, 0, [], list(known), None, batch_id)]
    if fresh:
        added = [r["name"] for r in fresh]
        rows.append((feed, last["version"] + 1 if last else 1, added, have + added, min(r["path"].rsplit("/", 1)[-1] for r in fresh), batch_id))
    if rows:
        overwrite_partitions(spark.createDataFrame(rows, VERSIONS).withColumn("batch", F.lit(batch_id)), location, ["batch"])


def start_bronze_by_name(spark: SparkSession, cfg: FeedConfig, checkpoint: str, known: list[str], max_bytes_per_trigger: int | None = None,
                         available_now: bool = True) -> StreamingQuery:
    """Stream a feed's files into its table by the names in their headers."""
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(MAX_FIELDS)])
    reader = spark.readStream.format(cfg.reader_format).schema(schema).option("sep", cfg.delimiter).option("header", "false")
    reader = admission(reader.option("multiLine", str(bool(cfg.multiline)).lower()).option("enforceSchema", "true"), max_bytes=max_bytes_per_trigger)
    source = reader.load(cfg.source_path)
    stream = source.select("*", F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("_block"))
    location = cfg.schema_location or f"{cfg.target_table}_schema"

    def write(batch: DataFrame, batch_id: int) -> None:
        place = F.struct(F.col("_block"), F.monotonically_increasing_id().alias("nth"))  # grows inside a split
        batch = batch.withColumn("_row", place).drop("_block").persist()
        try:
            rows, headers = by_header(batch, known)
            _record(batch.sparkSession, location, cfg.source_name, known, headers, batch_id)
            rows = rows.withColumn("ingestion_at", F.current_timestamp()).withColumn("batch_id", F.lit(batch_id))
            overwrite_partitions(rows, cfg.target_table, ["batch_id"])
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def ingest_by_name(spark: SparkSession, feed: str, cfg: FeedConfig, known: list[str], work: str | None = None, **admit) -> DataFrame:
    """Run the stream over what is there and read its table."""
    work = work or fresh_dir(spark, f"drift-{feed}")
    start_bronze_by_name(spark, cfg, f"{work}/_checkpoint", known, **admit).awaitTermination()
    return spark.read.parquet(cfg.target_table)
