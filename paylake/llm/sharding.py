"""Sharding by proportional stratified interleaving, DataFrame functions only.

Rows of a source are shuffled by a seeded hash and ranked; rank r of n becomes
the fractional rank (r + offset) / n, with a seeded offset per source, and all
rows in order of that fraction are cut into equal shards. So every stretch of
the order, and every shard, holds each source in its share of the corpus, and
shards differ by one row at most.

Both ranks are distributed: rows are counted per hash range (of a source) or
per range of the fraction, the small counts are summed up in order, and a
window numbers rows inside one range only. A source that holds a third of all
rows is spread over as many ranges as its size asks for.

Edge cases: null text has size 1 and CRC 0; a null source is a source of its
own; rows without doc_id, or with the same one, are told apart by text CRC and
size (rows equal in all of that are interchangeable); fewer rows than shards
leave shards empty; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import partitions, stored, text_or_empty

_HASH_BITS = 60


def _hash60(*parts: Column) -> Column:
    """60 bits of MD5 as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def _ranked(rows: DataFrame, group: list[str], ranges: Column, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``, the 0-based rank within ``group`` by ``order``,
    and ``name_n``, the rows of the group; ``ranges`` rises with the order."""
    rows = rows.withColumn("range", ranges)
    counts = rows.groupBy(*group, "range").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select(*group, "range", (F.sum("n").over(upto) - F.col("n")).alias("before"),
                           F.sum("n").over(Window.partitionBy(*group)).alias(f"{name}_n"))
    inside = Window.partitionBy(*group, "range").orderBy(*order)
    return rows.join(starts, [*group, "range"]).withColumn(name, F.row_number().over(inside) - 1 + F.col("before")).drop("range", "before")


def interleave_shards(docs: DataFrame, shards: int = 16, seed: int = 42, range_rows: int = 50_000) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot,
    grown_shard (null under the law of rows)."""
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source").cast("string"))).alias("stratum"),
        _hash60(F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("u"))
    rows = stored(rows, "shard-rows")
    total = rows.count()
    ranges = max(partitions(docs.sparkSession), -(-total // range_rows))
    by_hash = F.shiftright(F.shiftright("u", _HASH_BITS // 2) * F.lit(ranges), _HASH_BITS // 2)
    ranked = _ranked(rows, ["stratum"], by_hash, ["u", "doc_id", "text_crc32", "size"], "rank")
    offset = _hash60(F.lit(str(seed)), F.col("stratum")).cast("double") / F.lit(float(1 << _HASH_BITS))
    ranked = stored(ranked.withColumn("fraction", (F.col("rank").cast("double") + offset) / F.col("rank_n").cast("double")), "shard-ranks")
    by_fraction = F.least(F.floor(F.col("fraction") * F.lit(float(ranges))), F.lit(ranges - 1).cast("long"))
    placed = _ranked(ranked.withColumn("all", F.lit(0)), ["all"], by_fraction, ["fraction", "stratum", "u", "doc_id", "text_crc32", "size"], "place")
    n, k = F.lit(total).cast("long"), F.lit(shards).cast("long")
    shard = F.expr(f"(place * {shards}L) div {max(total, 1)}L")
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("place") - F.floor((F.col("shard") * n + k - 1) / k)).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
