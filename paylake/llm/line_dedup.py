"""Line dedup over content-defined chunks, with DataFrame functions only.

A document's lines are hashed; a hash rolled over each line and the one before
it makes a line a candidate when it is zero modulo ``mean_lines``. A chunk ends
after a candidate whose line before is none, so no chunk has one line only; a
boundary that would cut a single line off either end of a document is left out.
The boundaries depend on three lines only, so lines put in before a repeated
passage shift no boundary inside it. Of all chunks of two lines or more that
occur again later in the corpus (by doc_id, then place), every occurrence but
the first is removed: of an exact copy of a document nothing is left, unless it
is one line.

Chunks are first counted by a 64-bit hash (narrow rows, partial aggregates).
Only those whose hash repeats are read as text and grouped by the text itself,
which is the comparison of bytes: equal hashes of different texts never meet.
The first occurrence of each text is found with map-side partial aggregates and
stored, so that occurrences meet it in a join of two plain exchanges, which
adaptive execution splits when one passage holds a large share of the rows.

Edge cases: null or empty text is one empty line; a trailing line break ends in
an empty line; the last chunk of a document ends with it; rows that repeat a
doc_id and text are one document and get equal results (the same place occurs
once); extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import stored, text_or_empty

#: The rolling hash: a line's hash plus this times the one of the line before, modulo a prime.
_ROLL, _PRIME = 1_000_003, (1 << 31) - 1


def content_chunks(docs: DataFrame, mean_lines: int = 3) -> DataFrame:
    """doc_id, text_id, lines and ``chunks``: (start, n, body) of each chunk."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_id"), F.split("text", "\n", -1).alias("lines"))
    rows = rows.withColumn("h", F.transform("lines", lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long")))
    # looked up by place: arrays put side by side would be built anew for every document
    may = F.transform("h", lambda x, i: F.pmod(F.pmod(x + F.coalesce(F.get("h", i - 1), F.lit(0)) * _ROLL, F.lit(_PRIME)), F.lit(mean_lines)) == 0)
    rows = rows.withColumn("may", may)
    last = F.size("lines") - 1
    inner = F.when(last >= 3, F.filter(F.sequence(F.lit(1), last - 2), lambda i: F.get("may", i) & ~F.get("may", i - 1)))
    rows = rows.withColumn("ends", F.concat(F.coalesce(inner, F.expr("cast(array() as array<int>)")), F.array(last)))
    rows = rows.withColumn("starts", F.slice(F.concat(F.array(F.lit(0)), F.transform("ends", lambda e: e + 1)), F.lit(1), F.size("ends")))
    return rows.withColumn("chunks", F.zip_with("starts", "ends", lambda s, e: F.struct(
        s.alias("start"), (e - s + 1).alias("n"), F.array_join(F.slice("lines", s + 1, e - s + 1), "\n").alias("body")))).select(
        "doc_id", "text_id", "lines", "chunks")


def repeated_chunks(docs: DataFrame, mean_lines: int = 3, min_lines: int = 2) -> DataFrame:
    """(doc_id, text_id, start, n) of every chunk to remove."""
    # every document has a chunk; a plain explode would filter by the chunks' number first, and so compute them twice
    chunks = content_chunks(docs, mean_lines).select("doc_id", "text_id", F.explode_outer("chunks").alias("c")).where(F.col("c.n") >= min_lines)
    chunks = chunks.select("doc_id", "text_id", F.col("c.start").alias("start"), F.col("c.n").alias("n"), F.col("c.body").alias("body"))
    chunks = chunks.withColumn("key", F.xxhash64("body"))
    keys = stored(chunks.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key"), "chunk-keys")
    found = stored(chunks.join(keys.hint("merge"), "key", "left_semi"), "chunks")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "start"))
    firsts = stored(found.groupBy("key", "body").agg(first.alias("first"), F.count("*").alias("times")).where("times > 1"), "chunk-firsts")
    later = ~(found["doc_id"].eqNullSafe(F.col("first.doc_id")) & (found["start"] == F.col("first.start")))
    return found.join(firsts.hint("merge"), ["key", "body"]).where(later).select("doc_id", "text_id", "start", "n")


def line_dedup(docs: DataFrame, mean_lines: int = 3, min_lines: int = 2, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, kept_sha256 (kept
    lines joined by line breaks), removed ("start:lines" of each removed chunk,
    comma-joined) and, with ``with_text``, kept_text."""
    gone = repeated_chunks(docs, mean_lines, min_lines).distinct().groupBy("doc_id", "text_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "n"))).alias("gone"))
    gone = gone.select(F.col("doc_id").alias("gone_doc"), F.col("text_id").alias("gone_text"), "gone")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("text_id", F.xxhash64("text"))
    rows = rows.join(gone.hint("merge"), rows["doc_id"].eqNullSafe(F.col("gone_doc")) & (F.col("text_id") == F.col("gone_text")), "left")
    rows = rows.withColumn("lines", F.split("text", "\n", -1))
    none = F.expr("cast(array() as array<struct<start:int,n:int>>)")
    rows = rows.withColumn("gone", F.coalesce("gone", none))
    # kept stretches lie between one removed chunk's end and the next one's start
    ends = F.concat(F.array(F.lit(0)), F.transform("gone", lambda g: g["start"] + g["n"]))
    starts = F.concat(F.transform("gone", lambda g: g["start"]), F.array(F.size("lines")))
    rows = rows.withColumn("from", ends).withColumn("to", starts)
    rows = rows.withColumn("kept", F.flatten(F.zip_with("from", "to", lambda a, b: F.slice("lines", a + 1, b - a))))
    kept = F.array_join("kept", "\n")
    out = rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
                      F.sha2(kept, 256).alias("kept_sha256"),
                      F.array_join(F.transform("gone", lambda g: F.concat_ws(":", g["start"].cast("string"), g["n"].cast("string"))), ",").alias("removed"),
                      kept.alias("kept_text"))
    return out if with_text else out.drop("kept_text")
