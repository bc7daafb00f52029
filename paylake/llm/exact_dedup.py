"""Exact dedup by progressive refinement, with DataFrame functions only.

Documents are grouped by length, the groups of several by the hash of a prefix
too, and what is left by the SHA-256 of the whole text. Each step works on the
narrow rows (doc_id, length, prefix hash) that are stored once; the full hash
is taken only of documents whose length and prefix are shared, unless the
caller wants it for all. Groups are counted straight from stored rows, with
map-side partial aggregates, so a group that holds a third of all rows costs
one row per task; rows meet their group's stored result in joins of two plain
exchanges, which adaptive execution splits when skewed.

Texts are equal when identical after every run of white space (space and
0x09-0x0D) became one space. Edge cases: null text counts as empty; rows
without doc_id stay only if nothing else in their group does; of rows that
repeat both doc_id and text one is kept; an empty table gives an empty result;
extra columns are ignored (and kept by ``drop_exact_copies``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import stored, text_or_empty

_KEY = ["length", "prefix"]


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(column), "[\\x20\\x09-\\x0D]+", " ")


def _keyed(docs: DataFrame, prefix_chars: int) -> DataFrame:
    norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("norm"))
    return norm.select("doc_id", "norm", F.length("norm").alias("length"), F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix"))


def exact_dedup(docs: DataFrame, prefix_chars: int = 256, hash_all: bool = False, broadcast_groups: int = 100_000) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Without ``hash_all`` text_sha256 is null where length and prefix already
    show that the text is unique. ``broadcast_groups`` bounds the list of
    shared (length, prefix) pairs that may be broadcast to the second scan;
    a longer one is joined on narrow rows that were hashed before.
    """
    keyed = _keyed(docs, prefix_chars)
    sha = F.sha2("norm", 256)
    row = F.monotonically_increasing_id().alias("row_id")
    narrow = stored(keyed.select("doc_id", *_KEY, (sha if hash_all else F.lit(None).cast("string")).alias("text_sha256"), row), "exact-keys")
    # counts per length and prefix are taken straight from the narrow rows (map-side first);
    # a length counts the prefixes' counts, so each step joins one row per key
    counts = stored(narrow.groupBy(*_KEY).agg(F.count("*").alias("n")), "exact-counts")
    lengths = counts.groupBy("length").agg(F.sum("n").alias("of_length")).where("of_length > 1")
    pairs = stored(counts.where("n > 1").join(lengths, "length", "left_semi").select(*_KEY), "exact-pairs")
    if hash_all:
        alive = stored(narrow.join(pairs, _KEY, "left_semi"), "exact-full")
    elif pairs.count() <= broadcast_groups:
        alive = keyed.join(F.broadcast(pairs), _KEY, "left_semi").select("doc_id", *_KEY, sha.alias("text_sha256"), row)
        alive = stored(alive, "exact-full")
    else:
        alive = stored(keyed.select("doc_id", *_KEY, sha.alias("text_sha256"), row).join(pairs, _KEY, "left_semi"), "exact-full")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id"))
    full = [*_KEY, "text_sha256"]
    groups = stored(alive.groupBy(*full).agg(first.alias("first"), F.count("*").alias("n")).where("n > 1"), "exact-groups")
    base = narrow if hash_all else narrow.join(pairs, _KEY, "left_anti").unionByName(alive)
    out = base.join(groups, full, "left")
    return out.select(
        "doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (F.col("n").isNull() | (F.col("row_id") == F.col("first.row_id"))).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, prefix_chars: int = 256) -> DataFrame:
    """``docs`` with its columns, without the rows that ``exact_dedup`` drops.

    Only documents that share a text with another are looked up by its hash.
    """
    verdict = stored(exact_dedup(docs, prefix_chars, hash_all=True).where("group_size > 1"), "exact-verdict")
    keepers = verdict.where("kept").select(F.col("text_sha256").alias("sha"), F.col("keep_id"))
    twice = verdict.where("not kept and doc_id <=> keep_id").select(F.col("text_sha256").alias("twice")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.sha2(normalised(), 256).alias("own_sha"))
    met = rows.join(keepers, F.col("own_sha") == F.col("sha"), "left").where(F.col("sha").isNull() | F.col("id").eqNullSafe(F.col("keep_id")))
    if twice.isEmpty():
        return met.select("row.*")
    met = met.join(twice, F.col("own_sha") == F.col("twice"), "left")  # rows given twice, id and text
    return met.where("twice is null").select("row.*").unionByName(met.where("twice is not null").dropDuplicates(["own_sha"]).select("row.*"))
