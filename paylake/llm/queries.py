"""Registered queries of the training-data operators, with their SQL.

Each query applies one operator, with production parameters, to its whole
table and derives the digest columns. ``ORACLES`` holds the DuckDB SQL of
those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm.ann import nearest
from paylake.llm.bpe import bpe_round_trip
from paylake.llm.common import table
from paylake.llm.exact_dedup import exact_dedup
from paylake.llm.hard_negatives import hard_negatives
from paylake.llm.language import language_id
from paylake.llm.line_dedup import line_dedup
from paylake.llm.packing import best_fit_packing
from paylake.llm.pii import find_private, private_counts
from paylake.llm.sharding import interleave_shards
from paylake.llm.simhash import near_duplicates
from paylake.llm.substring_dedup import substring_dedup
from paylake.llm.toxicity import toxicity
from paylake.llm.vectors import finite, scaled
from paylake.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def _op1_sql(levels: int = 14) -> str:
    """Windows of 20 words and, by the hash of two neighbours, of 40, 80, ..;
    enough levels for texts of 300,000 words."""
    doubled = "".join(f""", l{k} AS (
  SELECT doc_id, i, md5(h || lead(h, {10 << k}) OVER w) AS h FROM l{k - 1} WINDOW w AS (PARTITION BY doc_id ORDER BY i) QUALIFY lead(h, {10 << k}) OVER w IS NOT NULL
)""" for k in range(1, levels))
    repeats = " UNION ALL ".join(
        f"SELECT DISTINCT doc_id, {20 << k} AS longest FROM (SELECT doc_id FROM l{k} QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1)"
        for k in range(levels))
    return f"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM w
), windows AS (
  SELECT doc_id, i, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS seq FROM words
), l0 AS (
  SELECT doc_id, i, md5(seq) AS h FROM windows WHERE i + 19 <= n
){doubled}, repeats AS (
  {repeats}
  UNION ALL SELECT doc_id, len(ws) FROM (SELECT * FROM w WHERE len(ws) >= 20 QUALIFY row_number() OVER (PARTITION BY ws ORDER BY doc_id) > 1)
), longest AS (
  SELECT doc_id, max(longest) AS longest FROM repeats GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i
  FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS nth FROM windows WHERE i + 19 <= n) WHERE nth > 1
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS txt, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(txt, '')) AS kept_sha256,
       coalesce(longest, 0)::BIGINT AS longest_repeat
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN longest USING (doc_id)
"""


@register("op1_substring_dedup", _op1_sql())
def op1_substring_dedup(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents"))


@register("op2_bpe_round_trip")
def op2_bpe_round_trip(spark, sf_dir):
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register("op3_line_dedup", """
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i FROM d
), h AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM l
), b AS (
  SELECT *, (h + 1000003 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % 2147483647 % 3 = 0 AS may FROM h
), bounds AS (
  SELECT *, may AND NOT coalesce(lag(may) OVER (PARTITION BY doc_id ORDER BY i), false) AND i >= 1 AND i < max(i) OVER (PARTITION BY doc_id) - 1 AS cut FROM b
), numbered AS (
  SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM bounds
), c AS (
  SELECT doc_id, chunk, min(i) AS s, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM numbered GROUP BY doc_id, chunk
), later AS (
  SELECT doc_id, chunk, s, n FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS nth FROM c WHERE n >= 2) WHERE nth > 1
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS txt, count(*) AS n FROM numbered ANTI JOIN later USING (doc_id, chunk) GROUP BY doc_id
), gone AS (
  SELECT doc_id, string_agg(s || ':' || n, ',' ORDER BY s) AS removed FROM later GROUP BY doc_id
)
SELECT doc_id, len(ls)::BIGINT AS n_lines, (len(ls) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(txt, '')) AS kept_sha256, coalesce(removed, '') AS removed
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
""")
def op3_line_dedup(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents"))


@register("op4_exact_dedup", """
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
""")
def op4_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"), hash_all=True)


@register("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2, seed=42)
    return found.select("doc_id", F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id")


@register("op6_interleave_shards", """
WITH RECURSIVE crc_bits(b, k, c) AS (
  SELECT b, 0, b FROM range(256) r(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM crc_bits WHERE k = 8
), d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
                         lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1])), 4294967295) AS text_crc32,
         CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS stratum,
         ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS u
  FROM documents, crc_table
), ranked AS (
  SELECT *, ((row_number() OVER (PARTITION BY stratum ORDER BY u, doc_id, text_crc32, size) - 1)::DOUBLE
             + ('0x' || substr(md5('42:' || stratum), 1, 15))::BIGINT::DOUBLE / 1152921504606846976.0::DOUBLE) / count(*) OVER (PARTITION BY stratum)::DOUBLE AS fraction
  FROM d
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, stratum, u, doc_id, text_crc32, size) - 1 AS place, count(*) OVER () AS n FROM ranked
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (place * 16 // n)::INT AS shard,
       (place - (place * 16 // n * n + 15) // 16)::BIGINT AS slot, NULL::INT AS grown_shard
FROM placed
""")
def op6_interleave_shards(spark, sf_dir):
    return interleave_shards(table(spark, sf_dir, "documents"), shards=16, seed=42)


@register("op7_best_fit_packing")
def op7_best_fit_packing(spark, sf_dir):
    placed = best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, separator=0)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op8_private_spans")
def op8_private_spans(spark, sf_dir):
    return private_counts(find_private(table(spark, sf_dir, "documents")))


@register("op9_nearest_neighbours")
def op9_nearest_neighbours(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@register("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op11_embedding_whitening")
def op11_embedding_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"), components=4, scale=256)


@register("op12_language_id")
def op12_language_id(spark, sf_dir):
    return language_id(table(spark, sf_dir, "documents"))


@register("op13_hard_negatives")
def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").where(finite("embedding"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), scaled("embedding", 256).alias("x"))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, lowest=50, highest=95)
