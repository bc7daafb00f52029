"""The training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs: documents predicted toxic
go, of exact copies and of near duplicates one stays, personal data is masked
in the texts, and what is left is packed into sequences. Stages but the last
keep the columns of ``documents``.

Packing tokenises, which SQL cannot express: ``ORACLE_SQL`` is None and the
tests hold the pipeline against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paylake.llm.common import stored, table
from paylake.llm.exact_dedup import drop_exact_copies
from paylake.llm.packing import best_fit_packing
from paylake.llm.pii import mask_private
from paylake.llm.simhash import keep_one_of_each
from paylake.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, shingle=3, max_bits=2, seed=42)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_private(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed = best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, separator=0)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("private_data", private_data),
    ("best_fit_packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
