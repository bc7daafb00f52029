"""Silver cleaning projections.

Each function is one ``select``: case normalising, synonym folding, localised
amount and multi-format date parsing, all native expressions. Lineage columns
(``ingestion_at``, ``source_file``) and the ``seq`` sequence column are passed
through when the input has them, so the same projection serves the batch
fixture and the bronze stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions.parse import normalize_currency, parse_amount, parse_multi_date

LINEAGE_COLUMNS = ("seq", "ingestion_at", "source_file")

TRANSACTION_COLUMNS = ("transaction_id", "user_id", "merchant_id", "channel", "transaction_type",
                       "amount", "currency", "transaction_date", "status", "reference_id")
USER_COLUMNS = ("user_id", "full_name", "document_id", "email", "phone", "country", "segment",
                "registration_date")
MERCHANT_COLUMNS = ("merchant_id", "merchant_name", "category", "country", "affiliation_date",
                    "status", "risk_level")


def _lineage(df: DataFrame):
    return [F.col(c) for c in LINEAGE_COLUMNS if c in df.columns]


def clean_transactions(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id",
        "user_id",
        "merchant_id",
        F.lower("channel").alias("channel"),
        F.lower("transaction_type").alias("transaction_type"),
        parse_amount("amount").alias("amount"),
        normalize_currency("currency").alias("currency"),
        parse_multi_date("transaction_date").alias("transaction_date"),
        F.lower("status").alias("status"),
        "reference_id",
        *_lineage(df),
    )


def clean_users(df: DataFrame) -> DataFrame:
    return df.select(
        "user_id",
        "full_name",
        "document_id",
        "email",
        "phone",
        F.upper("country").alias("country"),
        F.trim(F.lower("segment")).alias("segment"),
        parse_multi_date("registration_date").alias("registration_date"),
        *_lineage(df),
    )


def clean_merchants(df: DataFrame) -> DataFrame:
    return df.select(
        "merchant_id",
        "merchant_name",
        F.lower("category").alias("category"),
        F.upper("country").alias("country"),
        parse_multi_date("affiliation_date").alias("affiliation_date"),
        F.lower("status").alias("status"),
        F.lower("risk_level").alias("risk_level"),
        *_lineage(df),
    )


CLEANERS = {
    "transactions": clean_transactions,
    "users": clean_users,
    "merchants": clean_merchants,
}
