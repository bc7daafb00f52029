"""Silver CDC tables and the gold projection.

Gold is rebuilt from the current silver snapshot (S7/S8): only open versions
of users and merchants, so the star-schema joins never fan out over history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from paylake.functions.keys import date_key, local_currency
from paylake.operators.cdc import current_rows, scd1, scd2
from paylake.plans.silver import EXCEPT_COLUMNS, KEYS, valid

# Sequence column of each feed in the batch fixture; streams use ingestion_at.
SEQUENCE = {"transactions": "ingestion_at", "users": "seq", "merchants": "seq"}


def silver_transactions(raw_tx: DataFrame, sequence_by: str | None = None) -> DataFrame:
    """SCD1 table of valid transactions, newest change per composite key."""
    seq = sequence_by or SEQUENCE["transactions"]
    return scd1(valid(raw_tx, "transactions"), KEYS["transactions"], seq,
                except_cols=[c for c in EXCEPT_COLUMNS if c != seq], counted=raw_tx)


def silver_history(raw: DataFrame, feed: str, sequence_by: str | None = None, **options) -> DataFrame:
    """SCD2 history of valid users or merchants."""
    seq = sequence_by or SEQUENCE[feed]
    return scd2(valid(raw, feed), KEYS[feed], seq,
                except_cols=[c for c in EXCEPT_COLUMNS if c != seq], **options)


def gold_users(silver_users: DataFrame) -> DataFrame:
    u = current_rows(silver_users)
    return u.select(
        date_key("registration_date").alias("PK_Tiempo"),
        "user_id", "full_name", "document_id", "email", "phone", "country", "segment",
        "registration_date",
        local_currency("country").alias("local_currency"),
    )


def gold_merchants(silver_merchants: DataFrame) -> DataFrame:
    m = current_rows(silver_merchants)
    return m.select(
        date_key("affiliation_date").alias("PK_Tiempo"),
        "merchant_id", "merchant_name", "category", "country", "affiliation_date", "status",
        "risk_level",
        local_currency("country").alias("local_currency"),
    )


def gold_transactions(silver_tx: DataFrame) -> DataFrame:
    return silver_tx.select(
        date_key("transaction_date").alias("PK_Tiempo"),
        "transaction_id", "user_id", "merchant_id", "channel", "transaction_type", "amount",
        "currency", "transaction_date", "status", "reference_id",
    )
