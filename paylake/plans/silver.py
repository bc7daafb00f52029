"""Silver layer compositions: clean -> validate -> split (batch form).

The streaming path (``paylake.streaming.silver``) applies exactly these
functions to each micro-batch, so batch results define the truth.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.operators.clean import (CLEANERS, MERCHANT_COLUMNS, TRANSACTION_COLUMNS,
                                     USER_COLUMNS)
from paylake.operators.rules import (RULE_SETS, TRAIL_SEPARATOR, PAYLOAD_SEPARATOR, limbo_rows,
                                     quarantine_records, rule_failure_counts, valid_rows, validate)

FEEDS = ("transactions", "users", "merchants")
PAYLOAD_COLUMNS = {
    "transactions": TRANSACTION_COLUMNS,
    "users": USER_COLUMNS,
    "merchants": MERCHANT_COLUMNS,
}
# Columns excluded when a valid row is applied to its CDC table.
EXCEPT_COLUMNS = ("ingestion_at", "source_file", "rejected_by", "is_quarantined", "seq")
KEYS = {
    "transactions": ("transaction_id", "user_id", "merchant_id"),
    "users": ("user_id",),
    "merchants": ("merchant_id",),
}


def flow_name(feed: str, catalog: str = "lake") -> str:
    return f"{catalog}.silver.{feed}"


def validated(raw: DataFrame, feed: str, null_policy: str = "strict", style: str = "compact") -> DataFrame:
    """Cleaned feed with ``is_quarantined`` and ``rejected_by``."""
    return validate(CLEANERS[feed](raw), RULE_SETS[feed](), null_policy, style)


def valid(raw: DataFrame, feed: str, null_policy: str = "strict") -> DataFrame:
    return valid_rows(validated(raw, feed, null_policy))


def quarantine_of(raw: DataFrame, feed: str, null_policy: str = "strict") -> DataFrame:
    return quarantine_records(validated(raw, feed, null_policy), PAYLOAD_COLUMNS[feed])


def quarantine_union(raws: dict[str, DataFrame], null_policy: str = "strict") -> DataFrame:
    """The three feeds' quarantined rows in one table (B12, F1). No shuffle."""
    parts = [quarantine_of(raws[f], f, null_policy) for f in FEEDS]
    return reduce(lambda a, b: a.unionByName(b), parts)


def limbo_of(raw: DataFrame, feed: str) -> DataFrame:
    """Rows a three-valued verdict loses: ``feed, payload, unknown_rules``."""
    rules = RULE_SETS[feed]()
    v = validate(CLEANERS[feed](raw), rules, null_policy="reference")
    unknown = F.concat_ws(TRAIL_SEPARATOR, *[F.when(p.isNull(), F.lit(n)) for n, p in rules])
    return limbo_rows(v).select(
        F.lit(feed).alias("feed"),
        F.concat_ws(PAYLOAD_SEPARATOR, *[F.col(c).cast("string") for c in PAYLOAD_COLUMNS[feed]]).alias("payload"),
        unknown.alias("unknown_rules"),
    )


def limbo_union(raws: dict[str, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [limbo_of(raws[f], f) for f in FEEDS])


def rule_counts(raw: DataFrame, feed: str, catalog: str = "lake") -> DataFrame:
    return rule_failure_counts(CLEANERS[feed](raw), RULE_SETS[feed](), flow_name(feed, catalog))


def rule_counts_union(raws: dict[str, DataFrame], catalog: str = "lake") -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [rule_counts(raws[f], f, catalog) for f in FEEDS])
