"""Semantic marts: calendar, user / merchant / channel dimensions and the
transaction fact (B16-B23, C1-C5, D1-D5, E2, F2, F3).

Every mart is a function of DataFrames; :mod:`paylake.plans.refresh` writes
them in dependency order.

Plan choices
------------
* Reversal rate is one aggregate per user (counts of approved and of approved
  reversals) instead of joining two aggregates of the same table (C1): one
  shuffle, map-side combined.
* The fact filters and prunes the dimensions before joining (the reference's
  LEFT JOIN + ``IS NOT NULL`` filter is an inner join, C5); a dimension is
  broadcast only after its row count is proven small, otherwise it goes
  through a salted join so one hot user or merchant cannot pin a task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake.functions.keys import (CHANNEL_ID_PREFIX, date_key, normalized_amount, quarter_label,
                                    risk_ordinal, static_channel_id, week_label)
from paylake.operators.joins import hot_keys, salted_join
from paylake.operators.rules import CHANNELS

# Fixed values (must equal the reference).
APPROVED = "aprobado"
FACT_STATUSES = ("aprobado", "rechazado")
REVERSAL = "reversa"
USD = "USD"
UNKNOWN_SEGMENT = "desconocido"
UNKNOWN_RISK = "desconocido"
INACTIVE = "inactivo"
# reversal rate >= threshold -> tier (first match wins), else 0
RATE_TIERS = ((0.5, 3), (0.25, 2), (0.1, 1))
# days affiliated before AS_OF >= threshold -> imputed risk (first match wins)
TENURE_RISK = ((360, "alto"), (180, "medio"), (90, "bajo"))
AS_OF = dt.date(2024, 1, 2)
CALENDAR_START = dt.date(2018, 1, 1)
CALENDAR_END = dt.date(2024, 12, 31)
CALENDAR_EARLIEST = dt.date(2000, 1, 1)
CALENDAR_LATEST = dt.date(2039, 12, 31)
CHANNEL_ID_WIDTH = 3


# ------------------------------------------------------------ user marts

def tx_per_type(gold_tx: DataFrame) -> DataFrame:
    """Approved transactions per (user, type)."""
    return (gold_tx.where(F.col("status") == APPROVED)
            .groupBy("user_id", "transaction_type")
            .agg(F.count(F.lit(1)).alias("transaction_count")))


def tx_per_user(gold_tx: DataFrame) -> DataFrame:
    """Re-aggregation of D1 per user."""
    return (tx_per_type(gold_tx).groupBy("user_id")
            .agg(F.sum("transaction_count").alias("total_transactions")))


def reversal_rate(gold_tx: DataFrame) -> DataFrame:
    """Share of approved transactions that are reversals, as decimal(10,2).

    Only users with at least one approved reversal get a row (S24). The rate
    is rounded before any threshold is applied (S9).
    """
    per_user = (gold_tx.where(F.col("status") == APPROVED)
                .groupBy("user_id")
                .agg(F.count_if(F.col("transaction_type") == REVERSAL).alias("reversed"),
                     F.count(F.lit(1)).alias("total")))
    rate = (F.when(F.col("total") > 0, (F.col("reversed") / F.col("total")).cast("decimal(10,2)"))
            .otherwise(F.lit(0)))
    return per_user.where(F.col("reversed") > 0).select("user_id", rate.alias("rate_reversed"))


def rate_tier(rate) -> F.Column:
    r = F.coalesce(rate, F.lit(0))
    expr = None
    for threshold, tier in RATE_TIERS:
        cond = r >= F.lit(threshold)
        expr = F.when(cond, F.lit(tier)) if expr is None else expr.when(cond, F.lit(tier))
    return expr.otherwise(F.lit(0))


def dim_user(gold_users: DataFrame, gold_tx: DataFrame) -> DataFrame:
    """Users with default segment and reversal-rate tier."""
    rate = reversal_rate(gold_tx)
    u = gold_users.join(rate, "user_id", "left")
    return u.select(
        "PK_Tiempo", "user_id", "full_name", "document_id", "email", "phone", "country",
        "local_currency", "registration_date",
        F.coalesce("segment", F.lit(UNKNOWN_SEGMENT)).alias("segment"),
        rate_tier(F.col("rate_reversed")).alias("user_risk_level"),
    )


# -------------------------------------------------------- merchant marts

def imputed_risk(status, risk_level, affiliation_date, as_of: dt.date = AS_OF) -> F.Column:
    """Missing risk from tenure for merchants that are not inactive."""
    days = F.datediff(F.lit(as_of), affiliation_date)
    open_gap = (status != F.lit(INACTIVE)) & risk_level.isNull()
    expr = None
    for threshold, label in TENURE_RISK:
        cond = open_gap & (days >= threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(risk_level.isNull(), F.lit(UNKNOWN_RISK)).otherwise(risk_level)


def dim_merchant(gold_merchants: DataFrame, as_of: dt.date = AS_OF) -> DataFrame:
    return gold_merchants.select(
        "PK_Tiempo", "merchant_id", "merchant_name", "category", "country", "local_currency",
        "status", "affiliation_date",
        imputed_risk(F.col("status"), F.col("risk_level"), F.col("affiliation_date"), as_of).alias("risk_level"),
    )


# --------------------------------------------------------- other dims

def dim_channel(gold_tx: DataFrame) -> DataFrame:
    """Distinct channels numbered in sort order: ``CH-001`` ....

    The global window runs after DISTINCT, i.e. over a handful of rows.
    """
    channels = gold_tx.select("channel").distinct()
    rn = F.row_number().over(Window.orderBy(F.col("channel").asc_nulls_first()))
    return channels.select(
        F.concat(F.lit(CHANNEL_ID_PREFIX), F.lpad(rn.cast("string"), CHANNEL_ID_WIDTH, "0")).alias("channel_id"),
        "channel",
    )


def dim_date(spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END, widen_by: DataFrame | None = None,
             earliest: dt.date = CALENDAR_EARLIEST, latest: dt.date = CALENDAR_LATEST) -> DataFrame:
    """One row per day from ``start`` to ``end`` (S14). With ``widen_by`` the
    dates of those transactions widen the range, but never beyond ``earliest``
    and ``latest``, so a mistyped year makes no calendar of centuries.
    """
    if widen_by is None:
        bounds = spark.range(1).select(F.lit(start).alias("lo"), F.lit(end).alias("hi"))
    else:
        date = F.when(F.col("transaction_date").between(F.lit(earliest), F.lit(latest)), F.col("transaction_date"))
        bounds = widen_by.agg(F.least(F.lit(start), F.min(date)).alias("lo"), F.greatest(F.lit(end), F.max(date)).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(
        date_key("date").alias("PK_Tiempo"),
        "date",
        F.year("date").alias("year"),
        quarter_label("date").alias("quarter"),
        F.month("date").alias("month"),
        week_label("date").alias("week_of_year"),
        F.dayofmonth("date").alias("day"),
    )


# ------------------------------------------------------------- the fact

def fx_amounts(gold_tx: DataFrame) -> DataFrame:
    """Amounts normalised by currency divisor, half-up to cents."""
    return gold_tx.select(
        "transaction_id", "user_id", "merchant_id", "currency", "amount",
        normalized_amount("amount", "currency").alias("normalized_amount"),
    )


def risk_score(currency, merchant_currency, tx_type, m_risk, u_risk) -> F.Column:
    """First matching branch wins."""
    foreign = currency != merchant_currency
    local = currency == merchant_currency
    rev = tx_type == REVERSAL
    not_rev = tx_type != REVERSAL
    s = m_risk + u_risk
    return (F.when(foreign & (currency != USD) & rev, 10 * (s + 4))
            .when(foreign & rev, 10 * (s + 2))
            .when(foreign & not_rev, 5 * (s + 4))
            .when(local & rev, 10 * s)
            .when(local & not_rev, 5 * s)
            .otherwise(0))


def risk_scored_transactions(gold_tx: DataFrame, d_user: DataFrame, d_merchant: DataFrame,
                             channel_ids: DataFrame | None = None, merchants_bounded: bool = False,
                             users_bounded: bool = False, users_bucketed: bool = False,
                             counted: DataFrame | None = None, **hot) -> DataFrame:
    """Eligible transactions with normalised amount, channel id and risk score
    (C3, C4, C5, B19-B23).

    A dimension is broadcast only when the caller has proven its size
    (``*_bounded``, from the row count of the stored table it projects); a
    broadcast join is immune to hot keys. Otherwise the join is a shuffle join
    whose hot keys, found before any join in the key column of the stored
    gold table (``counted``, where ``gold_tx`` is a part of it that other joins
    made), are salted (``hot``: options of ``hot_keys``), or, where the
    caller has both tables bucketed by user (``users_bucketed``) and no user is
    hot, a sort-merge join without a shuffle. The channel
    lookup is cut to the three channels that pass validation and broadcast.
    """
    users = (d_user.where(F.col("local_currency").isNotNull())
             .select("user_id", "user_risk_level"))
    merchants = (d_merchant.where(F.col("local_currency").isNotNull())
                 .select("merchant_id", F.col("local_currency").alias("merchant_currency"),
                         risk_ordinal("risk_level").alias("merchant_risk_level")))
    t = gold_tx.where(F.col("status").isin(*FACT_STATUSES)).select(
        "PK_Tiempo", "transaction_id", "user_id", "merchant_id", "channel", "transaction_type",
        "currency", "amount")
    salt_by = ["transaction_id", "PK_Tiempo"]
    for key, dim, bounded in (("merchant_id", merchants, merchants_bounded), ("user_id", users, users_bounded)):
        if bounded:
            t = t.join(F.broadcast(dim), key, "inner")
        elif key == "user_id" and users_bucketed:
            t = t.join(dim.hint("merge"), key, "inner")
        else:
            t = salted_join(t, dim, key, hot_keys(gold_tx if counted is None else counted, key, **hot), salt_by=salt_by)
    if channel_ids is None:
        channel_id = static_channel_id("channel")
    else:
        known = channel_ids.where(F.col("channel").isin(*CHANNELS)).dropDuplicates(["channel"])  # three rows at most
        t = t.join(F.broadcast(known), "channel", "left")
        channel_id = F.col("channel_id")
    return t.select(
        "PK_Tiempo", "transaction_id", "user_id", "merchant_id",
        channel_id.alias("channel_id"),
        normalized_amount("amount", "currency").alias("amount"),
        "transaction_type",
        risk_score(F.col("currency"), F.col("merchant_currency"), F.col("transaction_type"),
                   F.col("merchant_risk_level"), F.col("user_risk_level")).alias("risk_score"),
    )


def fact_from_scored(scored: DataFrame) -> DataFrame:
    """Aggregate on the four fact keys (D4): partial then final hash aggregate."""
    return (scored.groupBy("PK_Tiempo", "user_id", "merchant_id", "channel_id")
            .agg(F.sum("amount").alias("total_amount"),
                 F.avg("risk_score").alias("risk_score"),
                 F.count(F.when(F.col("transaction_type") == REVERSAL, F.lit(1))).alias("reversed_count"),
                 F.count(F.lit(1)).alias("transaction_count")))


def fact_transactions(gold_tx, d_user, d_merchant, **options) -> DataFrame:
    """The fact with the reference's hard-coded channel ids."""
    return fact_from_scored(risk_scored_transactions(gold_tx, d_user, d_merchant, **options))


def fact_keyed(gold_tx, d_user, d_merchant, d_channel, **options) -> DataFrame:
    """The fact with channel ids looked up in ``dim_channel``."""
    return fact_from_scored(risk_scored_transactions(gold_tx, d_user, d_merchant, d_channel, **options))
