"""Keys and code maps of the star schema (B14, B15, B19, B20, B21, dim_date labels)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference).
# Country -> local currency (B15); any other country -> NULL.
LOCAL_CURRENCY = {"PE": "PEN", "MX": "MXN", "CO": "COP", "CL": "CLP", "AR": "ARS"}
# Currency -> divisor that normalises an amount (B21); other currencies unchanged.
FX_DIVISORS = {"PEN": 3, "ARS": 2, "MXN": 5, "COP": 7, "CLP": 10}
# Risk label -> ordinal (B19); anything else -> 0.
RISK_ORDINAL = {"alto": 3, "medio": 2, "bajo": 1}
# Channel -> surrogate id as hard-coded in the fact (B20); unknown -> NULL.
STATIC_CHANNEL_IDS = {"app": "CH-001", "pos": "CH-002", "web": "CH-003"}
CHANNEL_ID_PREFIX = "CH-"
WEEK_LABEL_PREFIX = "S"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_values(col, mapping: dict, default=None) -> Column:
    """``CASE col WHEN k1 THEN v1 ... ELSE default END`` from a small dict."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(default) if default is not None else expr


def date_key(date) -> Column:
    """Integer key yyyymmdd (``PK_Tiempo``)."""
    d = _c(date)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def local_currency(country) -> Column:
    return map_values(country, LOCAL_CURRENCY)


def risk_ordinal(level) -> Column:
    return map_values(level, RISK_ORDINAL, F.lit(0))


def static_channel_id(channel) -> Column:
    return map_values(channel, STATIC_CHANNEL_IDS)


def quarter_label(date) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_c(date)).cast("string"))


def week_label(date) -> Column:
    """ISO week number without the ISO year: 2021-01-01 -> ``S53``."""
    return F.concat(F.lit(WEEK_LABEL_PREFIX), F.weekofyear(_c(date)).cast("string"))


def normalized_amount(amount, currency, divisors: dict | None = None) -> Column:
    """Amount divided by its currency's divisor, rounded half-up to cents.

    ``decimal(10,2) / int`` is ``decimal(14,6)``; the final cast rounds it.
    """
    a, cur = _c(amount), _c(currency)
    expr = None
    for code, d in (divisors or FX_DIVISORS).items():
        q = a / F.lit(d)
        expr = F.when(cur == code, q) if expr is None else expr.when(cur == code, q)
    return expr.otherwise(a).cast("decimal(10,2)")
