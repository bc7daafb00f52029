"""Text-to-value parsers used by the silver cleaning step.

All are native Column expressions: they stay inside whole-stage codegen and
never start a Python worker. Parse failures give NULL (``try_*``), so one bad
row never stops a batch; the rule set then decides where the row goes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference): localised-amount detector, the two
# accepted date layouts, and the currency synonyms.
#   amount has "x,y" (a comma with a character on each side) -> drop dots, comma becomes the decimal point
#   date containing "/" -> dd/MM/yyyy; containing "-" -> yyyy-MM-dd; otherwise NULL
#   SOL -> PEN, SOLES -> PEN, US$ -> USD; any other currency is upper-cased
LOCALISED_AMOUNT = "(?d)^.+,."
SLASH_DATE_FORMAT = "dd/MM/yyyy"
DASH_DATE_FORMAT = "yyyy-MM-dd"
CURRENCY_SYNONYMS = {"SOL": "PEN", "SOLES": "PEN", "US$": "USD"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_amount_text(amount) -> Column:
    """Rewrite a localised amount (``1.234,56``) into plain notation (``1234.56``).

    Text without a comma between two characters passes through unchanged.
    """
    a = _c(amount)
    plain = F.replace(F.replace(a, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(a.rlike(LOCALISED_AMOUNT), plain).otherwise(a)


def parse_amount(amount, precision: int = 10, scale: int = 2) -> Column:
    """Localised text amount -> ``decimal(precision, scale)``; unparseable -> NULL.

    Blank text is NULL (not a cast error); ``1.235`` rounds half-up to 1.24;
    values too wide for the type are NULL.
    """
    # Blank text needs no branch of its own: try_cast('') is NULL. Each extra
    # reference to the input is re-evaluated wherever Catalyst inlines it
    # (e.g. a rule filter pushed below this projection), so keep them few.
    return normalize_amount_text(F.trim(_c(amount))).try_cast(f"decimal({precision},{scale})")


def parse_multi_date(text) -> Column:
    """Date text in ``dd/MM/yyyy`` or ``yyyy-MM-dd``; anything else -> NULL."""
    t = _c(text)
    return (
        F.when(t.contains("/"), F.try_to_date(t, SLASH_DATE_FORMAT))
        .when(t.contains("-"), F.try_to_date(t, DASH_DATE_FORMAT))
    )


def normalize_currency(currency) -> Column:
    """Upper-case the currency code and fold known synonyms."""
    u = F.upper(_c(currency))
    expr = None
    for alias, code in CURRENCY_SYNONYMS.items():
        expr = (F.when(u == alias, code) if expr is None else expr.when(u == alias, code))
    return expr.otherwise(u)
