"""Named data-quality rules, the verdict, and the valid / quarantine split.

A rule set is an ordered list of ``(name, Column)``. Order matters only for
the failed-rule trail. Every rule is parenthesised by construction (it is a
Column, not SQL text), so an ``OR`` inside one rule cannot leak into the
conjunction (S23).

Null policy (S1). A rule whose inputs are NULL evaluates to NULL. Under
``"reference"`` the verdict is three-valued and such rows end up in neither the
valid nor the quarantine table; under ``"strict"`` (default) a rule passes only
when it is TRUE, so every row lands in exactly one of the two.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Fixed values (must equal the reference): accepted codes and text patterns.
CHANNELS = ("web", "app", "pos")
TRANSACTION_TYPES = ("pago", "reversa", "retiro")
CURRENCIES = ("PEN", "USD", "COP", "MXN", "CLP", "ARS")
TRANSACTION_STATUSES = ("aprobado", "rechazado", "pendiente")
COUNTRIES = ("PE", "CO", "MX", "CL", "AR")
SEGMENTS = ("premium", "estandar", "nuevo")
CATEGORIES = ("retail", "restaurante", "farmacia", "supermercado", "tecnologia", "transporte",
              "educacion", "salud", "entretenimiento", "moda")
MERCHANT_STATUSES = ("activo", "inactivo", "suspendido")
RISK_LEVELS = ("bajo", "medio", "alto")
REVERSAL_TYPE = "reversa"
DOCUMENT_COUNTRY = "PE"
DOCUMENT_PATTERN_COUNTRY = "^[0-9]{8}$"
DOCUMENT_PATTERN_OTHER = "^[0-9]{8,15}$"
EMAIL_PATTERN = "%_@__%.__%"
TRAIL_SEPARATOR = ";"
PAYLOAD_SEPARATOR = "|"


def transaction_rules() -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("valid_transaction_id", c("transaction_id").isNotNull()),
        ("valid_user_id", c("user_id").isNotNull()),
        ("valid_merchant_id", c("merchant_id").isNotNull()),
        ("valid_channel", c("channel").isin(*CHANNELS)),
        ("valid_transaction_type", c("transaction_type").isin(*TRANSACTION_TYPES)),
        # "amount > 0 AND amount IS NOT NULL": same truth table, one reference
        ("valid_amount", F.coalesce(c("amount") > 0, F.lit(False))),
        ("valid_currency", c("currency").isin(*CURRENCIES)),
        ("valid_status", c("status").isin(*TRANSACTION_STATUSES)),
        ("required_reference_id",
         F.when(c("transaction_type") == REVERSAL_TYPE, c("reference_id").isNotNull())
         .otherwise(c("reference_id").isNull())),
    ]


def user_rules() -> list[tuple[str, Column]]:
    c = F.col
    doc = c("document_id")
    return [
        ("valid_user_id", c("user_id").isNotNull()),
        ("valid_full_name", c("full_name").isNotNull() & (F.length("full_name") > 0)),
        ("valid_document_id",
         F.when(c("country") == DOCUMENT_COUNTRY, doc.rlike(DOCUMENT_PATTERN_COUNTRY))
         .otherwise(doc.rlike(DOCUMENT_PATTERN_OTHER))),
        ("valid_email", c("email").like(EMAIL_PATTERN) & c("email").isNotNull()),
        ("valid_country", c("country").isin(*COUNTRIES)),
        ("valid_segment", c("segment").isin(*SEGMENTS) | c("segment").isNull()),
    ]


def merchant_rules() -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("valid_merchant_id", c("merchant_id").isNotNull()),
        ("valid_merchant_name", c("merchant_name").isNotNull() & (F.length("merchant_name") > 0)),
        ("valid_category", c("category").isin(*CATEGORIES)),
        ("valid_country", c("country").isin(*COUNTRIES)),
        ("valid_status", c("status").isin(*MERCHANT_STATUSES)),
        ("valid_risk_level", c("risk_level").isin(*RISK_LEVELS) | c("risk_level").isNull()),
    ]


RULE_SETS = {
    "transactions": transaction_rules,
    "users": user_rules,
    "merchants": merchant_rules,
}


def _passes(rules, null_policy: str) -> list[tuple[str, Column]]:
    if null_policy == "strict":
        return [(n, F.coalesce(p, F.lit(False))) for n, p in rules]
    if null_policy == "reference":
        return list(rules)
    raise ValueError(f"unknown null_policy {null_policy!r}")


def verdict(rules, null_policy: str = "strict") -> Column:
    """``NOT(rule_1 AND ... AND rule_n)``: TRUE means quarantine."""
    passes = _passes(rules, null_policy)
    return ~reduce(lambda a, b: a & b, [p for _, p in passes])


def failed_rules_trail(rules, null_policy: str = "strict", style: str = "compact") -> Column:
    """``;``-joined names of the failed rules.

    ``compact`` lists only failed names; ``slots`` keeps one (possibly empty)
    slot per rule, as the reference's ``otherwise('')`` produces (S2).
    """
    passes = _passes(rules, null_policy)
    if style == "compact":
        parts = [F.when(~p, F.lit(n)) for n, p in passes]
    elif style == "slots":
        parts = [F.when(~p, F.lit(n)).otherwise(F.lit("")) for n, p in passes]
    else:
        raise ValueError(f"unknown style {style!r}")
    return F.concat_ws(TRAIL_SEPARATOR, *parts)


def validate(df: DataFrame, rules, null_policy: str = "strict", style: str = "compact") -> DataFrame:
    """Add ``is_quarantined`` and ``rejected_by`` (B9, B10). Rows are kept."""
    return df.withColumns({
        "is_quarantined": verdict(rules, null_policy),
        "rejected_by": failed_rules_trail(rules, null_policy, style),
    })


def valid_rows(validated: DataFrame) -> DataFrame:
    """Rows whose verdict is FALSE, without the helper column."""
    return validated.where(~F.col("is_quarantined")).drop("is_quarantined")


def quarantined_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("is_quarantined"))


def limbo_rows(validated: DataFrame) -> DataFrame:
    """Rows with a NULL verdict: lost by a three-valued split."""
    return validated.where(F.col("is_quarantined").isNull())


def quarantine_records(validated: DataFrame, payload_columns, payload_format: str = "pipe") -> DataFrame:
    """Quarantined rows as ``payload, processing_at, source_file, rejected_by``.

    ``payload`` is the ``|``-joined text of the cleaned columns, where NULL
    columns are skipped as ``concat_ws`` does, so positions can shift (S19).
    ``payload_format="json"`` keeps every column by name instead.
    """
    cols = validated.columns
    # keep the feed's own timestamp type: a cast between zoned and zone-less
    # timestamps would make the result depend on the session time zone
    processing_at = F.col("ingestion_at") if "ingestion_at" in cols else F.lit(None).cast("timestamp_ntz")
    source_file = F.col("source_file") if "source_file" in cols else F.lit(None).cast("string")
    if payload_format == "pipe":
        payload = F.concat_ws(PAYLOAD_SEPARATOR, *[F.col(c).cast("string") for c in payload_columns])
    elif payload_format == "json":
        payload = F.to_json(F.struct(*payload_columns), {"ignoreNullFields": "false"})
    else:
        raise ValueError(f"unknown payload_format {payload_format!r}")
    return quarantined_rows(validated).select(
        payload.alias("payload"),
        processing_at.alias("processing_at"),
        source_file.alias("source_file"),
        F.col("rejected_by"),
    )


def rule_failure_counts(df: DataFrame, rules, flow_name: str | None = None) -> DataFrame:
    """Failed rows per rule as rows (D12): ``flow_name, expectation, failed_records,
    warned_records, total_records``.

    One aggregation pass; each counter is a partial aggregate, so the only
    shuffle moves one row per task. A NULL rule result counts as failed (S27).
    """
    passes = _passes(rules, "strict")
    metrics = [F.count(F.lit(1)).alias("total_records"),
               F.count_if(~reduce(lambda a, b: a & b, [p for _, p in passes])).alias("warned_records")]
    metrics += [F.count_if(~p).alias(f"_f{i}") for i, (_, p) in enumerate(passes)]
    agg = df.agg(*metrics)
    per_rule = F.explode(F.array(*[
        F.struct(F.lit(i).alias("rule_order"), F.lit(n).alias("expectation"),
                 F.col(f"_f{i}").alias("failed_records"))
        for i, (n, _) in enumerate(passes)
    ])).alias("r")
    return agg.select(per_rule, "warned_records", "total_records").select(
        F.lit(flow_name).cast("string").alias("flow_name"),
        "r.rule_order", "r.expectation", "r.failed_records", "warned_records", "total_records",
    )


def observe_rules(df: DataFrame, rules, name: str) -> tuple[DataFrame, Observation]:
    """Attach per-rule failure counters to a frame that is not validated yet.

    The counters are filled by the next action."""
    passes = _passes(rules, "strict")
    metrics = [F.count_if(~p).alias(n) for n, p in passes]
    return _observed(df, ~reduce(lambda a, b: a & b, [p for _, p in passes]), metrics, name)


def observe_verdicts(validated: DataFrame, rules, name: str, null_policy: str = "strict") -> tuple[DataFrame, Observation]:
    """Attach the counters to a validated frame (D12, G7): they are filled
    while the first action on it runs, so no pass of their own is needed. The
    trail already tells which rules failed; only under the reference's policy,
    whose trail leaves unknown results out, the rules are evaluated."""
    if null_policy != "strict":
        return observe_rules(validated, rules, name)
    trail = F.concat(F.lit(TRAIL_SEPARATOR), F.col("rejected_by"), F.lit(TRAIL_SEPARATOR))
    failed = F.col("is_quarantined")  # the trail of other rows is empty
    metrics = [F.count_if(failed & F.contains(trail, F.lit(f"{TRAIL_SEPARATOR}{n}{TRAIL_SEPARATOR}"))).alias(n) for n, _ in rules]
    return _observed(validated, F.col("is_quarantined"), metrics, name)


def _observed(df: DataFrame, fails: Column, metrics: list[Column], name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    totals = [F.count(F.lit(1)).alias("total_records"), F.count_if(fails).alias("warned_records")]
    return df.observe(obs, *totals, *metrics), obs
