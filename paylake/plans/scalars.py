"""One wide projection exercising the scalar functions the reference uses (§2.7).

Strings, dates, arithmetic, conditionals and array access side by side over
the raw transaction feed; each is a built-in expression, so the whole query is
a single codegen stage over the scan.
"""

from __future__ import annotations



from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions.keys import date_key, week_label
from paylake.functions.parse import parse_amount, parse_multi_date


def scalar_functions(raw_tx: DataFrame) -> DataFrame:
    d = parse_multi_date("transaction_date")
    amount = parse_amount("amount")
    ts = F.col("ingestion_at")
    return raw_tx.select(
        "transaction_id",
        F.lower("channel").alias("s_lower"),
        F.upper("currency").alias("s_upper"),
        F.trim(F.concat(F.lit(" "), F.col("status"), F.lit(" "))).alias("s_trim"),
        F.col("transaction_date").contains("/").alias("s_contains"),
        F.concat_ws("|", "transaction_id", "channel", "reference_id").alias("s_concat_ws"),
        F.concat(F.lit("T:"), F.col("transaction_type")).alias("s_concat"),
        F.lpad("transaction_id", 5, "0").alias("s_lpad"),
        F.length("transaction_id").alias("s_length"),
        F.col("transaction_id").like("T1%").alias("s_like"),
        F.col("amount").rlike("^[0-9]+,[0-9]{2}$").alias("s_rlike"),
        F.replace("amount", F.lit(","), F.lit(".")).alias("s_replace"),
        F.substring_index("transaction_id", "-", -1).alias("s_substring_index"),
        F.rtrim("amount", F.lit("0")).alias("s_rtrim"),
        F.get(F.split("transaction_id", "-", 2), 1).alias("s_split"),
        F.left("user_id", F.lit(2)).alias("s_left"),
        F.md5("transaction_id").alias("s_md5"),
        d.alias("d_parsed"),
        F.year(d).alias("d_year"),
        F.month(d).alias("d_month"),
        F.dayofmonth(d).alias("d_day"),
        week_label(d).alias("d_week"),
        date_key(d).alias("d_key"),
        F.datediff(F.make_date(F.lit(2024), F.lit(1), F.lit(2)), d).alias("d_diff"),
        F.size(F.sequence(ts.cast("date"), F.date_add(ts.cast("date"), 2), F.expr("INTERVAL 1 DAY"))).alias("d_seq_size"),
        ts.cast("date").alias("d_cast"),
        F.date_trunc("MONTH", ts).cast("date").alias("d_month_start"),
        amount.alias("n_amount"),
        (amount / 3).cast("decimal(10,2)").alias("n_div"),
        F.when(F.col("currency").isin("PEN", "USD"), "major").when(F.col("currency").isNull(), "none")
        .otherwise("other").alias("c_case"),
        F.coalesce("reference_id", F.lit("-")).alias("c_coalesce"),
        (F.col("status") != "APROBADO").alias("c_not_equal"),
    )


