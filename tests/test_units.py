"""Literal unit cases (FIXTURES §6)."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paylake.functions.keys import normalized_amount, week_label
from paylake.functions.masks import mask_doc_id, mask_email, mask_name, mask_phone
from paylake.functions.parse import normalize_currency, parse_amount, parse_multi_date
from paylake.operators.rules import transaction_rules, user_rules, validate
from paylake.plans.marts import imputed_risk, rate_tier


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("1.234,56", Decimal("1234.56")), ("12,5", Decimal("12.50")), (",56", None), ("12,", None),
    ("1,234.56", Decimal("1.23")), ("1.235", Decimal("1.24")), ("", None), ("123456789.00", None),
    (None, None), ("  7,10 ", Decimal("7.10")), ("abc", None),
])
def test_parse_amount(spark, text, expected):
    assert one(spark, parse_amount("v"), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("01/02/2024", dt.date(2024, 2, 1)), ("31/02/2024", None), ("1/2/2024", None),
    ("2024-01-05", dt.date(2024, 1, 5)), ("20240105", None), (None, None),
])
def test_parse_date(spark, text, expected):
    assert one(spark, parse_multi_date("v"), text) == expected


@pytest.mark.parametrize("text,expected", [("sol", "PEN"), ("SOLES", "PEN"), ("us$", "USD"), ("eur", "EUR"),
                                           (None, None)])
def test_currency(spark, text, expected):
    assert one(spark, normalize_currency("v"), text) == expected


@pytest.mark.parametrize("email,ok", [("a@bb.cc", True), ("a@b.cc", False), ("@bb.cc", False), (None, False)])
def test_email_rule(spark, email, ok):
    rule = dict(user_rules())["valid_email"]
    assert bool(one(spark, F.coalesce(rule, F.lit(False)), email, "email string")) is ok


def test_null_channel_lost_in_reference_mode_quarantined_by_default(spark):
    row = ("T1-1", "U1", "M1", None, "pago", Decimal("10.00"), "PEN", None, "aprobado", None)
    schema = ("transaction_id string, user_id string, merchant_id string, channel string, "
              "transaction_type string, amount decimal(10,2), currency string, transaction_date date, "
              "status string, reference_id string")
    df = spark.createDataFrame([row], schema)
    ref = validate(df, transaction_rules(), null_policy="reference").first()
    strict = validate(df, transaction_rules()).first()
    assert ref["is_quarantined"] is None
    assert strict["is_quarantined"] is True
    assert strict["rejected_by"] == "valid_channel"
    slots = validate(df, transaction_rules(), style="slots").first()["rejected_by"]
    assert slots == ";;;valid_channel;;;;;"


@pytest.mark.parametrize("a,b,tier", [(2, 21, 1), (49, 200, 2), (1, 2, 3), (1, 20, 0)])
def test_rate_tier(spark, a, b, tier):
    df = spark.createDataFrame([(a, b)], "a long, b long")
    rate = (F.col("a") / F.col("b")).cast("decimal(10,2)")
    assert df.select(rate_tier(rate)).first()[0] == tier


@pytest.mark.parametrize("date,risk", [(dt.date(2023, 1, 7), "alto"), (dt.date(2023, 10, 4), "bajo"),
                                       (dt.date(2023, 12, 1), "desconocido")])
def test_tenure(spark, date, risk):
    df = spark.createDataFrame([("activo", None, date)], "status string, risk string, d date")
    assert df.select(imputed_risk(F.col("status"), F.col("risk"), F.col("d"))).first()[0] == risk


def test_masks(spark):
    df = spark.createDataFrame([("ana@x.com", "12345678", "+51999", "Ana")], "e string, d string, p string, n string")
    r = df.select(mask_email("e"), mask_doc_id("d"), mask_phone("p"), mask_name("n"),
                  mask_email("e", "ingenieria"), mask_email(F.lit("bad.mail"))).first()
    assert r[0] == "an*****x.com"
    assert r[1] == "#########"
    assert r[2] == "$$$$$$$$$"
    assert r[3] == hashlib.md5(b"Ana").hexdigest()
    assert r[4] == "ana@x.com"
    assert r[5] == "ba*****"


def test_week_label(spark):
    assert one(spark, week_label(F.col("v")), dt.date(2021, 1, 1), "v date") == "S53"


@pytest.mark.parametrize("amount,ccy,expected", [
    (Decimal("10.00"), "PEN", Decimal("3.33")), (Decimal("0.05"), "ARS", Decimal("0.03")),
    (Decimal("0.05"), "CLP", Decimal("0.01")), (Decimal("10.00"), "USD", Decimal("10.00")),
])
def test_fx(spark, amount, ccy, expected):
    df = spark.createDataFrame([(amount, ccy)], "a decimal(10,2), c string")
    assert df.select(normalized_amount("a", "c")).first()[0] == expected


def test_quarantine_payload_formats(spark):
    import json

    from paylake.operators.rules import quarantine_records

    df = spark.createDataFrame([("T1", None, "x", True, "r1")],
                               "a string, b string, c string, is_quarantined boolean, rejected_by string")
    pipe = quarantine_records(df, ["a", "b", "c"]).first()["payload"]
    js = quarantine_records(df, ["a", "b", "c"], payload_format="json").first()["payload"]
    assert pipe == "T1|x"  # the NULL column leaves no slot
    assert json.loads(js) == {"a": "T1", "b": None, "c": "x"}


def test_cluster_sizing():
    from paylake.session import cluster_conf

    conf = cluster_conf(100 << 40, executor_cores=4000)  # 100 TiB
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    assert conf["spark.sql.files.maxPartitionBytes"] == "128m"


def test_temp_views_for_sql_users(spark):
    from paylake.plans.layers import register_temp_views

    register_temp_views({"tiny_feed": spark.range(3)})
    assert spark.sql("SELECT count(*) FROM tiny_feed").first()[0] == 3
