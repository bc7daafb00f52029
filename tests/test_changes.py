"""Schema drift, admission, stored policy, gold and fact from changes."""

import dataclasses
import os

from pyspark.sql import functions as F

from samples import SF_SMALL
from paylake.operators.masking import register_views, store_policy, tagged_tables
from paylake.operators.rules import observe_verdicts, rule_failure_counts, transaction_rules, validate
from paylake.operators.clean import clean_transactions
from paylake.plans import changes as C
from paylake.plans import streams as ST
from paylake.registry import _raws
from paylake.session import fresh_dir
from paylake.sources.tables import stored_bytes, stored_files
from paylake.streaming.drift import RESCUED, schema_versions, start_bronze_by_name
from paylake.streaming.ingest import start_bronze
from paylake.streaming.state import KeyedState


def land_text(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_columns_are_read_by_each_files_header(spark):
    work = fresh_dir(spark, "t-drift").removeprefix("file:")
    landing = f"{work}/landing"
    land_text(landing, "a.csv", "id|name|age\n1|ana|7\n2||\n")
    land_text(landing, "b.csv", " AGE |extra|id|name|name\n8|x|3|eva|twice\n9||4|leo|\n")
    land_text(landing, "c.csv", "name|id\nmax|5|over|more\n")
    land_text(landing, "d.csv", "id|name|age\n")
    cfg = dataclasses.replace(ST.feed_config("people", landing, f"{work}/bronze"), schema_location=f"{work}/schema")
    run = lambda: start_bronze_by_name(spark, cfg, f"{work}/_chk", ["id", "name", "age"], max_bytes_per_trigger=1).awaitTermination()
    run()
    rows = lambda: {r["id"]: (r["name"], r["age"], r[RESCUED]) for r in spark.read.parquet(cfg.target_table).collect()}
    want = {"1": ("ana", "7", None), "2": (None, None, None), "3": ("eva", "8", {"extra": "x", "name#2": "twice"}), "4": ("leo", "9", None),
            "5": ("max", None, {"#3": "over", "#4": "more"})}
    assert rows() == want
    land_text(landing, "e.csv", "id|name|age|city\n6|kim|1|lima\n")
    run()  # from the checkpoint: the new file only
    assert rows() == {**want, "6": ("kim", "1", {"city": "lima"})}
    assert spark.read.parquet(cfg.target_table).count() == 6
    versions = schema_versions(spark, cfg.schema_location).orderBy("version").collect()
    assert [(r["version"], r["added"]) for r in versions] == [(0, []), (1, ["extra", "name#2"]), (2, ["city"])]
    assert versions[2]["columns"] == ["id", "name", "age", "extra", "name#2", "city"] and versions[2]["seen_in"] == "e.csv"


def test_batches_follow_bytes_and_taken_files_are_archived(spark):
    work = fresh_dir(spark, "t-admit").removeprefix("file:")
    landing = f"{work}/landing"
    ST.land(_raws(spark, SF_SMALL)["users"], "users", landing, 8)
    cfg = ST.feed_config("users", landing, f"{work}/bronze")
    total = stored_bytes(spark, landing)
    files = len(stored_files(spark, landing))
    assert files > 4 and total > 0
    batches = {}
    for parts in (1, 4):
        q = start_bronze(spark, dataclasses.replace(cfg, target_table=f"{work}/bronze{parts}"), f"{work}/_chk{parts}", extra_columns=("seq",),
                         max_bytes_per_trigger=-(-total // parts), archive=f"{work}/taken" if parts == 4 else None)
        q.awaitTermination()
        batches[parts] = len([p for p in q.recentProgress if p["numInputRows"]])
        assert spark.read.parquet(f"{work}/bronze{parts}").count() == _raws(spark, SF_SMALL)["users"].count()
    assert batches[1] == 1 and 4 <= batches[4] <= files
    assert len(stored_files(spark, landing)) < files and stored_files(spark, f"{work}/taken")


def test_views_mask_by_the_stored_policy(spark):
    root = fresh_dir(spark, "t-policy")
    people = spark.createDataFrame([("1", "ana@x.com", "Ana")], "id string, email string, name string")
    kinds = {"email": {"pii": "true", "tipo": "email"}, "name": {"pii": "true", "tipo": "name"}}
    store_policy(spark, root, "people", {"informacion": "critica"}, kinds)
    tables = {"people": people, "plain": people}
    look = lambda role: spark.sql("SELECT email, name FROM " + register_views(spark, root, tables, role, "v_")["people"]).first()
    assert look("analista")["email"] == "an*****x.com" and look("ingenieria")["email"] == "ana@x.com"
    assert spark.sql("SELECT name FROM v_plain").first()[0] == "Ana"
    assert tagged_tables(spark, root, "informacion", "critica") == ["people"]
    store_policy(spark, root, "people", {"informacion": None}, {"name": {"pii": None}})  # tags taken away
    assert tuple(look("analista")) == ("an*****x.com", "Ana") and tagged_tables(spark, root, "informacion", "critica") == []


def test_counts_are_observed_while_a_frame_is_written(spark):
    cleaned, rules = clean_transactions(_raws(spark, SF_SMALL)["transactions"]), transaction_rules()
    want = {r["expectation"]: r["failed_records"] for r in rule_failure_counts(cleaned, rules).collect()}
    for policy, style in (("strict", "compact"), ("strict", "slots"), ("reference", "slots")):
        v, counted = observe_verdicts(validate(cleaned, rules, policy, style), rules, f"t-{policy}-{style}", policy)
        v = v.persist()
        v.write.format("noop").mode("overwrite").save()
        v.where("is_quarantined").count()  # a second pass over the kept frame counts nothing twice
        assert {n: counted.get[n] for n in want} == want and counted.get["total_records"] == cleaned.count()
        v.unpersist()


def test_row_changes(spark):
    schema = "k string, v string, n int"
    before = spark.createDataFrame([("a", "x", 1), ("b", None, 1), ("c", "x", None), ("d", "x", 1)], schema)
    after = spark.createDataFrame([("a", "x", 1), ("b", "y", 1), ("c", "x", 0), ("e", None, None)], schema)
    got = lambda a, b: sorted((r["k"], r["v"], r["n"], r["op"]) for r in C.row_changes(a, b, ["k"]).collect())
    assert got(before, after) == [("b", "y", 1, "update"), ("c", "x", 0, "update"), ("d", "x", 1, "delete"), ("e", None, None, "insert")]
    assert got(before, before) == [] and {r[3] for r in got(None, after)} == {"insert"} and {r[3] for r in got(before, None)} == {"delete"}


def test_fact_takes_retractions_and_can_be_compacted(spark):
    work = fresh_dir(spark, "t-fact")
    schema = "PK_Tiempo int, transaction_id string, user_id string, merchant_id string, channel_id string, amount decimal(10,2), transaction_type string, risk_score int"
    row = lambda t, amount, kind="pago", risk=10: (20240101, t, "u", "m", "CH-001", amount, kind, risk)
    from decimal import Decimal as D

    first = spark.createDataFrame([row("1", D("1.00")), row("2", D("2.00"), "reversa", 30)], schema)
    C.add_delta(spark, work, C.partials(first, 1), 0)
    gone, come = spark.createDataFrame([row("1", D("1.00"))], schema), spark.createDataFrame([row("1", D("5.00"), "pago", 20)], schema)
    for _ in range(2):  # a refresh that runs again counts once
        C.add_delta(spark, work, C.partials(gone, -1).unionByName(C.partials(come, 1)), 1)
    want = [(20240101, "u", "m", "CH-001", D("7.00"), 25.0, 1, 2)]
    assert list(map(tuple, C.fact(spark, work).collect())) == want
    packed = fresh_dir(spark, "t-fact-packed")
    C.compact(spark, work, packed)
    assert list(map(tuple, C.fact(spark, packed).collect())) == want
    C.add_delta(spark, packed, C.partials(come.unionByName(spark.createDataFrame([row("2", D("2.00"), "reversa", 30)], schema)), -1), 1)
    assert C.fact(spark, packed).collect() == []  # all taken away


def test_rows_of_new_keys_are_inserts_without_a_comparison(spark, monkeypatch):
    compared, plain = [], C.row_changes
    monkeypatch.setattr(C, "row_changes", lambda before, after, *a: compared.append(before is not None and after is not None) or plain(before, after, *a))
    schema = "k string, seq int, v string"
    work = fresh_dir(spark, "t-marks")
    gold = C.GoldTable(f"{work}/gold", KeyedState(f"{work}/silver", ("k",), "seq", history=False, buckets=2), lambda rows: rows)
    folds = [[("a", 1, "x"), ("b", 1, "x"), ("c", 5, "x"), ("d", 1, None)], [("e", 1, "x"), ("f", 1, None), ("a", 1, "x"), ("c", 4, "late")],
             [("a", 2, "y"), ("b", 2, "x"), ("d", 2, "z"), ("g", 1, "x")]]
    for n, rows in enumerate(folds):
        gold.silver.fold(spark.createDataFrame(rows, schema), n)
        gold.catch_up(spark)
    got = lambda older, newer: sorted((r["k"], r["v"], r["op"]) for r in gold.changes(spark, older, newer).collect())
    compared.clear()
    assert got(0, 1) == [("e", "x", "insert"), ("f", None, "insert")] and not any(compared)
    assert got(1, 2) == [("a", "y", "update"), ("d", "z", "update"), ("g", "x", "insert")] and compared.count(True) == 1
    assert got(0, 2) == [("a", "y", "update"), ("d", "z", "update"), ("e", "x", "insert"), ("f", None, "insert"), ("g", "x", "insert")]
    want = [("a", "y"), ("b", "x"), ("c", "x"), ("d", "z"), ("e", "x"), ("f", None), ("g", "x")]
    assert sorted(map(tuple, gold.table(spark).collect())) == want == sorted(map(tuple, gold.silver.table(spark).collect()))
    assert sorted(map(tuple, gold.table_at(spark, 0).collect()), key=str) == [("a", "x"), ("b", "x"), ("c", "x"), ("d", None)]


def test_a_delta_takes_changed_rows_users_and_merchants_once(spark):
    import datetime as dt
    from decimal import Decimal as D

    day = dt.date(2024, 1, 1)
    tx_schema = "PK_Tiempo int, transaction_id string, user_id string, merchant_id string, channel string, transaction_type string, amount decimal(10,2), currency string, transaction_date date, status string, reference_id string"
    tx = lambda t, u, m, amount, kind="pago": (20240101, t, u, m, "web", kind, D(amount), "USD", day, "aprobado", None)
    users = lambda **c: spark.createDataFrame([(20240101, u, "n", "d", "e", "p", k, None, day, cur) for u, (k, cur) in c.items()], "PK_Tiempo int, user_id string, full_name string, document_id string, email string, phone string, country string, segment string, registration_date date, local_currency string")
    merchants = lambda **r: spark.createDataFrame([(20240101, m, "n", "moda", "PE", day, "activo", x, "PEN") for m, x in r.items()], "PK_Tiempo int, merchant_id string, merchant_name string, category string, country string, affiliation_date date, status string, risk_level string, local_currency string")
    rows0 = [tx("1", "u", "m", "1.00"), tx("2", "v", "m", "2.00"), tx("3", "u", "n", "3.00"), tx("4", "w", "o", "4.00"), tx("5", "w", "o", "5.00", "reversa"), tx("9", "x", "o", "1.00")]
    rows1 = [*rows0[:3], tx("4", "w", "o", "7.00"), *rows0[4:5], tx("6", "u", "m", "8.00"), tx("7", "x", "o", "9.00")]  # 9 is gone
    t0, t1 = (spark.createDataFrame(r, tx_schema) for r in (rows0, rows1))
    before = C.Gold(t0, users(u=("PE", "PEN"), v=("CO", None), w=("PE", "PEN"), x=("PE", "PEN")), merchants(m="alto", n="bajo", o="medio"))
    after = C.Gold(t1, users(u=("PE", "PEN"), v=("PE", "PEN"), w=("PE", "PEN"), x=("PE", "PEN")), merchants(m="bajo", n="bajo", o="medio"))
    for changed in (C.row_changes(t0, t1, C.TX_KEYS), C.row_changes(t0, t1, C.TX_KEYS).where("op = 'insert'")):
        last = after if changed.where("op <> 'insert'").count() else C.Gold(spark.createDataFrame([*rows0, *rows1[5:]], tx_schema), after.users, after.merchants)
        work = fresh_dir(spark, "t-delta")
        C.add_delta(spark, work, C.fact_delta(None, before, None), 0)
        delta = C.fact_delta(before, last, changed, users_bounded=True, merchants_bounded=True)
        assert "LeftSemi" not in delta._jdf.queryExecution().optimizedPlan().toString()  # no list of keys is made and joined back
        C.add_delta(spark, work, delta, 1)
        whole = fresh_dir(spark, "t-whole")
        C.add_delta(spark, whole, C.fact_delta(None, last, None), 0)
        assert sorted(map(tuple, C.fact(spark, work).collect())) == sorted(map(tuple, C.fact(spark, whole).collect()))
