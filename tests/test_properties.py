"""Properties of the operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from samples import SF_SMALL
from paylake.operators.cdc import END_AT, START_AT, scd2
from paylake.operators.joins import hot_keys, salted_join
from paylake.plans import gold as G
from paylake.plans import marts as M
from paylake.plans import silver
from paylake.registry import _dims, _raws, events_history
from paylake.sources.tables import read_table


def test_every_row_in_exactly_one_split(spark):
    raws = _raws(spark, SF_SMALL)
    for feed in silver.FEEDS:
        v = silver.validated(raws[feed], feed)
        total = raws[feed].count()
        valid = v.where(~F.col("is_quarantined")).count()
        quarantined = v.where(F.col("is_quarantined")).count()
        assert valid + quarantined == total, feed


def test_reference_policy_loses_rows(spark):
    raw = _raws(spark, SF_SMALL)["transactions"]
    v = silver.validated(raw, "transactions", null_policy="reference")
    counts = {r[0]: r[1] for r in v.groupBy("is_quarantined").count().collect()}
    # FIXTURES §4 at sf0.001: valid 5,509 / quarantined 460 / lost 31
    assert counts == {False: 5509, True: 460, None: 31}


def test_scd2_intervals_do_not_overlap_or_gap(spark):
    h = events_history(read_table(spark, SF_SMALL, "events"))
    w = Window.partitionBy("user_id").orderBy(START_AT)
    checked = h.withColumn("_next", F.lead(START_AT).over(w))
    assert checked.where(~F.col(END_AT).eqNullSafe(F.col("_next"))).count() == 0
    open_rows = h.where(F.col(END_AT).isNull()).groupBy("user_id").count()
    assert open_rows.where(F.col("count") != 1).count() == 0
    assert open_rows.count() == h.select("user_id").distinct().count()
    # no version repeats its predecessor
    same = (h.withColumn("_prev", F.lag("event_type").over(w))
            .where(F.col("_prev") == F.col("event_type")))
    assert same.count() == 0


def test_split_histories_equal_single_window(spark):
    """Hot keys are split by sequence ranges; the result is the same."""
    ev = read_table(spark, SF_SMALL, "events").select("user_id", "ts", "event_id", "event_type")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).when(F.col("event_id") % 3 == 1, F.col("user_id")))  # one holds a third, no key another
    days = ev.withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    for rows, tie in ((ev, ["event_id"]), (days, ["event_id"]), (days.drop("event_id"), [])):
        single = scd2(rows, ["user_id"], "ts", tiebreak=tie, hot_rows=None)
        for hot in (100, 20):
            split = scd2(rows, ["user_id"], "ts", tiebreak=tie, hot_rows=hot)
            assert single.exceptAll(split).count() == 0, (tie, hot)
            assert split.exceptAll(single).count() == 0, (tie, hot)


def test_split_history_bounds_the_rows_of_a_task(spark):
    """No (key, range) holds more than a few times its share of a hot key."""
    ev = read_table(spark, SF_SMALL, "events").select(F.lit(1).alias("k"), "ts", F.col("event_id").cast("string").alias("v"))
    df = scd2(ev, ["k"], "ts", hot_rows=100)
    assert df.count() == ev.count()
    chunks = ev.agg(F.percentile_approx("ts", [i / 10 for i in range(1, 10)], 10_000).alias("c")).crossJoin(ev).groupBy(
        F.size(F.filter("c", lambda c: c < F.col("ts")))).count()
    assert chunks.agg(F.max("count")).first()[0] <= 2 * ev.count() / 10


def test_scd2_does_not_depend_on_input_order(spark):
    rows = [("k", s, v) for s, v in [(1, "a"), (1, "b"), (1, "a"), (2, "b"), (2, "b"), (3, None), (3, "c"), (4, "c"), (5, "a")]]
    want = [("b", 1, 3), ("c", 3, 5), ("a", 5, None)]
    import random

    for seed in range(4):
        random.Random(seed).shuffle(rows)
        for hot in (None, 2):
            df = scd2(spark.createDataFrame(rows, "k string, s int, v string").repartition(1 + seed), ["k"], "s", hot_rows=hot)
            assert sorted(((r["v"], r[START_AT], r[END_AT]) for r in df.collect()), key=lambda x: x[1]) == want


def test_keys_span_batches_and_facts_have_several_rows(spark):
    from paylake.plans import streams as ST
    from paylake.session import fresh_dir

    work = fresh_dir(spark, "t-span")
    target = ST.run_feed(spark, _raws(spark, SF_SMALL)["users"], "users", work)
    log = spark.read.parquet(target.changes_path)
    assert log.groupBy("user_id").agg(F.countDistinct("batch_id").alias("n")).where("n > 1").count() > 0
    fact = M.fact_transactions(*_dims(spark, SF_SMALL), merchants_bounded=True, users_bounded=True)
    assert fact.agg(F.max("transaction_count")).first()[0] > 1


def test_calendar_ignores_impossible_years(spark):
    tx = spark.createDataFrame([("0001-01-01",), ("2025-02-03",)], "d string").select(F.to_date("d").alias("transaction_date"))
    days = M.dim_date(spark, widen_by=tx).agg(F.min("date").cast("string"), F.max("date").cast("string")).first()
    assert tuple(days) == ("2018-01-01", "2025-02-03")
    assert M.dim_date(spark).count() == 2557  # 2018 to 2024, whatever the data


def test_salted_join_equals_plain_join(spark):
    g_tx, d_user, _ = _dims(spark, SF_SMALL)
    fact = g_tx.select("transaction_id", "user_id", "merchant_id", "PK_Tiempo")
    users = d_user.select("user_id", "user_risk_level")
    plain = fact.join(users, "user_id", "inner")
    # bounds this small make many users hot, with several salts each
    hot = hot_keys(fact, "user_id", fraction=1e-4, rows_per_salt=5)
    assert hot.agg(F.max("_salts")).first()[0] > 1
    salted = salted_join(fact, users, "user_id", hot, salt_by=["transaction_id", "merchant_id", "PK_Tiempo"])
    assert plain.count() == salted.count()
    assert plain.exceptAll(salted.select(*plain.columns)).count() == 0


def test_risk_score_bounds_and_fact_totals(spark):
    g_tx, d_user, d_merchant = _dims(spark, SF_SMALL)
    scored = M.risk_scored_transactions(g_tx, d_user, d_merchant)
    bounds = scored.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert bounds[0] >= 0 and bounds[1] <= 100
    by_branch = scored.where((F.col("transaction_type") != "reversa") & (F.col("risk_score") > 50)).count()
    assert by_branch == 0
    fact = M.fact_from_scored(scored)
    assert fact.agg(F.sum("transaction_count")).first()[0] == scored.count()


def test_gold_has_one_row_per_key(spark):
    raws = _raws(spark, SF_SMALL)
    users = G.gold_users(G.silver_history(raws["users"], "users"))
    assert users.count() == users.select("user_id").distinct().count()
    tx = G.silver_transactions(raws["transactions"])
    assert tx.count() == tx.select("transaction_id", "user_id", "merchant_id").distinct().count()


def test_fact_same_with_broadcast_or_salted_dimensions(spark):
    g_tx, d_user, d_merchant = _dims(spark, SF_SMALL)
    broadcast = M.fact_transactions(g_tx, d_user, d_merchant, merchants_bounded=True, users_bounded=True)
    salted = M.fact_transactions(g_tx, d_user, d_merchant, rows_per_salt=5)
    assert broadcast.count() == salted.count()
    assert broadcast.exceptAll(salted.select(*broadcast.columns)).count() == 0


def test_refresh_levels_and_versions(spark):
    from paylake.plans.refresh import refresh, refresh_levels
    from paylake.registry import _stored_gold
    from paylake.session import fresh_dir

    assert refresh_levels() == [["dim_date", "dim_user", "dim_merchant", "dim_channel"], ["fact_transactions"]]
    assert refresh_levels(["fact_transactions"]) == [["dim_user", "dim_merchant"], ["fact_transactions"]]
    g_tx, g_users, g_merchants = _stored_gold(spark, SF_SMALL)
    gold = {"gold_transactions": g_tx, "gold_users": g_users, "gold_merchants": g_merchants}
    root = fresh_dir(spark, "t-refresh")
    first = {r["mart"]: (r["version"], r["row_count"]) for r in refresh(spark, gold, root).collect()}
    again = {r["mart"]: (r["version"], r["row_count"]) for r in refresh(spark, gold, root, ["dim_channel"]).collect()}
    assert all(v == 0 for v, _ in first.values()) and len(first) == 5
    assert again == {"dim_channel": (1, first["dim_channel"][1])}
