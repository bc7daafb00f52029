"""Registered queries: name -> ``fn(spark, root) -> DataFrame``.

Names follow SURVEY §7.3. Each query reads the base tables under ``root``
(through the derived feeds of ``paylake.sources.fixtures``) so its work grows
with the data; none runs on made-up input.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.operators.cdc import scd2
from paylake.operators.clean import clean_merchants, clean_transactions, clean_users
from paylake.operators.joins import hot_keys, is_bounded
from paylake.operators.rules import quarantine_records
from paylake.operators.masking import USER_COLUMN_TAGS, USER_TABLE_TAGS, apply_masks, register_views, store_policy, tag_columns
from paylake.plans import changes as C
from paylake.plans import gold as G
from paylake.plans import marts as M
from paylake.plans import runlog as RL
from paylake.plans import silver
from paylake.plans import streams as ST
from paylake.plans.layers import bucket_gold, layers, register_temp_views
from paylake.plans.refresh import refresh
from paylake.plans.scalars import scalar_functions
from paylake.session import fresh_dir
from paylake.sources import fixtures as fx
from paylake.sources.feeds import FEED_COLUMNS, land_files
from paylake.sources.tables import read_table
from paylake.sources.sinks import SILVER_LAYOUT, publish_partitioned
from paylake.sources.sinks import read_current as read_mart
from paylake.streaming.drift import ingest_by_name, schema_versions
from paylake.streaming.silver import read_current, write_snapshot
from paylake.streaming.state import KeyedState, buckets_for

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _raws(spark, root) -> dict[str, DataFrame]:
    return {
        "transactions": fx.raw_transactions(spark, root),
        "users": fx.raw_users(spark, root),
        "merchants": fx.raw_merchants(spark, root),
    }


# --- silver: clean, rules, verdict, split ---------------------------------

@register("clean_transactions")
def q_clean_transactions(spark, root):
    return clean_transactions(fx.raw_transactions(spark, root))


@register("clean_users")
def q_clean_users(spark, root):
    return clean_users(fx.raw_users(spark, root))


@register("clean_merchants")
def q_clean_merchants(spark, root):
    return clean_merchants(fx.raw_merchants(spark, root))


@register("rules_transactions")
def q_rules_transactions(spark, root):
    return silver.rule_counts(fx.raw_transactions(spark, root), "transactions")


@register("rules_users")
def q_rules_users(spark, root):
    return silver.rule_counts(fx.raw_users(spark, root), "users")


@register("rules_merchants")
def q_rules_merchants(spark, root):
    return silver.rule_counts(fx.raw_merchants(spark, root), "merchants")


@register("validated_transactions")
def q_validated_transactions(spark, root):
    return silver.validated(fx.raw_transactions(spark, root), "transactions")


@register("validated_users")
def q_validated_users(spark, root):
    return silver.validated(fx.raw_users(spark, root), "users")


@register("validated_merchants")
def q_validated_merchants(spark, root):
    return silver.validated(fx.raw_merchants(spark, root), "merchants")


@register("limbo_rows")
def q_limbo_rows(spark, root):
    return silver.limbo_union(_raws(spark, root))


@register("quarantine")
def q_quarantine(spark, root):
    return silver.quarantine_union(_raws(spark, root))


@register("expectation_counts")
def q_expectation_counts(spark, root):
    return silver.rule_counts_union(_raws(spark, root))


# --- CDC, gold, marts ------------------------------------------------------


def _silver(spark, root):
    raws = _raws(spark, root)
    return (G.silver_transactions(raws["transactions"]),
            G.silver_history(raws["users"], "users"),
            G.silver_history(raws["merchants"], "merchants"))


def _gold(spark, root):
    s_tx, s_users, s_merchants = _silver(spark, root)
    return G.gold_transactions(s_tx), G.gold_users(s_users), G.gold_merchants(s_merchants)


def _stored(spark, root):
    """Stored silver and gold tables (built once per session from the feeds)."""
    return layers(spark, root)


def _stored_gold(spark, root):
    L = _stored(spark, root)
    return L["gold_transactions"], L["gold_users"], L["gold_merchants"]


def _dims(spark, root):
    """Gold transactions and the two dimensions the fact joins, from stored gold."""
    g_tx, g_users, g_merchants = _stored_gold(spark, root)
    return g_tx, M.dim_user(g_users, g_tx), M.dim_merchant(g_merchants)


def _fact_inputs(spark, root):
    """Fact inputs plus proven size bounds of the two dimensions.

    Each dimension has exactly one row per stored gold user / merchant, so the
    row count of the stored table proves the dimension's size before it may be
    broadcast.
    """
    g_tx, g_users, g_merchants = _stored_gold(spark, root)
    bounds = {"merchants_bounded": is_bounded(g_merchants),
              "users_bounded": is_bounded(g_users)}
    return g_tx, M.dim_user(g_users, g_tx), M.dim_merchant(g_merchants), bounds


def events_history(events, **options):
    """SCD2 over the raw event stream: key user_id, sequence ts (of events of
    one moment the last event_id counts), tracked event_type."""
    return scd2(events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], "ts",
                tiebreak=["event_id"], **options)


@register("scd1_transactions")
def q_scd1_transactions(spark, root):
    return _silver(spark, root)[0]


@register("scd2_users")
def q_scd2_users(spark, root):
    return _silver(spark, root)[1]


@register("scd2_merchants")
def q_scd2_merchants(spark, root):
    return _silver(spark, root)[2]


@register("scd2_events")
def q_scd2_events(spark, root):
    return events_history(read_table(spark, root, "events"))


@register("gold_transactions")
def q_gold_transactions(spark, root):
    return _gold(spark, root)[0]


@register("gold_users")
def q_gold_users(spark, root):
    return _gold(spark, root)[1]


@register("gold_merchants")
def q_gold_merchants(spark, root):
    return _gold(spark, root)[2]


@register("dim_date")
def q_dim_date(spark, root):
    return M.dim_date(spark)


@register("dim_date_widened")
def q_dim_date_widened(spark, root):
    """The calendar widened by the transactions' dates, within two bounds (F2)."""
    return M.dim_date(spark, widen_by=_stored_gold(spark, root)[0])


@register("dim_channel")
def q_dim_channel(spark, root):
    return M.dim_channel(_stored_gold(spark, root)[0])


@register("tx_per_type")
def q_tx_per_type(spark, root):
    return M.tx_per_type(_stored_gold(spark, root)[0])


@register("tx_per_user")
def q_tx_per_user(spark, root):
    return M.tx_per_user(_stored_gold(spark, root)[0])


@register("reversal_rate")
def q_reversal_rate(spark, root):
    return M.reversal_rate(_stored_gold(spark, root)[0])


@register("dim_user")
def q_dim_user(spark, root):
    return _dims(spark, root)[1]


@register("dim_merchant")
def q_dim_merchant(spark, root):
    return _dims(spark, root)[2]


@register("fx_amounts")
def q_fx_amounts(spark, root):
    return M.fx_amounts(_stored_gold(spark, root)[0])


@register("risk_scored_transactions")
def q_risk_scored_transactions(spark, root):
    g_tx, d_user, d_merchant, bounds = _fact_inputs(spark, root)
    return M.risk_scored_transactions(g_tx, d_user, d_merchant, **bounds)


@register("fact_transactions")
def q_fact_transactions(spark, root):
    g_tx, d_user, d_merchant, bounds = _fact_inputs(spark, root)
    return M.fact_transactions(g_tx, d_user, d_merchant, **bounds)


@register("fact_keyed")
def q_fact_keyed(spark, root):
    g_tx, d_user, d_merchant, bounds = _fact_inputs(spark, root)
    return M.fact_keyed(g_tx, d_user, d_merchant, M.dim_channel(g_tx), **bounds)


# --- run log and dashboard ---------------------------------------------------


_PIPE, _CAT = fx.RUN_LOG_PIPELINE, fx.RUN_LOG_CATALOG


def _log(spark, root):
    return fx.raw_run_log(spark, root)


@register("run_log_latest")
def q_run_log_latest(spark, root):
    return RL.run_log_latest(_log(spark, root), _PIPE, _CAT)


@register("run_log_summary")
def q_run_log_summary(spark, root):
    return RL.run_log_summary(_log(spark, root), _PIPE, _CAT)


@register("run_log_rates")
def q_run_log_rates(spark, root):
    return RL.run_log_rates(_log(spark, root), _PIPE, _CAT)


@register("run_log_expectations")
def q_run_log_expectations(spark, root):
    return RL.run_log_expectations(_log(spark, root), _PIPE, _CAT)


@register("run_log_by_table")
def q_run_log_by_table(spark, root):
    return RL.run_log_by_table(_log(spark, root), _PIPE, _CAT, "transactions")


@register("dash_detail")
def q_dash_detail(spark, root):
    return RL.dash_detail(RL.run_log_rates(_log(spark, root), _PIPE, _CAT))


@register("dash_rate_by_table")
def q_dash_rate_by_table(spark, root):
    return RL.dash_rate_by_table(RL.run_log_rates(_log(spark, root), _PIPE, _CAT))


_EXP_TABLE = f"{_CAT}.{RL.DEFAULT_EXPECTATION_TABLE}"


@register("dash_rejected_by_rule")
def q_dash_rejected_by_rule(spark, root):
    return RL.dash_rejected_by_rule(RL.run_log_expectations(_log(spark, root), _PIPE, _CAT), _EXP_TABLE)


@register("dash_max_rate_month")
def q_dash_max_rate_month(spark, root):
    return RL.dash_max_rate_month(RL.run_log_expectations(_log(spark, root), _PIPE, _CAT), _EXP_TABLE)


@register("dash_avg_rate_month")
def q_dash_avg_rate_month(spark, root):
    return RL.dash_avg_rate_month(RL.run_log_expectations(_log(spark, root), _PIPE, _CAT), _EXP_TABLE)


@register("dash_rejected_by_day")
def q_dash_rejected_by_day(spark, root):
    return RL.dash_rejected_by_day(RL.run_log_expectations(_log(spark, root), _PIPE, _CAT))


@register("dash_filter_values")
def q_dash_filter_values(spark, root):
    return RL.dash_filter_values(_log(spark, root), _PIPE, _CAT)


# --- masking and scalar functions -----------------------------------------


ANALYST_ROLE = "analista"


@register("masked_users")
def q_masked_users(spark, root):
    users = tag_columns(_stored(spark, root)["silver_users"], USER_COLUMN_TAGS)
    return apply_masks(users, ANALYST_ROLE)


@register("scalar_functions")
def q_scalar_functions(spark, root):
    return scalar_functions(fx.raw_transactions(spark, root))


# --- streaming (result equals the batch oracle) ------------------------------


@register("ingest_stream")
def q_ingest_stream(spark, root):
    """Bronze table after streaming the landed transaction files (A1-A5, G8);
    lineage columns (ingestion time, file name) are left out of the result."""
    work = fresh_dir(spark, "ingest-stream")
    landing = f"{work}/landing/transactions"
    raw = fx.raw_transactions(spark, root)
    files = ST.landing_files(raw)
    ST.land(raw, "transactions", landing, files)
    cfg = ST.ingest(spark, "transactions", landing, work)
    return spark.read.parquet(cfg.target_table).drop("ingestion_at", "source_file", "_corrupt_record")


@register("quarantine_stream")
def q_quarantine_stream(spark, root):
    """Quarantine table filled by the three silver streams."""
    work = fresh_dir(spark, "quarantine-stream")
    raws = _raws(spark, root)
    target = None
    for feed in silver.FEEDS:
        target = ST.run_feed(spark, raws[feed], feed, work)
    return spark.read.parquet(target.quarantine_path).select("payload", "rejected_by")


@register("scd1_stream")
def q_scd1_stream(spark, root):
    work = fresh_dir(spark, "scd1-stream")
    return read_current(spark, ST.run_feed(spark, fx.raw_transactions(spark, root), "transactions", work))


@register("scd2_stream")
def q_scd2_stream(spark, root):
    work = fresh_dir(spark, "scd2-stream")
    return read_current(spark, ST.run_feed(spark, fx.raw_users(spark, root), "users", work))


@register("scd2_stream_out_of_order")
def q_scd2_stream_out_of_order(spark, root):
    """Resends (seq 1) land before first loads (seq 0); the sequence column,
    not arrival, orders versions (G3)."""
    work = fresh_dir(spark, "scd2-ooo-stream")
    target = ST.run_feed(spark, fx.raw_users(spark, root), "users", work,
                         order=[F.col("seq") == 1, F.col("seq") == 0])
    return read_current(spark, target)


@register("run_log_stream_totals")
def q_run_log_stream_totals(spark, root):
    """Run log written by the silver streams, one event per micro-batch
    (A13, G7); per-rule failures summed over the events."""
    work = fresh_dir(spark, "runlog-stream")
    raws = _raws(spark, root)
    log_path = f"{work}/run_log"
    for feed in silver.FEEDS:
        ST.run_feed(spark, raws[feed], feed, work, run_log_path=log_path)
    return RL.expectation_totals(spark.read.parquet(log_path), _PIPE)


# --- materialised marts ------------------------------------------------------


@register("refresh_marts")
def q_refresh_marts(spark, root):
    """Refresh all marts in dependency order into a fresh folder (A11, A12);
    one row per committed mart with its row count."""
    g_tx, g_users, g_merchants = _stored_gold(spark, root)
    gold = {"gold_transactions": g_tx, "gold_users": g_users, "gold_merchants": g_merchants}
    return refresh(spark, gold, fresh_dir(spark, "marts")).select("mart", "row_count")


@register("gold_stream")
def q_gold_stream(spark, root):
    """Gold transactions rebuilt from the streaming SCD1 snapshot."""
    work = fresh_dir(spark, "gold-stream")
    target = ST.run_feed(spark, fx.raw_transactions(spark, root), "transactions", work)
    return G.gold_transactions(read_current(spark, target))


@register("run_log_by_table_users")
def q_run_log_by_table_users(spark, root):
    return RL.run_log_by_table(_log(spark, root), _PIPE, _CAT, "users")


@register("run_log_by_table_merchants")
def q_run_log_by_table_merchants(spark, root):
    return RL.run_log_by_table(_log(spark, root), _PIPE, _CAT, "merchants")


# --- ties, late batches, committed marts, page defaults ----------------------


@register("scd2_ties")
def q_scd2_ties(spark, root):
    """SCD2 where most changes of a key share their sequence (the day): the
    last by value counts, whatever order the rows come in (E4, G2)."""
    days = read_table(spark, root, "events").select("user_id", F.col("ts").cast("date").alias("day"), "event_type")
    return scd2(days, ["user_id"], "day")


@register("scd2_stream_one_batch")
def q_scd2_stream_one_batch(spark, root):
    """Users streamed with the reference's own sequence, the ingestion time: a
    whole batch ties, so each key has one version, its greatest row (G2, E4)."""
    work = fresh_dir(spark, "scd2-batch-stream")
    cfg = ST.land_and_ingest(spark, fx.raw_users(spark, root), "users", work, files=1)
    history = read_current(spark, ST.silver(spark, "users", cfg.target_table, work, "ingestion_at", whole=True))
    return history.drop("__START_AT")


@register("scd2_merchants_stream")
def q_scd2_merchants_stream(spark, root):
    work = fresh_dir(spark, "scd2-merchants-stream")
    return read_current(spark, ST.run_feed(spark, fx.raw_merchants(spark, root), "merchants", work))


@register("scd1_stream_out_of_order")
def q_scd1_stream_out_of_order(spark, root):
    """Newer transactions land first; a transaction's earlier state, derived
    from the same row, lands last and must not win (G1, G3)."""
    work = fresh_dir(spark, "scd1-ooo-stream")
    raw = fx.raw_transactions(spark, root)
    older = raw.withColumn("status", F.lit("Pendiente")).withColumn("ingestion_at", F.expr("ingestion_at - INTERVAL '1' DAY"))
    both = raw.withColumn("late", F.lit(0)).unionByName(older.withColumn("late", F.lit(1)))
    target = ST.run_feed(spark, both, "transactions", work, ST.landing_files(raw), order=[F.col("late") == 0, F.col("late") == 1])
    return read_current(spark, target)


def _gold_of_stream(spark, root, feed, raw, build):
    target = ST.run_feed(spark, raw, feed, fresh_dir(spark, f"gold-{feed}-stream"))
    return build(spark.read.parquet(write_snapshot(spark, target)))


@register("gold_users_stream")
def q_gold_users_stream(spark, root):
    return _gold_of_stream(spark, root, "users", fx.raw_users(spark, root), G.gold_users)


@register("gold_merchants_stream")
def q_gold_merchants_stream(spark, root):
    return _gold_of_stream(spark, root, "merchants", fx.raw_merchants(spark, root), G.gold_merchants)


@register("published_users")
def q_published_users(spark, root):
    """Silver users as published, partitioned by country."""
    path = fresh_dir(spark, "published-users")
    publish_partitioned(_stored(spark, root)["silver_users"], path, SILVER_LAYOUT["users"])
    return spark.read.parquet(path)


@register("published_transactions")
def q_published_transactions(spark, root):
    """Silver transactions as published, partitioned by date."""
    path = fresh_dir(spark, "published-transactions")
    publish_partitioned(_stored(spark, root)["silver_transactions"], path, SILVER_LAYOUT["transactions"])
    return spark.read.parquet(path)


@register("committed_fact")
def q_committed_fact(spark, root):
    """Contents of the fact as committed by a refresh."""
    g_tx, g_users, g_merchants = _stored_gold(spark, root)
    path = fresh_dir(spark, "marts-fact")
    refresh(spark, {"gold_transactions": g_tx, "gold_users": g_users, "gold_merchants": g_merchants}, path, ["fact_transactions"]).collect()
    return read_mart(spark, path, "fact_transactions")


@register("ingest_config_stream")
def q_ingest_config_stream(spark, root):
    """Bronze tables of the feeds that the config lists as active (A1, A3-A5):
    remembered schema, a quoted line break, a partition column, and the folder
    of the source file. Transactions are listed but inactive."""
    work = fresh_dir(spark, "ingest-config")
    raws = _raws(spark, root)
    broken = raws["users"].withColumn("full_name", F.concat(F.lit("Sr.\n"), "full_name"))
    config = ST.write_config(spark, work, {"users": ("country", True), "merchants": (None, False), "transactions": (None, False)}, active=("users", "merchants"))
    for feed, raw in (("users", broken), ("merchants", raws["merchants"]), ("transactions", raws["transactions"])):
        ST.land(raw, feed, f"{work}/landing/{feed}", ST.landing_files(raws[feed]))
    tables = ST.run_ingest(spark, config, work)
    parts = []
    for feed, cfg in tables.items():
        key, name = {"users": ("user_id", "full_name"), "merchants": ("merchant_id", "merchant_name")}[feed]
        parts.append(spark.read.parquet(cfg.target_table).select(
            F.lit(feed).alias("feed"), F.col(key).alias("id"), F.col(name).alias("name"), "country",
            F.col("source_file").rlike("^part-.*[.]csv$").alias("from_file"), F.col("ingestion_at").isNotNull().alias("timed")))
    return parts[0].unionByName(parts[1])


@register("dash_rate_by_table_page")
def q_dash_rate_by_table_page(spark, root):
    """D6 under the page's default layer."""
    rates = RL.run_log_rates(_log(spark, root), _PIPE, _CAT)
    return RL.dash_rate_by_table(rates.where(F.col("layer") == RL.DEFAULT_LAYER))


def _page_expectations(spark, root):
    e = RL.run_log_expectations(_log(spark, root), _PIPE, _CAT)
    return e.where(F.col("processing_date") == F.lit(RL.DEFAULT_EXPECTATION_DATE))


@register("dash_rejected_by_rule_page")
def q_dash_rejected_by_rule_page(spark, root):
    """D7 under the page's default date."""
    return RL.dash_rejected_by_rule(_page_expectations(spark, root), _EXP_TABLE)


@register("dash_rate_month_page")
def q_dash_rate_month_page(spark, root):
    """D8 and D9 under the page's default date."""
    e = _page_expectations(spark, root)
    return RL.dash_max_rate_month(e, _EXP_TABLE).join(RL.dash_avg_rate_month(e, _EXP_TABLE), "month")


@register("quarantine_reference")
def q_quarantine_reference(spark, root):
    """The reference's null policy and slot trail."""
    parts = [quarantine_records(silver.validated(raw, feed, "reference", "slots"), silver.PAYLOAD_COLUMNS[feed]).select("payload", "rejected_by")
             for feed, raw in _raws(spark, root).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- tables kept up batch by batch -------------------------------------------


@register("scd1_stream_incremental")
def q_scd1_stream_incremental(spark, root):
    """SCD1 kept up by every batch from the leaves it touches (G1); older
    states of the same rows land last and must not win (G3)."""
    raw = fx.raw_transactions(spark, root)
    older = raw.withColumn("status", F.lit("Pendiente")).withColumn("ingestion_at", F.expr("ingestion_at - INTERVAL '1' DAY"))
    both = raw.withColumn("late", F.lit(0)).unionByName(older.withColumn("late", F.lit(1)))
    target = ST.run_feed(spark, both, "transactions", fresh_dir(spark, "scd1-state"), ST.landing_files(raw),
                         order=[F.col("late") == 0, F.col("late") == 1], keep_state=True)
    return target.state.table(spark)


@register("scd2_stream_incremental")
def q_scd2_stream_incremental(spark, root):
    """SCD2 by interval splices, resends before first loads."""
    target = ST.run_feed(spark, fx.raw_users(spark, root), "users", fresh_dir(spark, "scd2-state"),
                         order=[F.col("seq") == 1, F.col("seq") != 1], keep_state=True)
    return target.state.table(spark)


@register("scd2_ties_incremental")
def q_scd2_ties_incremental(spark, root):
    """Three folds of changes that mostly share their sequence."""
    days = read_table(spark, root, "events").select("user_id", F.col("ts").cast("date").alias("day"), "event_type", (F.col("event_id") % 3).alias("batch"))
    state = KeyedState(fresh_dir(spark, "ties-state"), ("user_id",), "day", history=True)
    for b in range(3):
        state.fold(days.where(F.col("batch") == b).drop("batch"), b)
    return state.table(spark)


# --- masks bound to tables, views for SQL users ------------------------------


@register("masked_view")
def q_masked_view(spark, root):
    """Users as an analyst sees them through SQL: the policy stored beside the
    table decides what its view masks (H6, H7)."""
    policy = fresh_dir(spark, "policy")
    store_policy(spark, policy, "silver_users", USER_TABLE_TAGS, USER_COLUMN_TAGS)
    tables = {n: _stored(spark, root)[n] for n in ("silver_users", "silver_merchants")}
    names = register_views(spark, policy, tables, ANALYST_ROLE, prefix="as_analyst_")
    return spark.sql(f"SELECT * FROM {names['silver_users']}")


@register("view_totals")
def q_view_totals(spark, root):
    """Totals by country and channel, in SQL over the gold views."""
    L = _stored(spark, root)
    register_temp_views({n: L[n] for n in ("gold_transactions", "gold_users")})
    return spark.sql("SELECT u.country, t.channel, count(*) AS transactions, sum(t.amount) AS total_amount "
                     "FROM gold_transactions t JOIN gold_users u ON t.user_id = u.user_id GROUP BY u.country, t.channel")


# --- feeds that change their columns -----------------------------------------


@register("ingest_drift_stream")
def q_ingest_drift_stream(spark, root):
    """Users in files of three kinds (A3): columns in another order, one more
    column, and one column missing; every row is read by its file's header."""
    work = fresh_dir(spark, "drift-stream")
    landing = f"{work}/landing"
    raw = ST.as_landed(fx.raw_users(spark, root), "users")
    kind = (F.substring("user_id", 2, 20).cast("int") + F.col("seq").cast("int")) % 3
    known = [*FEED_COLUMNS["users"], "seq"]
    land_files(raw.where(kind == 0).select(*reversed(known)), landing, F.lit(0), 1, ST.DELIMITER)
    land_files(raw.where(kind == 1).select("user_id", F.length("full_name").cast("string").alias("Loyalty"), *known[1:]), landing, F.lit(0), 1, ST.DELIMITER)
    land_files(raw.where(kind == 2).select(*[c for c in known if c != "phone"]), landing, F.lit(0), 1, ST.DELIMITER)
    cfg = dataclasses.replace(ST.feed_config("users", landing, f"{work}/bronze"), schema_location=f"{work}/schema")
    rows = ingest_by_name(spark, "users", cfg, known, work, max_bytes_per_trigger=ST.batch_bytes(spark, landing))
    versions = schema_versions(spark, cfg.schema_location).agg(F.max("version").alias("newest"))
    return rows.select(*known, F.col("_rescued_data")["loyalty"].alias("loyalty")).crossJoin(F.broadcast(versions))  # one row


# --- gold and the fact kept up from changes ----------------------------------


_PROJECTIONS = {"transactions": G.gold_transactions, "users": G.gold_users, "merchants": G.gold_merchants}


def _two_folds(spark, root, feed, work):
    """A silver state in two folds (the second has resends and every third key
    of the rest) and its gold table."""
    raw = _raws(spark, root)[feed]
    valid = silver.valid(raw, feed)
    keys, seq = silver.KEYS[feed], G.SEQUENCE[feed]
    rows = valid.drop(*[c for c in silver.EXCEPT_COLUMNS if c != seq])
    late = F.pmod(F.xxhash64(*keys), F.lit(3)) == 0
    if feed != "transactions":
        late = late | (F.col(seq) > 0)
    stored = sum(ST.stored_bytes(spark, f) for f in {f.rsplit("/", 1)[0] for f in raw.inputFiles()})
    state = KeyedState(f"{work}/silver/{feed}", keys, seq, history=feed != "transactions", buckets=buckets_for(stored))
    state.fold(rows.where(~late), 0, raw)
    state.fold(rows.where(late), 1, raw)
    return C.GoldTable(f"{work}/gold/{feed}", state, _PROJECTIONS[feed])


def _gold_changes(spark, root, feed):
    """Gold after the first silver fold, then the second one's changes put in."""
    gold = _two_folds(spark, root, feed, fresh_dir(spark, f"gold-changes-{feed}"))
    gold.catch_up(spark, upto=0)
    gold.catch_up(spark)
    return gold.table(spark)


@register("gold_changes_transactions")
def q_gold_changes_transactions(spark, root):
    return _gold_changes(spark, root, "transactions")


@register("gold_changes_users")
def q_gold_changes_users(spark, root):
    return _gold_changes(spark, root, "users")


@register("gold_changes_merchants")
def q_gold_changes_merchants(spark, root):
    return _gold_changes(spark, root, "merchants")


@register("fact_incremental")
def q_fact_incremental(spark, root):
    """The fact from partial aggregates: the first refresh adds all, the second
    takes changed transactions away and adds them anew (A12)."""
    work = fresh_dir(spark, "fact-incremental")
    gold = {f: _two_folds(spark, root, f, work) for f in silver.FEEDS}
    for g in gold.values():
        g.catch_up(spark, upto=0)
        g.catch_up(spark)
    at = [C.Gold(*[gold[f].table_at(spark, n) for f in ("transactions", "users", "merchants")]) for n in (0, 1)]
    bounds = {"merchants_bounded": is_bounded(at[1].merchants), "users_bounded": is_bounded(at[1].users)}
    C.add_delta(spark, work, C.fact_delta(None, at[0], None, **bounds), 0)
    C.add_delta(spark, work, C.fact_delta(at[0], at[1], gold["transactions"].changes(spark, 0, 1), **bounds), 1)
    return C.fact(spark, work)


@register("fact_bucketed")
def q_fact_bucketed(spark, root):
    """The fact from gold tables bucketed by user (C3): its join with the users
    and the reversal rates shuffles nothing. With a hot user, salted instead."""
    g_merchants = _stored_gold(spark, root)[2]
    gold = bucket_gold(spark, root)
    d_user = M.dim_user(gold["gold_users"].hint("merge"), gold["gold_transactions"])
    return M.fact_transactions(gold["gold_transactions"], d_user, M.dim_merchant(g_merchants), merchants_bounded=is_bounded(g_merchants),
                               users_bucketed=hot_keys(gold["gold_transactions"], "user_id") is None)
