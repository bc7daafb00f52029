"""Streaming behaviour: batch equivalence, reruns, replays."""

import json

import pytest
from pyspark.sql import functions as F

from samples import SF_SMALL
from paylake.operators.rules import observe_rules, rule_failure_counts, transaction_rules
from paylake.operators.clean import clean_transactions
from paylake.plans import streams as ST
from paylake.registry import _raws
from paylake.session import fresh_dir
from paylake.sources.feeds import load_feed_config
from paylake.streaming.silver import SilverBatchWriter, SilverTarget, read_current


def test_rerun_from_checkpoint_adds_nothing(spark):
    work = fresh_dir(spark, "t-rerun")
    landing = f"{work}/landing/transactions"
    ST.land(_raws(spark, SF_SMALL)["transactions"], "transactions", landing, 3)
    cfg = ST.ingest(spark, "transactions", landing, work)
    first = spark.read.parquet(cfg.target_table).count()
    ST.ingest(spark, "transactions", landing, work)  # same checkpoint: no new files
    assert spark.read.parquet(cfg.target_table).count() == first == _raws(spark, SF_SMALL)["transactions"].count()


def test_batch_split_does_not_change_scd(spark):
    raw = _raws(spark, SF_SMALL)["users"]
    one = read_current(spark, ST.run_feed(spark, raw, "users", fresh_dir(spark, "t-split1"), files=1))
    many = read_current(spark, ST.run_feed(spark, raw, "users", fresh_dir(spark, "t-split5"), files=5))
    assert one.count() == many.count()
    assert one.exceptAll(many.select(*one.columns)).count() == 0


def _replay_counts(spark, feed, seq_type, batch_id=7):
    work = fresh_dir(spark, f"t-replay-{feed}")
    batch = (ST.as_landed(_raws(spark, SF_SMALL)[feed], feed)
             .withColumn("ingestion_at", F.current_timestamp()).withColumn("source_file", F.lit("f1")))
    target = SilverTarget(feed=feed, root=f"{work}/silver", quarantine_path=f"{work}/q",
                          sequence_by="seq", sequence_type=seq_type, run_log_path=f"{work}/log")
    writer = SilverBatchWriter(target)
    tables = [target.quarantine_path, target.changes_path, target.run_log_path]
    out = []
    for _ in range(2):  # the second call replays the same batch id
        writer(batch, batch_id)
        out.append(tuple(spark.read.parquet(p).count() for p in tables))
    return out, read_current(spark, target)


def test_replayed_batch_is_idempotent(spark):
    (first, again), state = _replay_counts(spark, "transactions", "timestamp_ntz")
    assert first == again
    assert "seq" not in state.columns
    (first, again), _ = _replay_counts(spark, "users", "int")
    assert first == again


def test_observation_matches_rule_counts(spark):
    cleaned = clean_transactions(_raws(spark, SF_SMALL)["transactions"])
    observed, obs = observe_rules(cleaned, transaction_rules(), "tx_rules")
    observed.write.format("noop").mode("overwrite").save()
    metrics = obs.get
    counts = {r["expectation"]: r["failed_records"] for r in
              rule_failure_counts(cleaned, transaction_rules()).collect()}
    for name, failed in counts.items():
        assert metrics[name] == failed
    assert metrics["total_records"] == cleaned.count()


def test_feed_config_lookup(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("cfg")
    base = {"target_table": "/t", "partition_by": "country", "file_format": "text", "schema_location": None,
            "delimiter": "|", "header": True, "multiline": False, "source_path": "/l"}
    recs = [dict(base, source_name="users", active=False),
            dict(base, source_name="users", active=True, target_table="/users"),
            dict(base, source_name="merchants", active=False)]
    (d / "feeds.json").write_text(json.dumps(recs))
    cfg = load_feed_config(spark, str(d / "feeds.json"), "users")
    assert cfg.target_table == "/users" and cfg.reader_format == "csv" and cfg.header is True
    assert load_feed_config(spark, str(d / "feeds.json"), "merchants") is None
    with pytest.raises(KeyError):
        load_feed_config(spark, str(d / "feeds.json"), "transactions")


def test_schema_is_remembered(spark):
    from paylake.plans.streams import feed_config, land

    work = fresh_dir(spark, "t-schema")
    landing = f"{work}/landing"
    land(_raws(spark, SF_SMALL)["merchants"], "merchants", landing, 1)
    cfg = feed_config("merchants", landing, f"{work}/bronze")
    from dataclasses import replace

    from paylake.sources.feeds import remembered_schema

    cfg = replace(cfg, schema_location=f"{work}/schema")
    first = remembered_schema(spark, cfg)
    assert [f.name for f in first.fields][:2] == ["merchant_id", "merchant_name"]
    assert spark.read.text(cfg.schema_location).count() == 1
    assert remembered_schema(spark, cfg) == first


def test_sql_mask_functions_match_column_masks(spark):
    from paylake.operators.masking import register_mask_functions

    register_mask_functions(spark, "analista")
    r = spark.sql("SELECT mask_email('ana@x.com'), mask_doc_id('123'), mask_phone('9'), "
                  "mask_name('Ana'), mask_email('bad.mail')").first()
    assert tuple(r) == ("an*****x.com", "#########", "$$$$$$$$$",
                        __import__("hashlib").md5(b"Ana").hexdigest(), "ba*****")
    register_mask_functions(spark, "ingenieria")
    assert spark.sql("SELECT mask_email('ana@x.com')").first()[0] == "ana@x.com"


def test_published_silver_layout_prunes(spark):
    from paylake.plans.layers import layers, publish_silver

    paths = publish_silver(spark, SF_SMALL, fresh_dir(spark, "t-publish"))
    users = spark.read.parquet(paths["users"])
    stored = layers(spark, SF_SMALL)["silver_users"]
    assert users.count() == stored.count()
    pe = users.where(F.col("country") == "PE")
    plan = pe._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan and "(country" in plan
    assert pe.count() == stored.where(F.col("country") == "PE").count()
    tx = spark.read.parquet(paths["transactions"])
    assert tx.count() == layers(spark, SF_SMALL)["silver_transactions"].count()


def test_bronze_partitioned_by_config_column(spark):
    from dataclasses import replace

    from paylake.plans.streams import feed_config, land
    from paylake.streaming.ingest import start_bronze

    work = fresh_dir(spark, "t-bronze-part")
    landing = f"{work}/landing"
    raw = _raws(spark, SF_SMALL)["users"]
    land(raw, "users", landing, 2)
    cfg = replace(feed_config("users", landing, f"{work}/bronze"), partition_by="country")
    start_bronze(spark, cfg, f"{work}/_chk", extra_columns=("seq",)).awaitTermination()
    bronze = spark.read.parquet(cfg.target_table)
    assert bronze.count() == raw.count()
    assert {r[0] for r in bronze.select("country").distinct().collect()} == \
        {r[0] for r in raw.select("country").distinct().collect()}


def test_late_change_revives_dropped_noop(spark):
    """Changes A@10, A@20, A@30 give one version; a late B@15 must split it into
    A@10, B@15, A@20 - the no-op change at 20 becomes a version again (G3)."""
    work = fresh_dir(spark, "t-late")
    target = SilverTarget(feed="users", root=f"{work}/silver", quarantine_path=f"{work}/q",
                          sequence_by="seq", sequence_type="int")
    writer = SilverBatchWriter(target)
    cols = "user_id string, full_name string, document_id string, email string, phone string, country string, " \
           "segment string, registration_date string, seq string, ingestion_at timestamp, source_file string"

    def batch(rows):
        return spark.createDataFrame(
            [("U1", "Ana", "12345678", "a@bb.cc", "+51", "pe", seg, "2020-01-01", str(seq), None, "f") for seg, seq in rows],
            cols)

    writer(batch([("nuevo", 10), ("nuevo", 20), ("nuevo", 30)]), 0)
    assert read_current(spark, target).count() == 1
    writer(batch([("premium", 15)]), 1)
    got = sorted((r["segment"], r["__START_AT"], r["__END_AT"]) for r in read_current(spark, target).collect())
    assert got == [("nuevo", 10, 15), ("nuevo", 20, None), ("premium", 15, 20)]


def test_batch_that_died_midway_is_made_good_by_its_replay(spark, monkeypatch):
    """A crash after the change log was written, before the run log: the
    replay gives the same tables as an undisturbed run."""
    work = fresh_dir(spark, "t-crash")
    raw = _raws(spark, SF_SMALL)["transactions"]
    batch = (ST.as_landed(raw, "transactions").withColumn("ingestion_at", F.current_timestamp())
             .withColumn("source_file", F.lit("f1")))

    def target(name):
        return SilverTarget(feed="transactions", root=f"{work}/{name}", quarantine_path=f"{work}/{name}-q", sequence_by="seq",
                            sequence_type="timestamp_ntz", run_log_path=f"{work}/{name}-log")

    calm, hit = target("calm"), target("hit")
    half = F.pmod(F.crc32("transaction_id"), F.lit(2))
    for n in (0, 1):
        SilverBatchWriter(calm)(batch.where(half == n), n)
    SilverBatchWriter(hit)(batch.where(half == 0), 0)
    writer = SilverBatchWriter(hit)
    monkeypatch.setattr(writer, "_log_progress", lambda *a: (_ for _ in ()).throw(RuntimeError("executor lost")))
    with pytest.raises(RuntimeError):
        writer(batch.where(half == 1), 1)
    SilverBatchWriter(hit)(batch.where(half == 1), 1)
    a, b = read_current(spark, calm), read_current(spark, hit)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    assert spark.read.parquet(hit.run_log_path).select("event_id").distinct().count() == spark.read.parquet(hit.run_log_path).count() == 2


def test_storage_failures_are_errors(spark):
    from paylake.sources.sinks import MANIFEST_SCHEMA, read_or_empty

    assert read_or_empty(spark, fresh_dir(spark, "t-none"), MANIFEST_SCHEMA).count() == 0
    with pytest.raises(Exception):
        read_or_empty(spark, "nosuchfs://x/y", MANIFEST_SCHEMA).count()


def test_failed_refresh_can_be_run_again(spark, monkeypatch):
    from paylake.plans import refresh as R
    from paylake.registry import _stored_gold

    gold = dict(zip(("gold_transactions", "gold_users", "gold_merchants"), _stored_gold(spark, SF_SMALL)))
    root = fresh_dir(spark, "t-refresh-fails")
    with monkeypatch.context() as m:
        m.setattr(R.sinks, "commit_versions", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            R.refresh(spark, gold, root, ["dim_channel"])
    assert [r["version"] for r in R.refresh(spark, gold, root, ["dim_channel"]).collect()] == [0]


def test_published_table_is_overwritten_whole(spark):
    from paylake.sources.sinks import publish_partitioned

    path = fresh_dir(spark, "t-overwrite")
    for day in ("2020-01-01", "2020-01-02"):  # the row moves to another partition
        publish_partitioned(spark.createDataFrame([("T1", day)], "id string, day string"), path, "day")
    assert spark.read.parquet(path).count() == 1
