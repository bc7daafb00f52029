"""Plan checks: native expressions only, pruning and pushdown,
bounded broadcasts, partial aggregation."""

from samples import SF_SMALL
from paylake import registry


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_workers_in_silver_or_marts(spark):
    for name in ("clean_transactions", "validated_users", "scd1_transactions", "dim_user",
                 "fact_transactions", "run_log_rates", "masked_users", "scalar_functions"):
        text = plan_text(registry.QUERIES[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_scan_prunes_columns_and_pushes_filters(spark):
    from paylake.sources.tables import read_table
    from paylake.registry import events_history

    df = events_history(read_table(spark, SF_SMALL, "events").where("user_id = 7"))
    text = plan_text(df)
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,7)]" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_channel_lookup_is_broadcast(spark):
    text = plan_text(registry.QUERIES["fact_keyed"](spark, SF_SMALL))
    assert "BroadcastExchange" in text


def test_scd1_and_latest_event_reduce_map_side(spark):
    """Top-1 per key is cut down per task before the shuffle."""
    df = registry.QUERIES["scd1_transactions"](spark, SF_SMALL)
    df.collect()
    assert "WindowGroupLimit" in plan_text(df)
    text = plan_text(registry.QUERIES["run_log_latest"](spark, SF_SMALL))
    assert "partial_max_by" in text


def test_reversal_rate_is_one_aggregate(spark):
    text = plan_text(registry.QUERIES["reversal_rate"](spark, SF_SMALL))
    # SCD1 of the transactions (partial + final) and the per-user counts (partial + final)
    assert text.count("Join") == 0


def test_scd2_is_one_shuffle_on_ordinary_data(spark):
    for name in ("scd2_users", "scd2_merchants", "scd2_ties"):
        text = plan_text(registry.QUERIES[name](spark, SF_SMALL))
        assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text, name


def test_unbounded_fact_scans_gold_once_per_use(spark):
    """The salted path reads the gold transactions for the rates and for the
    fact; hot keys are found before, and no limit gathers rows in one task."""
    from paylake.plans import marts as M
    from paylake.registry import _dims

    for options in ({}, {"rows_per_salt": 5}):
        text = plan_text(M.risk_scored_transactions(*_dims(spark, SF_SMALL), **options))
        assert "Limit" not in text and "Subquery" not in text
        assert text.count("gold_transactions") <= 2, text.count("gold_transactions")


def test_changed_source_is_seen(spark, tmp_path_factory):
    """Landed feeds are kept by the state of their sources."""
    import shutil

    from paylake.sources import fixtures as fx

    root = str(tmp_path_factory.mktemp("source"))
    shutil.copy(f"{SF_SMALL}/supplier.parquet", f"{root}/supplier.parquet")
    first = fx.raw_merchants(spark, root).count()
    assert fx.raw_merchants(spark, root).inputFiles() == fx.raw_merchants(spark, root).inputFiles()
    shutil.copy("/root/testdata/sf0.01/supplier.parquet", f"{root}/supplier.parquet")
    assert fx.raw_merchants(spark, root).count() > first


def test_bucketed_fact_joins_without_a_shuffle(spark):
    """Neither the rates, the joins with users, nor the fact's aggregate (its keys hold the user) move a row."""
    df = registry.QUERIES["fact_bucketed"](spark, SF_SMALL)
    text = plan_text(df)
    assert "Exchange hashpartitioning" not in text, text
    assert text.count("SortMergeJoin") == 2


def test_selector_lists_scan_the_log_once(spark):
    text = plan_text(registry.QUERIES["dash_filter_values"](spark, SF_SMALL))
    assert text.count("FileScan") == 1 and text.count("Exchange") <= 3


def test_building_a_query_reads_no_rows(spark):
    """The state of the sources comes from the listing."""
    from paylake.sources import fixtures as fx

    fx.raw_transactions(spark, SF_SMALL)  # landed once
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    spark.sparkContext.setJobGroup("build", "build")
    fx._source_state(spark, SF_SMALL, "lineitem")
    fx.raw_transactions(spark, SF_SMALL)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 1, (before, jobs)  # at most the schema from a footer
