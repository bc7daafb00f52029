"""Steps that every row passes: how often they move, sort or count it."""

import uuid

from pyspark.sql import functions as F

from samples import SF_SMALL
from paylake.operators.cdc import scd1
from paylake.session import fresh_dir
from paylake.sources import fixtures as fx
from paylake.sources.feeds import land_files


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs_of(spark, action):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_large_feed_is_landed_by_the_tasks_that_derive_it(spark, monkeypatch):
    monkeypatch.setattr(fx, "SPREAD_BYTES", 0, raising=False)
    monkeypatch.setattr(fx, "_LANDED", {})
    landed, derived = fx.landed_view(spark, SF_SMALL, "raw_merchants"), fx.raw_view(spark, SF_SMALL, "raw_merchants")
    assert len(landed.inputFiles()) <= derived.rdd.getNumPartitions()  # not dealt anew
    assert sorted(map(tuple, landed.collect()), key=repr) == sorted(map(tuple, derived.collect()), key=repr)


def test_a_split_value_is_a_file_without_a_pass_of_its_own(spark):
    path = fresh_dir(spark, "t-land")
    rows = spark.range(1_000).select(F.col("id").cast("string"))
    assert jobs_of(spark, lambda: land_files(rows, path, F.pmod(F.crc32("id"), F.lit(7)), 7)) <= 2  # the rows move, the files are written
    read = spark.read.option("header", True).csv(path)
    files = read.select("id", F.col("_metadata.file_name").alias("f")).groupBy("f").agg(F.countDistinct(F.pmod(F.crc32("id"), F.lit(7))).alias("n"), F.count("id").alias("rows"))
    assert [(r["n"]) for r in files.collect()] == [1] * 7 and files.agg(F.sum("rows")).first()[0] == 1_000


def test_newest_rows_are_sorted_once(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}" if i % 7 else None, i // 2, f"v{i % 5}", None if i % 4 else i) for i in range(3_000)]
    changes = spark.createDataFrame(rows, "k string, seq int, v string, w int")
    plain = scd1(changes, ["k"], "seq")
    assert plan_text(plain).count("Sort [") == 1
    by_key = {}
    for k, *rest in rows:
        by_key[k] = max(by_key.get(k, (-1,)), (rest[0], rest[1], -1 if rest[2] is None else rest[2]))
    want = sorted([(k, v, None if w == -1 else w) for k, (_, v, w) in by_key.items()], key=repr)
    assert sorted(map(tuple, plain.collect()), key=repr) == want
    # a crowded place is cut down before it moves
    hot = scd1(changes, ["k"], "seq", hot_rows=500)
    assert "Partial" in plan_text(hot) and "Union" in plan_text(hot)
    assert sorted(map(tuple, hot.collect()), key=repr) == want


def test_a_fold_cuts_a_hot_key_down_before_it_moves(spark, monkeypatch):
    from paylake.streaming import state as S

    monkeypatch.setattr(S, "HOT_ROWS", 20, raising=False)
    rows = [("hot" if i % 3 == 0 else f"k{i % 40}", (i * 37) % 101, f"v{i % 5}", i % 2) for i in range(400)]
    state = S.KeyedState(fresh_dir(spark, "t-hot"), ("k",), "seq", history=False, buckets=2)
    schema = "k string, seq int, v string, w int"
    for b in range(2):
        changes = spark.createDataFrame(rows[b * 200:(b + 1) * 200], schema)
        placed = changes.withColumns({"_leaf": F.lit(0), "_run": F.lit(0)})
        assert state._thinned(placed, changes).where("k = 'hot'").count() == 1
        state.fold(changes, b)
    want = scd1(spark.createDataFrame(rows, schema), ["k"], "seq")
    assert sorted(map(tuple, state.table(spark).collect())) == sorted(map(tuple, want.collect()))


def test_a_feed_of_many_files_is_landed_in_turns_where_it_lies(spark, monkeypatch):
    from paylake.plans import streams as ST

    work, raw = fresh_dir(spark, "t-turns"), fx.raw_merchants(spark, SF_SMALL)
    monkeypatch.setattr(ST, "LANDING_FILE_BYTES", 1)
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    ST.land(raw, "merchants", f"{work}/landing", 8)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group)] == [1] * ST.BATCHES  # nothing is shuffled
    read = spark.read.option("sep", "|").option("header", True).csv(f"{work}/landing")
    turn = F.pmod(F.crc32(F.concat_ws("|", *read.columns)), F.lit(ST.BATCHES))
    files = read.groupBy(F.col("_metadata.file_name")).agg(F.countDistinct(turn).alias("n")).collect()
    assert len(files) >= ST.BATCHES and {r["n"] for r in files} == {1}
    cfg = ST.ingest(spark, "merchants", f"{work}/landing", work)
    columns = ST.as_landed(raw, "merchants").columns
    assert sorted(map(tuple, spark.read.parquet(cfg.target_table).select(*columns).collect()), key=repr) == sorted(map(tuple, ST.as_landed(raw, "merchants").collect()), key=repr)
