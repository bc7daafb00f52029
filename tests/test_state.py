"""Tables kept up batch by batch against the whole change log."""

import random

import pytest
from pyspark.sql import functions as F

from paylake.operators.cdc import scd1, scd2
from paylake.session import fresh_dir
from paylake.streaming.state import KeyedState

SCHEMA = "k string, seq int, v string, w int"


def changes(seed, n=180, keys=12):
    """Late, tied and repeated changes; one key holds a third."""
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 0.33 else f"k{rnd.randint(0, keys)}", rnd.choice([rnd.randint(0, 60), rnd.randint(0, 60), None]) if rnd.random() < 0.1 else rnd.randint(0, 60),
             rnd.choice(["a", "a", "b", None]), rnd.randint(0, 1)) for _ in range(n)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("leaf_rows, batches", [(1_000_000, 3), (4, 3)])
def test_history_equals_the_whole_log(spark, leaf_rows, batches):
    rows = changes(leaf_rows + batches)
    state = KeyedState(fresh_dir(spark, "t-state"), ("k",), "seq", history=True, buckets=3, leaf_rows=leaf_rows)
    assert state.table(spark) is None
    step = len(rows) // batches
    for b in range(batches):
        state.fold(spark.createDataFrame(rows[b * step:(b + 1) * step], SCHEMA), b)
    done = spark.createDataFrame(rows[:step * batches], SCHEMA)
    assert rows_of(state.table(spark)) == rows_of(scd2(done, ["k"], "seq"))
    if leaf_rows < 10:
        assert state.leaves(spark).agg(F.max("rows")).first()[0] <= leaf_rows
    # a fold that runs again changes nothing
    state.fold(spark.createDataFrame(rows[step * (batches - 1):step * batches], SCHEMA), batches - 1)
    assert rows_of(state.table(spark)) == rows_of(scd2(done, ["k"], "seq"))


@pytest.mark.parametrize("leaf_rows", [3])
def test_newest_rows_equal_the_whole_log(spark, leaf_rows):
    rows = changes(5, keys=40)
    state = KeyedState(fresh_dir(spark, "t-state1"), ("k",), "seq", history=False, buckets=3, leaf_rows=leaf_rows)
    for b in range(3):
        state.fold(spark.createDataFrame(rows[b * 60:(b + 1) * 60], SCHEMA), b)
    assert rows_of(state.table(spark)) == rows_of(scd1(spark.createDataFrame(rows, SCHEMA), ["k"], "seq"))


def test_a_batch_reads_and_writes_the_leaves_it_touches(spark):
    first = [(f"k{i:03d}", 10, "a", 0) for i in range(120)]
    for history in (False, True):
        state = KeyedState(fresh_dir(spark, "t-touch"), ("k",), "seq", history=history, buckets=8, leaf_rows=10)
        assert state.fold(spark.createDataFrame(first, SCHEMA), 0) == []
        before = {r["path"] for r in state.leaves(spark).collect()}
        batch = spark.createDataFrame([("k007", 11, "b", 0), ("k090", 9, "b", 0)], SCHEMA)
        buckets = batch.select(F.pmod(F.xxhash64("k"), F.lit(8))).distinct().count()
        read = state.fold(batch, 1)
        after = {r["path"] for r in state.leaves(spark).collect()}
        assert len(read) == 2 >= buckets and before - after == set(read)
        assert spark.read.parquet(*(after - before)).select("k").distinct().count() < 25  # other keys stay where they are


def test_a_late_change_of_a_long_history_touches_its_neighbours(spark):
    """One key over forty leaves, most of them without a version."""
    rows = [("hot", 2 * i, "a" if i < 50 or 60 < i < 360 else "b", 0) for i in range(400)]
    state = KeyedState(fresh_dir(spark, "t-long"), ("k",), "seq", history=True, buckets=2, leaf_rows=10)
    state.fold(spark.createDataFrame(rows, SCHEMA), 0)
    assert state.leaves(spark).count() == 40
    near = state.fold(spark.createDataFrame([("hot", 785, "c", 0)], SCHEMA), 1)  # down to the version at 720
    assert 3 <= len(near) <= 6
    assert len(state.fold(spark.createDataFrame([("hot", 305, "c", 0)], SCHEMA), 2)) <= 12
    late = rows + [("hot", 785, "c", 0), ("hot", 305, "c", 0)]
    assert rows_of(state.table(spark)) == rows_of(scd2(spark.createDataFrame(late, SCHEMA), ["k"], "seq"))


def test_a_fold_that_dies_leaves_the_old_table(spark, monkeypatch):
    from paylake.streaming import state as S

    state = KeyedState(fresh_dir(spark, "t-dies"), ("k",), "seq", history=True, buckets=2)
    rows = changes(3, 60)
    state.fold(spark.createDataFrame(rows[:30], SCHEMA), 0)
    before = rows_of(state.table(spark))
    with monkeypatch.context() as m:
        m.setattr(S.sinks, "commit_versions", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            state.fold(spark.createDataFrame(rows[30:], SCHEMA), 1)
    assert rows_of(state.table(spark)) == before
    state.fold(spark.createDataFrame(rows[30:], SCHEMA), 1)
    assert rows_of(state.table(spark)) == rows_of(scd2(spark.createDataFrame(rows, SCHEMA), ["k"], "seq"))


@pytest.mark.parametrize("history", [False, True])
def test_a_leaf_is_a_file_that_its_task_wrote_in_order(spark, monkeypatch, history):
    plans, write = [], KeyedState._write

    def watched(self, rows, path):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        write(self, rows, path)

    monkeypatch.setattr(KeyedState, "_write", watched)
    state = KeyedState(fresh_dir(spark, "t-files"), ("k",), "seq", history=history, buckets=3, leaf_rows=10)
    rows = [(f"k{i:03d}", i % 7, "a", i) for i in range(90)]
    state.fold(spark.createDataFrame(rows, SCHEMA), 0)
    state.fold(spark.createDataFrame([(k, seq + 1, "b", w) for k, seq, _, w in rows[::3]], SCHEMA), 1)
    assert "regexp" not in plans[1]  # stored rows are told by their files' names, whole
    for leaf in state.leaves(spark).collect():
        assert leaf["path"].endswith(".parquet") and leaf["rows"] <= 10
        keys = [r["k"] for r in spark.read.parquet(leaf["path"]).collect()]
        assert keys == sorted(keys) and len(keys) == leaf["rows"] and keys[0] == leaf["low"]["k"]
