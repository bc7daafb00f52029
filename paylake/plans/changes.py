"""Gold and the fact kept up from changes.

Two committed folds of a silver table differ in some leaves; their rows before
and after, compared by key and row, are the gold rows that were inserted,
updated or deleted. A table of newest rows also knows which fold set a row and
which brought its key: rows of new keys are inserts without a comparison, and only
rows set anew are compared with what they were. Gold is a keyed state of its own
that takes the changes in.

The fact keeps partial aggregates (sum and counts per fact key) as a list of
additions. A refresh takes the scored transactions that changed away with
their old values and adds the new ones: those whose own row changed, and those
of users and merchants whose dimension row changed what the score reads. User and
merchant are part of a transaction's key, so each side tells the latter by itself.
Readers add the parts up; :func:`compact` writes them as one.
"""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.plans import marts as M
from paylake.session import fresh_dir
from paylake.sources import sinks
from paylake.streaming.state import KeyedState

OP = "op"
FOLD = "_fold"
GONE = "_deleted"
SIGN = "_sign"
FACT_KEYS = ("PK_Tiempo", "user_id", "merchant_id", "channel_id")


def row_changes(before: DataFrame | None, after: DataFrame | None, keys, how: str = "full_outer") -> DataFrame:
    """Rows of ``after`` that are new or differ (``op`` insert or update), and
    rows of ``before`` whose key is gone (delete; not looked for if ``how`` is
    left). Keys are unique. Both rows
    are there after the join, so they are compared themselves, not by hashes
    that would have to move with them. Without one of the sides nothing moves."""
    if before is None or after is None:
        rows, op = (after, "insert") if before is None else (before, "delete")
        return rows.withColumn(OP, F.lit(op))
    old = before.select(F.struct(*after.columns).alias("_was"), *[F.col(k).alias(f"_k_{k}") for k in keys])
    new = after.select(F.struct(*after.columns).alias("_is"), *keys)
    same = [new[k].eqNullSafe(old[f"_k_{k}"]) for k in keys]
    both = new.join(old, same, how).where(~F.col("_was").eqNullSafe(F.col("_is")))
    op = F.when(F.col("_was").isNull(), "insert").when(F.col("_is").isNull(), "delete").otherwise("update")
    return both.select(F.coalesce("_is", "_was").alias("r"), op.alias(OP)).select("r.*", OP)


@dataclasses.dataclass(frozen=True)
class GoldTable:
    """A gold table kept up from the folds of a silver one; ``project`` is the
    batch projection of the silver table to gold."""

    root: str
    silver: KeyedState
    project: object

    @property
    def state(self) -> KeyedState:
        return KeyedState(self.root, self.silver.keys, FOLD, history=False, buckets=self.silver.buckets)

    def changes(self, spark: SparkSession, older: int | None, newer: int) -> DataFrame:
        """Gold rows that changed between two silver folds, with their ``op``."""
        gold = [None if rows is None else self._gold(rows) for rows in self.silver.between(spark, older, newer)]
        if gold[0] is None or gold[1] is None or self.silver.history:
            return row_changes(*gold, self.silver.keys)
        come, anew = self.silver.set_between(spark, older, newer)
        inserts = row_changes(None, self._gold(come), self.silver.keys)
        if anew.isEmpty():  # then no stored row need be moved to be compared
            return inserts
        return inserts.unionByName(row_changes(gold[0], self._gold(anew), self.silver.keys, "left"))

    def _gold(self, rows: DataFrame) -> DataFrame:
        return self.project(self.silver.as_table(rows))

    def catch_up(self, spark: SparkSession, upto: int | None = None) -> list[int]:
        """Take in all silver folds (up to one) that gold has not seen, in one go."""
        done, there = self.state.folds(spark), [n for n in self.silver.folds(spark) if upto is None or n <= upto]
        older = done[-1] if done else None
        fresh = [n for n in there if older is None or n > older]
        if fresh:
            rows = self.changes(spark, older, fresh[-1])
            if older is not None:  # a fold looks for its leaves before it puts rows in: changes are found once
                rows = stored_once(rows, "changes")
            rows = rows.withColumn(GONE, F.col(OP) == "delete").drop(OP).withColumn(FOLD, F.lit(fresh[-1]))
            self.state.fold(rows, fresh[-1])
        return fresh

    def table(self, spark: SparkSession) -> DataFrame:
        return self.state.table(spark).where(~F.col(GONE)).drop(GONE)

    def table_at(self, spark: SparkSession, number: int) -> DataFrame:
        """Gold as a fold left it."""
        paths = [r["path"] for r in self.state.leaves_at(spark, number).select("path").collect()]
        return self.state.as_table(spark.read.parquet(*paths)).where(~F.col(GONE)).drop(GONE)


def stored_once(rows: DataFrame, name: str) -> DataFrame:
    """Rows that several jobs read, written to a folder of their own."""
    path = fresh_dir(rows.sparkSession, name)
    rows.write.option("compression", sinks.CODEC).parquet(path)
    return rows.sparkSession.read.parquet(path)


def partials(scored: DataFrame, sign: int) -> DataFrame:
    """Sums and counts per fact key, taken away with ``sign`` -1."""
    return signed_partials(scored.withColumn(SIGN, F.lit(sign)))


def signed_partials(scored: DataFrame) -> DataFrame:
    """Sums and counts per fact key of rows that say whether they are added or taken away."""
    sign = F.col(SIGN)
    signed = lambda c: F.when(sign < 0, -F.col(c)).otherwise(F.col(c))
    return scored.groupBy(*FACT_KEYS).agg(
        F.sum(signed("amount")).cast("decimal(28,2)").alias("amount"), F.sum(signed("risk_score")).cast("bigint").alias("risk"),
        F.coalesce(F.sum(F.when(F.col("transaction_type") == M.REVERSAL, sign)), F.lit(0)).cast("bigint").alias("reversed"), F.sum(sign).cast("bigint").alias("n"))


def _read_by_score(d_user: DataFrame, d_merchant: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the dimensions what the score reads."""
    return d_user.select("user_id", "local_currency", "user_risk_level"), d_merchant.select("merchant_id", "local_currency", "risk_level")


@dataclasses.dataclass(frozen=True)
class Gold:
    """Gold at one point in time, with its dimensions."""

    transactions: DataFrame
    users: DataFrame
    merchants: DataFrame

    def dims(self) -> tuple[DataFrame, DataFrame]:
        return M.dim_user(self.users, self.transactions), M.dim_merchant(self.merchants)

    def scored(self, some: DataFrame | None = None, **options) -> DataFrame:
        """Scored transactions, all or some."""
        return M.risk_scored_transactions(self.transactions if some is None else some, *self.dims(), counted=self.transactions, **options)


TX_KEYS = ("transaction_id", "user_id", "merchant_id")


def _flagged(transactions: DataFrame, dims, bounded) -> DataFrame:
    """Transactions with ``_dim``: whether their user or merchant is in a list of
    changed ones. Lists of proven size are broadcast."""
    flags = []
    for changed, key, small in zip(dims, ("user_id", "merchant_id"), bounded, strict=True):
        flags.append(f"_has_{key}")
        marked = changed.select(key, F.lit(True).alias(flags[-1]))
        transactions = transactions.join(F.broadcast(marked) if small else marked, key, "left")
    return transactions.withColumn("_dim", F.coalesce(*flags, F.lit(False))).drop(*flags)


def fact_delta(before: Gold | None, after: Gold, changed: DataFrame, **options) -> DataFrame:
    """Partial aggregates to add to the fact. ``changed`` holds the transactions
    that changed (:meth:`GoldTable.changes`); those of changed users and merchants are found here.

    A transaction of a changed user or merchant is taken away and added by that
    alone, on both sides, since both are in its key. Of the others the new rows are
    in ``changed``, and old ones are looked up only where there were any."""
    if before is None:
        return partials(after.scored(**options), 1)
    (u0, m0), (u1, m1) = _read_by_score(*before.dims()), _read_by_score(*after.dims())
    dims = [stored_once(row_changes(a, b, [k]).select(k), f"changed-{k}") for a, b, k in ((u0, u1, "user_id"), (m0, m1, "merchant_id"))]
    changed = stored_once(changed, "changed")  # both sides read it: the comparison of two folds runs once
    flagged = lambda rows: _flagged(rows, dims, [options.get(f"{x}_bounded", False) for x in ("users", "merchants")])
    columns = after.transactions.columns
    new = flagged(after.transactions).where("_dim").unionByName(flagged(changed.where(F.col(OP) != "delete").select(*columns)).where("not _dim"))
    old = flagged(before.transactions)
    were = changed.where(F.col(OP) != "insert").select(*TX_KEYS)
    if were.isEmpty():
        old = old.where("_dim")
    else:
        marked = were.distinct().withColumn("_own", F.lit(True))
        old = old.join(marked, list(TX_KEYS), "left").where(F.col("_dim") | F.col("_own"))
    sides = ((before, old, -1), (after, new, 1))
    return signed_partials(reduce(DataFrame.unionByName, [g.scored(rows.select(*columns), **options).withColumn(SIGN, F.lit(sign)) for g, rows, sign in sides]))


def add_delta(spark: SparkSession, root: str, delta: DataFrame, number: int) -> None:
    """Append a refresh's partial aggregates; a refresh that runs again rewrites its own."""
    sinks.overwrite_partitions(_summed(delta).withColumn("refresh", F.lit(number)), f"{root}/partials", ["refresh"])


def _summed(parts: DataFrame) -> DataFrame:
    total = parts.groupBy(*FACT_KEYS).agg(*[F.sum(c).alias(c) for c in ("amount", "risk", "reversed", "n")])
    return total.where("amount <> 0 or risk <> 0 or reversed <> 0 or n <> 0")


def fact(spark: SparkSession, root: str) -> DataFrame:
    """The fact from all additions."""
    total = _summed(spark.read.parquet(f"{root}/partials").drop("refresh")).where(F.col("n") > 0)
    return total.select(*FACT_KEYS, F.col("amount").cast("decimal(20,2)").alias("total_amount"), (F.col("risk") / F.col("n")).alias("risk_score"),
                        F.col("reversed").alias("reversed_count"), F.col("n").alias("transaction_count"))


def compact(spark: SparkSession, root: str, target: str) -> None:
    """The additions as one, in a folder of its own."""
    add_delta(spark, target, spark.read.parquet(f"{root}/partials").drop("refresh"), 0)
