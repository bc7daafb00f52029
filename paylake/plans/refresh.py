"""Materialised marts: create and refresh in dependency order.

Each mart is written as a new version directory and committed in an
append-only manifest (see :mod:`paylake.sources.sinks`). Marts that read other
marts (the fact reads the user and merchant dimensions) read the committed
versions back from storage, so the fact's joins see compact Parquet inputs
whose size checks are cheap, and a failure part-way leaves every earlier
mart committed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.operators.joins import is_bounded
from paylake.plans import marts as M
from paylake.sources import sinks

# mart -> (marts it reads, builder(inputs) -> DataFrame); inputs holds the
# gold tables under "gold_*" and committed marts under their names.
MartBuilder = Callable[[dict[str, DataFrame]], DataFrame]
MARTS: dict[str, tuple[tuple[str, ...], MartBuilder]] = {
    "dim_date": ((), lambda i: M.dim_date(i["gold_transactions"].sparkSession)),
    "dim_user": ((), lambda i: M.dim_user(i["gold_users"], i["gold_transactions"])),
    "dim_merchant": ((), lambda i: M.dim_merchant(i["gold_merchants"])),
    "dim_channel": ((), lambda i: M.dim_channel(i["gold_transactions"])),
    "fact_transactions": (("dim_user", "dim_merchant"),
                          lambda i: M.fact_transactions(
                              i["gold_transactions"], i["dim_user"], i["dim_merchant"],
                              merchants_bounded=is_bounded(i["dim_merchant"]),
                              users_bounded=is_bounded(i["dim_user"]))),
}
# The reference's refresh order.
REFRESH_ORDER = ("dim_date", "dim_user", "dim_merchant", "dim_channel", "fact_transactions")


def refresh_order(names=None) -> list[str]:
    """Requested marts plus what they read, dependencies first."""
    return [n for level in refresh_levels(names) for n in level]


def refresh_levels(names=None) -> list[list[str]]:
    """Marts grouped by dependency depth: every mart's inputs sit in an
    earlier level; within a level the reference's order is kept."""
    wanted = list(names or REFRESH_ORDER)
    depth: dict[str, int] = {}

    def visit(n, path=()):
        if n in path:
            raise ValueError(f"cycle through {n}")
        if n not in depth:
            depth[n] = 1 + max((visit(d, (*path, n)) for d in MARTS[n][0]), default=-1)
        return depth[n]

    for n in wanted:
        visit(n)
    rank = {n: i for i, n in enumerate(REFRESH_ORDER)}
    levels = [sorted((n for n, d in depth.items() if d == k), key=lambda n: rank.get(n, len(rank)))
              for k in range(max(depth.values()) + 1)]
    return levels


def refresh(spark: SparkSession, gold: dict[str, DataFrame], root: str, names=None) -> DataFrame:
    """Rebuild marts level by level; returns the committed ``mart, version, row_count``.

    Marts of one level are independent, so their new versions are written as
    concurrent jobs, then committed together in one manifest append. The next
    level reads the committed versions back from storage.
    """
    inputs = dict(gold)
    done: list[str] = []
    for level in refresh_levels(names):
        jobs, written = {}, {}
        for name in level:
            deps, build = MARTS[name]
            for d in deps:
                inputs[d] = sinks.read_current(spark, root, d)
            version = sinks.next_version(spark, root, name)
            path = sinks.version_path(root, name, version)
            jobs[name] = (build(inputs), path)
            written[name] = (version, path)
        sinks.write_concurrently(jobs)
        sinks.commit_versions(spark, root, written)
        for name in level:
            inputs[name] = sinks.read_current(spark, root, name)
        done.extend(level)
    return (sinks.current_versions(spark, root)
            .where(F.col("mart").isin(done))
            .select("mart", "version", "row_count"))
