"""Dimension joins that stay safe at scale.

* :func:`is_bounded` proves a stored table small (a row count, which Parquet
  answers from its footers, times a width) before it may be broadcast. A larger
  one is joined by shuffle.
* :func:`hot_keys` finds, once and from the narrow key column of the stored
  fact, the keys that hold at least ``fraction`` of its rows: at most
  ``1 / fraction`` of them exist, so the list is small whatever the data.
* :func:`salted_join` spreads each hot key over as many sub-keys as its own
  row count asks for and replicates only those keys' dimension rows. All
  other keys join as usual, and without a hot key it is a plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 128 << 20
DEFAULT_HOT_FRACTION = 1e-3
DEFAULT_ROWS_PER_SALT = 2_000_000


def is_bounded(stored: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES, row_bytes: int = 64) -> bool:
    """True when a stored table's rows, at ``row_bytes`` each, fit the bound."""
    return stored.count() * row_bytes <= max_bytes


def hot_keys(fact: DataFrame, key: str, fraction: float = DEFAULT_HOT_FRACTION,
             rows_per_salt: int = DEFAULT_ROWS_PER_SALT) -> DataFrame | None:
    """(key, _salts) of the keys with at least ``fraction`` of the rows and
    more than one task's worth of them; None if there is none."""
    total = fact.count()
    least = max(total * fraction, rows_per_salt)
    rows = (fact.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= least) & F.col(key).isNotNull())
            .select(key, F.ceil(F.col("n") / F.lit(rows_per_salt)).cast("int").alias("_salts")).collect())
    if not rows:
        return None
    return fact.sparkSession.createDataFrame(rows, fact.select(key, F.lit(0).alias("_salts")).schema)


def salted_join(fact: DataFrame, dim: DataFrame, key: str, hot: DataFrame | None, how: str = "inner",
                salt_by=None) -> DataFrame:
    """Equi-join ``fact`` to ``dim`` (one row per key) with the hot keys salted.

    ``salt_by`` names fact columns whose hash picks a row's salt (default: all
    fact columns), so the split is deterministic and survives task retries.
    """
    if hot is None:
        return fact.join(dim, key, how)
    hot = F.broadcast(hot)  # at most 1 / fraction rows
    salt_cols = [F.col(c) for c in (salt_by or fact.columns)]
    f = (fact.join(hot, key, "left")
         .withColumn("_salt", F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*salt_cols), F.col("_salts").cast("long")))
                     .otherwise(F.lit(0).cast("long")))
         .drop("_salts"))
    d = (dim.join(hot, key, "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_salts"), F.lit(1)).cast("long") - 1)))
         .drop("_salts"))
    return f.join(d, [key, "_salt"], how).drop("_salt")
