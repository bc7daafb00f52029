"""Change-data capture into SCD type 1 and type 2 tables.

Both are pure functions of the change log, so they are independent of arrival
order and of how the log was split into micro-batches (G3): the streaming
upkeep re-applies them to the keys a batch touched.

Scale notes
-----------
* SCD1 is a top-1 per key (``row_number() == 1`` over the sequence, newest
  first). Rows are dealt by key first and sorted once, in tasks of a shuffle
  partition's size. Only rows whose keys fall into a crowded place (of a
  bounded number of hash places, counted from the key columns) are sorted
  before they move: there Spark's partial ``WindowGroupLimit`` cuts a key that
  holds a third of all rows down to one row per task, as a partial aggregate would.
* SCD2 needs the previous and next change of each key, i.e. windows ordered by
  the sequence: one shuffle by key. A key with a very long history would put
  it into one task, so keys are counted first (a partial aggregate over the
  key columns). Only keys above ``hot_rows`` changes are treated apart: tied
  changes are reduced before the shuffle, the history is cut into contiguous
  sequence ranges by approximate percentiles, the windows run per (key, range),
  and one summary row per range stitches neighbours together.
* Changes of a key that share a sequence are one change: the last by the
  tie-break columns and then by the row's values. So a history is a function of
  the set of changes, whatever order they arrive in, and holds at most one
  version per key and sequence.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START_AT = "__START_AT"
END_AT = "__END_AT"


def _value_columns(df: DataFrame, keys, order, except_cols) -> list[str]:
    skip = set(keys) | set(order) | set(except_cols)
    return [c for c in df.columns if c not in skip]


HOT_ROWS = 1_000_000
#: At most this many keys are treated as hot; their number bounds a broadcast.
MAX_HOT_KEYS = 1_000
#: Hash places in which SCD1 counts its rows to find hot keys.
PLACES = 4_096


def scd1(changes: DataFrame, keys, sequence_by: str, except_cols=(), tiebreak=(),
         keep_sequence: bool = False, counted: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Current state per key: the newest change wins (G1).

    Ties on ``sequence_by`` are broken by ``tiebreak`` columns and then by the
    row's own values, so the result is deterministic (S6). With
    ``keep_sequence`` the winning row keeps its sequence column, so the result
    can itself be merged with later changes: ``scd1(state ∪ new)`` equals
    ``scd1(all changes)`` (newest-wins is associative).

    Places with ``hot_rows`` rows more than usual are reduced before the
    shuffle. They are counted in ``counted`` where the caller has the same keys
    stored (more rows do no harm), else in the changes.
    """
    keys = list(keys)
    order_cols = [sequence_by, *tiebreak]
    values = _value_columns(changes, keys, order_cols, except_cols)
    carried = [c for c in tiebreak if c not in except_cols]
    if keep_sequence:
        carried = [sequence_by, *carried]
    # newest first; NULLs rank lowest, as in a struct maximum
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order_cols, *values]])

    def first(rows):
        return (rows.withColumn("_rn", F.row_number().over(newest))
                .where(F.col("_rn") == 1)
                .select(*keys, *values, *carried))

    needed = changes.select(*dict.fromkeys([*keys, *order_cols, *values]))
    crowded = crowded_places(changes if counted is None else counted, keys, hot_rows)
    if not crowded:
        return first(needed.repartition(*keys))
    hot = hash_place(keys).isin(crowded)
    return first(needed.where(~hot).repartition(*keys)).unionByName(first(needed.where(hot)))


def hash_place(keys) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(PLACES))


def crowded_places(rows: DataFrame, keys, hot_rows: int) -> list[int]:
    """Places that hold ``hot_rows`` rows beyond twice the average."""
    counts = rows.groupBy(hash_place(keys).alias("place")).count().collect()  # PLACES rows at most
    usual = 2 * sum(r["count"] for r in counts) / PLACES
    return sorted(r["place"] for r in counts if r["count"] > usual + hot_rows)


def _tracked_struct(cols) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def scd2(changes: DataFrame, keys, sequence_by: str, except_cols=(), tiebreak=(),
         hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Full history per key (G2): one row per version with ``__START_AT`` /
    ``__END_AT`` taken from ``sequence_by``.

    A change whose tracked columns equal the previous change of the same key
    opens no version (S28). Tracked columns are all columns except keys,
    ordering columns and ``except_cols``. ``hot_rows`` is the length from
    which a key's history is split over tasks (None: never).
    """
    keys = list(keys)
    order_cols = [sequence_by, *tiebreak]
    tracked = _value_columns(changes, keys, order_cols, except_cols)
    base = changes.select(*keys, *order_cols, *tracked)
    hot, longest = _hot_keys(base, keys, hot_rows) if hot_rows else (None, 0)
    if hot is None:
        return _scd2_single(base, keys, sequence_by, [*order_cols, *tracked], tracked)
    hot = F.broadcast(hot)  # MAX_HOT_KEYS rows at most
    cold = _join_nulls(base, hot, keys, "left_anti")
    last = Window.partitionBy(*keys, sequence_by).orderBy(*[F.col(c).desc() for c in [*tiebreak, *tracked]])
    long = (_join_nulls(base, hot, keys, "left_semi")
            .withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn"))
    pieces = min(1_000, -(-longest // hot_rows))
    cuts = [i / pieces for i in range(1, pieces)]
    ranges = long.groupBy(*keys).agg(F.percentile_approx(sequence_by, cuts, 10_000).alias("_cuts"))
    long = (_join_nulls(long, F.broadcast(ranges), keys, "inner")
            .withColumn("_chunk", F.size(F.filter("_cuts", lambda c: c < F.col(sequence_by)))).drop("_cuts"))
    return (_scd2_single(cold, keys, sequence_by, [*order_cols, *tracked], tracked)
            .unionByName(_scd2_chunked(long, keys, sequence_by, [sequence_by], tracked)))


def _join_nulls(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Join on equal keys, null keys being equal; the left side's keys stay."""
    other = right.select(*[F.col(k).alias(f"_j_{k}") if k in keys else F.col(k) for k in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_j_{k}" for k in keys])


def _hot_keys(base: DataFrame, keys, hot_rows: int) -> tuple[DataFrame | None, int]:
    """The keys with more than ``hot_rows`` changes and the longest history."""
    counted = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    found = counted.orderBy(F.col("_n").desc()).limit(MAX_HOT_KEYS).collect()
    if not found:
        return None, 0
    hot = base.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in found], base.select(*keys).schema)
    return hot, found[0]["_n"]


def _scd2_single(df, keys, seq, order_cols, tracked):
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    # of changes that share a sequence the last one counts
    df = df.withColumn("_next", F.lead(F.struct(F.col(seq))).over(w)).where(
        F.col("_next").isNull() | ~F.col("_next")[seq].eqNullSafe(F.col(seq)))
    w = Window.partitionBy(*keys).orderBy(seq)
    kept = (df.withColumn("_t", _tracked_struct(tracked))
            .withColumn("_prev", F.lag("_t").over(w))
            .where(~F.col("_prev").eqNullSafe(F.col("_t"))))
    return kept.select(*keys, *tracked,
                       F.col(seq).alias(START_AT),
                       F.lead(seq).over(w).alias(END_AT))


def _scd2_chunked(df, keys, seq, order_cols, tracked):
    kc = [*keys, "_chunk"]
    w_in = Window.partitionBy(*kc).orderBy(*order_cols)
    ordering = F.struct(*[F.col(c) for c in order_cols])

    # Pass 1, per (key, chunk): previous change inside the chunk.
    rows = (df.withColumn("_t", _tracked_struct(tracked))
            .withColumn("_prev", F.lag("_t").over(w_in))
            .withColumn("_first_in_chunk", F.row_number().over(w_in) == 1))
    changed_inside = ~F.col("_first_in_chunk") & ~F.col("_prev").eqNullSafe(F.col("_t"))

    # Chunk summary (same partitioning, no shuffle): its first and last value,
    # its first start, and the first change inside it (a NULL ordering is
    # skipped by min_by).
    summary = rows.groupBy(*kc).agg(
        F.min_by("_t", ordering).alias("_first_t"),
        F.max_by("_t", ordering).alias("_last_t"),
        F.min_by(seq, ordering).alias("_first_seq"),
        F.min_by(seq, F.when(changed_inside, ordering)).alias("_first_change"),
    )
    # Across the chunks of a key (one row per chunk): is the chunk's first row a
    # change, where does the chunk's first version start, and where does the
    # next chunk that has a version start. The last is a growing frame over the
    # chunks in descending order, which Spark evaluates in one pass.
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    later_chunks = (Window.partitionBy(*keys).orderBy(F.col("_chunk").desc())
                    .rowsBetween(Window.unboundedPreceding, -1))
    first_is_change = ~F.lag("_last_t").over(by_chunk).eqNullSafe(F.col("_first_t"))
    summary = (summary.withColumn("_first_is_change", first_is_change)
               .withColumn("_chunk_start", F.when(F.col("_first_is_change"), F.col("_first_seq"))
                           .otherwise(F.col("_first_change")))
               .withColumn("_next_chunk", F.last("_chunk_start", ignorenulls=True).over(later_chunks))
               .select(*kc, "_first_is_change", "_next_chunk"))

    # Pass 2: keep the changes, end each version at the next kept start.
    kept = (_join_nulls(rows, summary, kc, "left")
            .where(F.when(F.col("_first_in_chunk"), F.col("_first_is_change")).otherwise(changed_inside)))
    return kept.select(*keys, *tracked,
                       F.col(seq).alias(START_AT),
                       F.coalesce(F.lead(seq).over(w_in), F.col("_next_chunk")).alias(END_AT))


def current_rows(history: DataFrame) -> DataFrame:
    """Open versions only."""
    return history.where(F.col(END_AT).isNull())
