"""Folding changes into stored histories, interval by interval.

:func:`fold_newest` and :func:`splice` take stored rows of some keys (any
stretch of each key's history that holds the neighbours of its new changes)
and a batch of changes, and give the stretch as it is afterwards.

A history keeps every change, not only those that open a version: a change that
repeats its predecessor opens none today, but does so once a late change comes
in between. Stored columns beside keys, sequence and values are ``__VERSION``
(the change opens a version) and ``__END_AT`` (of versions: where the next one
starts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.operators.cdc import END_AT, START_AT

VERSION = "__VERSION"
#: Of newest rows: the fold that put the row in, and the one that brought its key.
SET_AT = "__SET_AT"
SINCE = "__SINCE"


def fold_newest(rows: DataFrame, keys, seq: str, place=("_leaf",)) -> DataFrame:
    """SCD1: the newest of stored rows and changes per key. A key's rows all
    have the same ``place``; rows already dealt by it are not moved again. The
    result is in the order of the keys."""
    skip = {*keys, seq, *place}
    values = [c for c in rows.columns if c not in skip]
    newest = Window.partitionBy(*keys, *place).orderBy(*[F.col(c).desc_nulls_last() for c in (seq, *values)])
    return rows.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").select(*keys, *values, seq, *place)


def fold_marked(rows: DataFrame, keys, seq: str, place=("_leaf",)) -> DataFrame:
    """:func:`fold_newest` of rows with ``__SET_AT`` and ``__SINCE``: a stored row
    that comes again as it is keeps its mark, a key keeps its first fold."""
    skip = {*keys, seq, *place, SET_AT, SINCE}
    values = [c for c in rows.columns if c not in skip]
    by_key = Window.partitionBy(*keys, *place).orderBy(*[F.col(c).desc_nulls_last() for c in (seq, *values)], F.col(SET_AT))
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({"_rn": F.row_number().over(by_key), "_since": F.min(SINCE).over(whole)})
    return rows.where("_rn = 1").select(*keys, *values, seq, SET_AT, F.col("_since").alias(SINCE), *place)


def splice(stored: DataFrame, changes: DataFrame, keys, seq: str, leaf: str = "_leaf", run: str = "_run") -> DataFrame:
    """SCD2: the stretches of each key with their changes put in. A stretch is
    the rows of a key in one ``run`` (leaves without a gap between them).

    The first stored row of a stretch keeps its mark, since no change comes
    before it (else its predecessor would be in the stretch). The last version
    ends where the last stored version of the stretch ended: what comes after the
    stretch has not changed. Of rows that share key and sequence the greatest
    counts, so a change that is folded again changes nothing.
    """
    keys = list(keys)
    values = [c for c in changes.columns if c not in {*keys, seq, leaf, run}]
    rows = (stored.withColumn("_old", F.lit(True))
            .unionByName(changes.withColumns({VERSION: F.lit(None).cast("boolean"), END_AT: F.lit(None).cast(stored.schema[END_AT].dataType), "_old": F.lit(False)})))
    by_key = Window.partitionBy(*keys, run)
    stretch_end = F.max_by(F.struct(F.col(END_AT)), F.when(F.col("_old") & F.col(VERSION), F.struct(F.col(seq)))).over(by_key)
    rows = rows.withColumn("_stretch_end", stretch_end[END_AT])
    # one row per sequence: the greatest, stored rows before equal new ones
    tie = Window.partitionBy(*keys, run, seq).orderBy(*[F.col(c).desc() for c in values], F.col("_old").desc())
    rows = rows.withColumn("_nth", F.row_number().over(tie)).where("_nth = 1")
    in_order = by_key.orderBy(seq)
    rows = rows.withColumn("_t", F.struct(*values)).withColumn("_prev", F.lag("_t").over(in_order)).withColumn("_first", F.row_number().over(in_order) == 1)
    opens = F.when(F.col("_first"), F.coalesce(F.col(VERSION), F.lit(True))).otherwise(~F.col("_prev").eqNullSafe(F.col("_t")))
    rows = rows.withColumn(VERSION, opens)
    # the next version's start: the nearest marked sequence after this row
    after = by_key.orderBy(F.col(seq).desc()).rowsBetween(Window.unboundedPreceding, -1)
    next_start = F.last(F.when(F.col(VERSION), F.struct(F.col(seq))), ignorenulls=True).over(after)
    rows = rows.withColumn("_next", next_start)
    end = F.when(F.col(VERSION), F.when(F.col("_next").isNotNull(), F.col("_next")[seq]).otherwise(F.col("_stretch_end")))
    return rows.withColumn(END_AT, end).select(*keys, *values, seq, VERSION, END_AT, leaf, run)


def versions(stored: DataFrame, keys, seq: str, drop=()) -> DataFrame:
    """The SCD2 table of a stored history."""
    skip = {*keys, seq, VERSION, END_AT, *drop}
    return stored.where(F.col(VERSION)).select(*keys, *[c for c in stored.columns if c not in skip], F.col(seq).alias(START_AT), F.col(END_AT))
