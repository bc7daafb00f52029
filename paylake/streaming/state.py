"""Current tables kept up batch by batch, at a cost that follows the batch.

A table's rows lie in leaves: sorted Parquet files that tile the order
(bucket, key, sequence). A leaf knows its lower bound, so the leaf that a change
belongs to is found in the list of leaves, without reading any. A fold reads
the leaves that its batch touches, puts the changes in
(:mod:`paylake.operators.splice`), writes these leaves anew in a folder of its
own, and last commits the new list of leaves. Nothing is replaced in place: a
reader keeps the leaves of the list it has read, a fold that dies leaves the
old list, and a fold that runs again gives the same rows.

For a history (SCD2) the touched leaves of a change are its own, the next one
where that goes on with the same key (the successor), and the ones below it
down to the first that holds a version of the key (the predecessor), so a key
whose history fills a thousand leaves has few of them read and written.

The buckets spread keys (:func:`buckets_for` a size that is known), the leaves
bound the rows of a task: a leaf that grew
beyond ``leaf_rows`` is cut where it is written. A fold of newest rows moves and
sorts each row once: the leaves to write are numbered, and a leaf's number is the
number of the task that writes it. Rows of one batch that fall
into one leaf are sorted in one task; admission by bytes bounds a batch.
"""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.operators.cdc import END_AT, HOT_ROWS, crowded_places, hash_place
from paylake.operators.splice import SET_AT, SINCE, VERSION, fold_marked, fold_newest, splice, versions
from paylake.sources import sinks

LEAVES = "leaves"
LEAST_BUCKETS = 16
BUCKET_BYTES = 20 << 20  # a million changes or so


def buckets_for(stored_bytes: int) -> int:
    """Buckets of a state that takes in so many bytes; a state keeps its number."""
    return max(LEAST_BUCKETS, stored_bytes // BUCKET_BYTES)


@dataclasses.dataclass(frozen=True)
class KeyedState:
    """A table of ``keys`` under ``root``; ``history`` keeps all versions (SCD2),
    else the newest row per key (SCD1)."""

    root: str
    keys: tuple[str, ...]
    sequence: str
    history: bool
    buckets: int = LEAST_BUCKETS
    leaf_rows: int = 1_000_000

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _place(self) -> Column:
        """What leaves are ordered by inside a bucket."""
        return F.struct(*[F.col(c) for c in (*self.keys, *((self.sequence,) if self.history else ()))])

    def leaves(self, spark: SparkSession) -> DataFrame | None:
        """The committed list: bucket, path, low, rows, versions; None before the first fold."""
        try:
            return sinks.read_current(spark, self.root, LEAVES)
        except KeyError:
            return None

    def folds(self, spark: SparkSession) -> list[int]:
        """Numbers of the committed folds."""
        done = sinks.manifest(spark, self.root).where(F.col("mart") == LEAVES).select("version").distinct().collect()
        return sorted(r["version"] for r in done)

    def leaves_at(self, spark: SparkSession, number: int) -> DataFrame:
        """The list as fold ``number`` committed it (of a fold that ran twice the later one)."""
        row = sinks.manifest(spark, self.root).where((F.col("mart") == LEAVES) & (F.col("version") == number)).orderBy(F.desc("refreshed_at")).first()
        return spark.read.parquet(row["path"])

    def between(self, spark: SparkSession, older: int | None, newer: int) -> tuple[DataFrame | None, DataFrame | None]:
        """(rows before, rows after) of the leaves in which two folds differ;
        what both lists hold is not read. None where there are none."""
        after = {r["path"] for r in self.leaves_at(spark, newer).select("path").collect()}
        before = {r["path"] for r in self.leaves_at(spark, older).select("path").collect()} if older is not None else set()
        gone, come = sorted(before - after), sorted(after - before)
        return (self._read(spark, gone) if gone else None), (self._read(spark, come) if come else None)

    def set_between(self, spark: SparkSession, older: int, newer: int) -> tuple[DataFrame, DataFrame] | None:
        """Of newest rows, those that came after fold ``older``: (of new keys, of
        keys that were there). A key that is there stays, so these are all changes."""
        after = self.between(spark, older, newer)[1]
        if after is None:
            return None
        come = after.where(F.col(SET_AT) > older)
        return come.where(F.col(SINCE) > older), come.where(F.col(SINCE) <= older)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All stored rows (a history with its marks); None before the first fold."""
        live = self.leaves(spark)
        return None if live is None else self._read(spark, [r["path"] for r in live.select("path").collect()])

    def table(self, spark: SparkSession) -> DataFrame | None:
        """The SCD table for readers."""
        rows = self.read(spark)
        if rows is None:
            return None
        return self.as_table(rows)

    def as_table(self, rows: DataFrame) -> DataFrame:
        """The SCD table of stored rows."""
        return versions(rows, self.keys, self.sequence) if self.history else rows.drop(self.sequence, SET_AT, SINCE)

    def _read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        return spark.read.parquet(*paths)

    def _ordered(self, leaves: DataFrame) -> DataFrame:
        """Leaves with their place in the bucket, the next one's bound, and the
        place from which the stretch of a key that their bound cuts is needed."""
        order = Window.partitionBy("bucket").orderBy("low")
        rows = leaves.withColumn("pos", F.row_number().over(order)).withColumn("high", F.lead("low").over(order))
        key = F.struct(*[F.col(f"low.{k}") for k in self.keys])
        rows = rows.withColumn("low_key", key).withColumn("next_key", F.lead("low_key").over(order))
        below = order.rowsBetween(Window.unboundedPreceding, -1)
        # a leaf holds a version of the key that goes on in the next one if it holds any version at all
        # of that key: it starts with an earlier key, or is that key's alone and has one
        other_key = ~F.lead("low_key").over(order).eqNullSafe(F.col("low_key"))
        holds = F.when(other_key | (F.col("versions") > 0), F.col("pos"))
        return rows.withColumn("holds", holds).withColumn("floor", F.coalesce(F.last("holds", ignorenulls=True).over(below), F.col("pos")))

    def _own_leaf(self, rows: DataFrame, leaves: DataFrame) -> DataFrame:
        """Rows with the place of the leaf that they belong to: the last one whose
        bound is not above, or the first. ``_bucket`` must be there."""
        first = F.col("pos") == 1
        at = (F.col("low") <= F.col("_place")) | first
        upto = F.col("high").isNull() | (F.col("high") > F.col("_place"))
        return rows.withColumn("_place", self._place()).join(leaves, (F.col("_bucket") == F.col("bucket")) & at & upto, "left")

    def _touched(self, changes: DataFrame, leaves: DataFrame) -> DataFrame:
        """(bucket, pos) of the leaves that a batch needs."""
        found = self._own_leaf(changes.select("_bucket", *self.keys, self.sequence), leaves).where(F.col("pos").isNotNull())
        own_key = F.struct(*self.keys)
        if self.history:
            lowest = F.when(F.col("low_key").eqNullSafe(own_key), F.col("floor")).otherwise(F.col("pos"))
            highest = F.when(F.col("next_key").eqNullSafe(own_key), F.col("pos") + 1).otherwise(F.col("pos"))
        else:
            lowest = highest = F.col("pos")
        return found.select("bucket", F.explode(F.sequence(lowest, highest)).alias("pos")).distinct()

    def fold(self, changes: DataFrame, number: int, counted: DataFrame | None = None) -> list[str]:
        """Put a batch of changes (keys, sequence, values) in as fold
        ``number``; returns the paths of the leaves that were read. Hot keys
        are looked for in ``counted`` where the caller has the keys stored
        (:func:`paylake.operators.cdc.scd1`), else in the changes."""
        spark = changes.sparkSession
        columns = changes.columns
        changes = changes.withColumn("_bucket", self._bucket())
        live = self.leaves(spark)
        touched = []
        if live is None:
            placed = changes.withColumn("_leaf", F.lit(0))
        else:
            ordered = self._ordered(live)
            touched = ordered.join(self._touched(changes, ordered), ["bucket", "pos"]).select("bucket", "pos", "path").collect()  # one row per leaf to rewrite
            placed = self._own_leaf(changes, ordered).withColumn("_leaf", F.coalesce("pos", F.lit(0))).select(*columns, "_bucket", "_leaf")
        paths = [r["path"] for r in touched]
        places = self._runs(spark, touched)
        number_of = F.broadcast(places.select("_bucket", F.col("_pos").alias("_leaf"), F.col("_leaf").alias("_nth"), "_run"))
        placed = placed.join(number_of, ["_bucket", "_leaf"], "left").withColumns({
            "_leaf": F.coalesce("_nth", F.col("_bucket") + F.lit(len(touched))),  # a bucket without leaves gets its first
            "_run": F.coalesce("_run", F.lit(0))}).drop("_bucket", "_nth")
        if touched:
            rows = self._read(spark, paths).withColumn("_path", F.col("_metadata.file_path"))
            old = rows.join(F.broadcast(places.select("_path", "_leaf", "_run")), "_path").drop("_path")
        else:
            old = spark.createDataFrame([], self._schema(changes.select(*columns)))
        tasks = len(touched) + self.buckets
        if self.history:
            rows = splice(old, placed, self.keys, self.sequence).drop("_run")
            rows = rows.repartitionById(tasks, F.col("_leaf"))
        else:
            placed = self._thinned(placed, changes if counted is None else counted)
            placed = placed.withColumns({SET_AT: F.lit(number), SINCE: F.lit(number)})
            rows = old.unionByName(placed).drop("_run").repartitionById(tasks, F.col("_leaf"))
            rows = fold_marked(rows, self.keys, self.sequence)
        path = f"{self.root}/fold-{number:09d}-{uuid.uuid4().hex[:8]}"
        self._write(rows.drop("_leaf"), path)
        new = self._list(spark.read.parquet(path))
        if live is not None:
            new = new.unionByName(live.join(F.broadcast(spark.createDataFrame([(p,) for p in paths], "path string")), "path", "left_anti"))
        listed = f"{path}-leaves"
        new.select("bucket", "path", "low", "rows", "versions").write.parquet(listed)
        sinks.commit_versions(spark, self.root, {LEAVES: (number, listed)})
        return paths

    def _thinned(self, placed: DataFrame, counted: DataFrame) -> DataFrame:
        """Changes without all but the newest of a hot key's per task, so that
        no key sends a large share of a batch to one leaf."""
        crowded = crowded_places(counted, self.keys, HOT_ROWS)
        if not crowded:
            return placed
        hot = hash_place(self.keys).isin(crowded)
        few = fold_newest(placed.where(hot), self.keys, self.sequence, ("_leaf", "_run"))  # cut down per task before it moves
        return placed.where(~hot).unionByName(few.select(*placed.columns))

    def _runs(self, spark: SparkSession, touched) -> DataFrame:
        """Of the leaves to rewrite: their place, their number among them, and
        the run of leaves without a gap that they are in."""
        rows, run, last = [], 0, None
        for r in sorted(touched, key=lambda r: (r["bucket"], r["pos"])):
            if last != (r["bucket"], r["pos"] - 1):
                run += 1
            last = (r["bucket"], r["pos"])
            rows.append((*last, len(rows), run, r["path"]))
        return spark.createDataFrame(rows, "_bucket int, _pos int, _leaf int, _run int, _path string")

    def _schema(self, changes: DataFrame) -> T.StructType:
        extra = [T.StructField("_leaf", T.IntegerType()), T.StructField("_run", T.IntegerType())]
        if self.history:
            extra = [T.StructField(VERSION, T.BooleanType()), T.StructField(END_AT, changes.schema[self.sequence].dataType), *extra]
        else:
            extra = [T.StructField(SET_AT, T.IntegerType()), T.StructField(SINCE, T.IntegerType()), *extra]
        return T.StructType([*changes.schema.fields, *extra])

    def _write(self, rows: DataFrame, path: str) -> None:
        """Leaves as files, those of a task in order; one that grew too long is
        cut into several. Newest rows come in this order and are not sorted again."""
        order = [*self.keys, *((self.sequence,) if self.history else ())]  # newest rows have unique keys
        rows.sortWithinPartitions(*order).write.option("maxRecordsPerFile", self.leaf_rows).option("compression", sinks.CODEC).parquet(path)

    def _list(self, rows: DataFrame) -> DataFrame:
        """The list of the leaves just written: their first rows are their
        bounds, counts need no more than the marks."""
        file = F.col("_metadata.file_path").alias("path")
        counted = F.count_if(F.col(VERSION)) if self.history else F.count(F.lit(1))
        counts = rows.groupBy(file).agg(F.count(F.lit(1)).alias("rows"), counted.alias("versions"))
        first = rows.where(F.col("_metadata.row_index") == 0).select(self._bucket().alias("bucket"), file, self._place().alias("low"))
        return first.join(counts, "path")
