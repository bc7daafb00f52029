"""Hard negatives by a secondary sort.

Every anchor meets every row in blocks: the rows stay where they are, packed
and stored once, and a bounded chunk of anchors at a time is sent to all
tasks. Two passes keep what can matter only: the first the greatest scores of
the anchor's own label (its positives), the second the greatest scores of other
labels inside the window that each of those positives opens. What a task keeps
per anchor is bounded, and what it drops is beaten by rows it keeps, so the
result is exact whatever the number of rows.

The kept pairs are packed into keys (anchor, descending score, kind, id) that
sort as bytes. ``repartitionAndSortWithinPartitions`` deals them by anchor and
sorts them in the shuffle; one iterator streams over a partition: a positive
opens its window, a negative goes to every open window that it fits, a window
closes when it is full. No anchor's pairs are held together; the state is the
open windows of one anchor.

Scores are exact integers: doubles hold them where no hundredfold sum can
exceed 2**53, else Python's integers; a score that is no long fails the job.

Edge cases: rows with a null id, label or vector, an empty vector, one with a
null entry, or of another length than most (of lengths equally common the
greatest counts) take no part; of rows that share an id the least (label,
vector) counts, so repeated rows count once; equal scores go to the smaller
id; an anchor without positives, or a positive without a negative in its
window, returns nothing (a positive with a score below zero has an empty
window); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.common import partitions, ship, stored
from paylake.llm.vectors import commonest_length, pack, unpacked

SCHEMA = T.StructType([T.StructField(c, T.IntegerType() if c == "rank" else T.LongType())
                       for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")])
_TILE = 1024  # anchors and rows of a score matrix
_KEY = ">QQBQ"
_SIGN = 1 << 63


def _unique(rows: DataFrame) -> DataFrame:
    """One row per id; only rows whose id occurs again are grouped."""
    twice = stored(rows.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id"), "negatives-twice")
    least = rows.join(twice, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.label", "r.x")
    return rows.join(twice, "vec_id", "left_anti").select("vec_id", "label", "x").unionByName(least)


def _number_kind(rows: DataFrame, dimension: int):
    """The number type in which no score, nor a hundred times one, can be wrong."""
    size = F.transform("x", lambda c: F.abs(c.cast("decimal(20,0)")))
    most = rows.select(F.max(F.array_max(size)).alias("m")).first()["m"]
    return np.float64 if 100 * int(most or 0) ** 2 * dimension < 1 << 53 else object


def _greatest(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the k greatest scores of each anchor (a row of the
    matrix), the first of equal ones; -inf is no score."""
    if scores.shape[1] > k:
        cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k, None]
        above, level = scores > cut, (scores == cut) & (cut > -np.inf)
        room = k - above.sum(axis=1)
        tied = level.sum(axis=1) > room
        if tied.any():  # of equal ones as many as there is room for
            level[tied] &= np.cumsum(level[tied], axis=1) <= room[tied, None]
        return np.nonzero(above | level)
    return np.nonzero(scores > -np.inf)


def _merged(have: tuple[np.ndarray, np.ndarray], anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> None:
    """Put found (anchor, score, id) into the k best of each anchor (in place)."""
    if not len(anchor):
        return
    scores, names = have
    touched = np.unique(anchor)
    a = np.concatenate((np.repeat(touched, k), anchor))
    s, i = np.concatenate((scores[touched].ravel(), score)), np.concatenate((names[touched].ravel(), ids))
    order = np.lexsort((i, -s, a))
    a, s, i = a[order], s[order], i[order]
    first = np.searchsorted(a, touched)
    at = (first[:, None] + np.arange(k)).ravel()  # each touched anchor has k entries at least
    scores[touched], names[touched] = s[at].reshape(-1, k), i[at].reshape(-1, k)


class _Chunk:
    """A bounded number of anchors, as sent to the tasks, with the windows
    [50 %, 95 %] or so of their positives in the second pass."""

    def __init__(self, rows: pa.Table, dimension: int, kind, windows: np.ndarray | None = None):
        self.ids, self.labels = (rows.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "label"))
        self.x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, dimension).astype(kind)
        self.windows, self.kind, self.dimension = windows, kind, dimension

    def tiles(self, batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(anchors, scores, same label, ids) of tiles; rows in order of their ids."""
        for ids, labels, x in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "x"))):
            order = np.argsort(np.array(ids, np.int64), kind="stable")
            ids, labels = np.array(ids, np.int64)[order], np.array(labels, np.int64)[order]
            x = unpacked(x, self.dimension)[order].astype(self.kind)
            for lo in range(0, len(ids), _TILE):
                for at in range(0, len(self.ids), _TILE):
                    rows, some = slice(lo, lo + _TILE), slice(at, at + _TILE)
                    yield some, self.x[some] @ x[rows].T, self.labels[some, None] == labels[rows], ids[rows]

    def best(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Room for the scores and ids of the k best rows of each anchor."""
        return np.full((len(self.ids), k), -np.inf, self.kind), np.full((len(self.ids), k), np.iinfo(np.int64).max)

    def keep(self, best, some: slice, scores: np.ndarray, valid: np.ndarray, ids: np.ndarray) -> None:
        k = best[0].shape[1]
        scores = np.where(valid & (scores >= best[0][some, -1, None]), scores, -np.inf)  # the k-th so far may tie with a smaller id
        full = np.flatnonzero((scores > -np.inf).any(axis=1))
        a, r = _greatest(scores[full], k)
        a = full[a]
        _merged(best, a + some.start, scores[a, r], ids[r], k)

    def rows(self, kept) -> Iterator[pa.RecordBatch]:
        """(anchor_id, score, id) of all that was kept, each pair once."""
        scores, names = (np.concatenate([b[i] for b in kept], axis=1) for i in (0, 1))
        for at in range(0, len(self.ids), 4096):
            s, i = scores[at:at + 4096], names[at:at + 4096]
            a, c = np.nonzero(s > -np.inf)
            found = np.unique(np.stack((a, i[a, c], s[a, c].astype(np.int64))), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[at + found[0]]), pa.array(found[2]), pa.array(found[1])], names=["anchor_id", "score", "id"])


def _kept(blocks: DataFrame, chunk: _Chunk, found) -> DataFrame:
    """Rows kept by each task; ``found`` gives the room and the valid scores."""
    sent = blocks.sparkSession.sparkContext.broadcast(chunk)  # as many anchors as a chunk holds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = sent.value
        kept = found.room(chunk)
        for batch in batches:
            for some, scores, same, ids in chunk.tiles(batch):
                for best, valid in zip(kept, found.valid(chunk, some, scores, same, ids)):
                    chunk.keep(best, some, scores, valid, ids)
        yield from chunk.rows(kept)

    return blocks.select("vec_id", "label", "x").mapInArrow(run, "anchor_id bigint, score bigint, id bigint")


class _Positives:
    def __init__(self, k: int):
        self.k = k

    def room(self, chunk: _Chunk):
        return [chunk.best(self.k)]

    def valid(self, chunk: _Chunk, some, scores, same, ids):
        yield same & (chunk.ids[some, None] != ids)


class _Negatives:
    def __init__(self, k: int, lowest: int, highest: int):
        self.k, self.lowest, self.highest = k, lowest, highest

    def room(self, chunk: _Chunk):
        return [chunk.best(self.k) for _ in range(chunk.windows.shape[1])]

    def valid(self, chunk: _Chunk, some, scores, same, ids):
        for column in chunk.windows.T:
            positive = column[some, None]  # nan where there is none
            yield ~same & (self.lowest * positive <= 100 * scores) & (100 * scores <= self.highest * positive)


def _pairs(pairs: DataFrame, kind: int) -> DataFrame:
    """Pairs as keys that sort as bytes: anchor, falling score, kind, id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [struct.pack(_KEY, a + _SIGN, _SIGN - 1 - s, kind, i + _SIGN) for a, s, i in zip(*(batch.column(c).to_pylist() for c in ("anchor_id", "score", "id")))]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])

    return pairs.select("anchor_id", "score", "id").mapInArrow(run, "key binary")


def _stream(keys, negatives: int, lowest: int, highest: int):
    """Rows of the result from one partition's sorted keys."""
    anchor, windows = None, []
    for key, _ in keys:
        a, s, kind, i = struct.unpack(_KEY, key)
        s = _SIGN - 1 - s
        if a != anchor:
            anchor, windows = a, []
        if kind == 0:
            windows.append([i - _SIGN, s, 0])
            continue
        windows = [w for w in windows if w[2] < negatives and lowest * w[1] <= 100 * s]  # lower scores come from here on
        for w in windows:
            if 100 * s <= highest * w[1]:
                w[2] += 1
                yield a - _SIGN, w[0], w[2], i - _SIGN, w[1], s


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, lowest: int = 50, highest: int = 95,
                   chunk_numbers: int = 1 << 22, block_rows: int = 4096) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and x (integers); ``anchors`` tells its
    anchors. A negative's score lies between ``lowest`` and ``highest`` percent
    of the positive's. ``chunk_numbers`` bounds the numbers of the anchors
    that are on the driver and in a task at once.
    """
    spark = vectors.sparkSession
    ship(spark)
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull())
    usable = usable.where(F.forall("x", lambda c: c.isNotNull()) & (F.size("x") > 0))
    usable = usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("x").cast("array<bigint>").alias("x"))
    d = commonest_length(usable, "x")
    if not d:
        return spark.createDataFrame([], SCHEMA)
    rows = stored(_unique(usable.where(F.size("x") == d)), "negatives-rows")
    kind = _number_kind(rows, d)
    blocks = stored(pack(rows, "x", d, block_rows, ("vec_id", "label")), "negatives-blocks")
    asked = rows.where(anchors)
    size = max(1, chunk_numbers // d)
    count = -(-4 * asked.count() // (3 * size))  # dealt by hash: three quarters of a chunk on average
    asked = stored(asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(max(count, 1)))), "negatives-anchors")
    keys = []
    for c in range(count):
        mine = asked.where(F.col("chunk") == c).select("vec_id", "label", "x").orderBy("vec_id")
        chunk = _Chunk(mine.toArrow(), d, kind)
        near = _kept(blocks, chunk, _Positives(positives))
        order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
        near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
        near = stored(near, "negatives-positives")
        found = near.select("anchor_id", "rank", "score").toArrow()  # ``positives`` rows for each anchor of the chunk
        windows = np.full((len(chunk.ids), positives), np.nan, kind)
        at = np.searchsorted(chunk.ids, found.column("anchor_id").to_numpy())
        windows[at, found.column("rank").to_numpy() - 1] = found.column("score").to_numpy()
        chunk.windows = windows
        far = _kept(blocks, chunk, _Negatives(negatives, lowest, highest))
        keys.append(stored(_pairs(near, 0).unionByName(_pairs(far, 1)), "negatives-keys"))
    if not keys:
        return spark.createDataFrame([], SCHEMA)
    tasks = partitions(spark)
    pairs = reduce(DataFrame.unionByName, keys).rdd.map(lambda r: (bytes(r["key"]), None))
    dealt = pairs.repartitionAndSortWithinPartitions(tasks, lambda key: int.from_bytes(key[:8]) * 0x9E3779B97F4A7C15 >> 32)
    return spark.createDataFrame(dealt.mapPartitions(lambda keys: _stream(keys, negatives, lowest, highest)), SCHEMA, verifySchema=False)
