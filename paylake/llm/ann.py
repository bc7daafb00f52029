"""Approximate nearest neighbours by balanced posting lists.

Centroids come from a balanced k-means on a bounded sample; every vector is
indexed. A vector goes to its nearest centroid's posting list and, near a
boundary, also to the lists of centroids hardly further away. A query finds
its lists by best-first search in an in-memory neighbour graph of the
centroids and keeps those whose distance is at most ``ratio`` times that of
the nearest (or the median nearest distance, if that is more). The ratio is not guessed: it is the least one that finds
``target_recall`` of the true neighbours of a bounded set of calibration
queries, which are compared with every vector.

Largest inner product becomes nearest distance by one more coordinate,
sqrt(M^2 - |x|^2) with M the largest norm, zero for queries. Lists are cut into
blocks of bounded size, and queries and blocks meet by (list, block). Equal
vectors are one entry with their k + 1 smallest ids: more of them can never be
among a query's k nearest, ties going to the smaller id. Equal queries are
searched once. So one vector that makes up a third of the table is one entry
and one search.

Edge cases: vectors that are null, zero, or hold a null or non-finite
component take no part, nor do rows without id or vectors of another length
than most; repeated rows count once; with fewer candidates than k all are
returned; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import ship, stored


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0))


def lifted(x: np.ndarray, largest: float) -> np.ndarray:
    """Vectors with the coordinate that turns inner product into distance."""
    return np.column_stack((x, np.sqrt(np.maximum(largest * largest - (x * x).sum(1), 0))))


def _assigned(sample: np.ndarray, centroids: np.ndarray, charge: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Each row's centroid of least charged squared distance, and that distance
    uncharged; a block of rows at a time, so the driver holds no whole matrix."""
    own, own_d = np.zeros(len(sample), np.int64), np.zeros(len(sample))
    for lo in range(0, len(sample), 1024):
        d = _distances(sample[lo:lo + 1024], centroids) ** 2
        own[lo:lo + 1024] = best = (d + charge).argmin(1)
        own_d[lo:lo + 1024] = d[np.arange(len(d)), best]
    return own, own_d


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 15, seed: int = 42) -> np.ndarray:
    """K-means whose assignment charges crowded clusters more each round, and
    whose tiny clusters are given up to halve the largest ones."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), lists, replace=False)].copy()
    charge = np.zeros(lists)
    even = len(sample) / lists
    for turn in range(rounds):
        own, own_d = _assigned(sample, centroids, charge)
        size = np.bincount(own, minlength=lists)
        charge += 0.2 * own_d.mean() * (size / even - 1).clip(-1, 3)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        some = size > 0
        centroids[some] = sums[some] / size[some, None]
        if turn == rounds - 1:
            break
        for j in np.flatnonzero(size < even / 4).tolist():
            large = int(size.argmax())
            members = np.flatnonzero(own == large)
            if len(members) < max(2, 2 * size[j]):
                break
            axis = sample[members] @ rng.normal(size=sample.shape[1])
            half = members[axis > np.median(axis)]
            if not 0 < len(half) < len(members):
                break
            own[half] = j
            size[j], size[large] = len(half), len(members) - len(half)
            centroids[j] = sample[half].mean(0)
            centroids[large] = sample[own == large].mean(0)
            charge[[j, large]] = 0.0
    return centroids


class CentroidGraph:
    """Neighbour graph of the centroids, searched best first."""

    def __init__(self, centroids: np.ndarray, degree: int = 16):
        self.points = centroids
        self.least = 0.0  # a nearest distance below this counts as this
        near = np.concatenate([np.argsort(_distances(centroids[lo:lo + 1024], centroids), axis=1)[:, 1:degree + 1] for lo in range(0, len(centroids), 1024)])
        links = [set(row.tolist()) for row in near]
        for i, row in enumerate(near):
            for j in row.tolist():
                links[j].add(i)
        for i in range(len(links)):  # a ring keeps the graph in one piece
            links[i].add((i + 1) % len(links))
        self.links = [np.array(sorted(s - {i}), np.int64) for i, s in enumerate(links)]

    def search(self, q: np.ndarray, ratio: float, beam: int = 24) -> list[tuple[float, int]]:
        """(distance, centroid) of those reached, nearest first: at least all
        on the way that lie within ``ratio`` times the nearest."""
        start = float(np.linalg.norm(self.points[0] - q))
        seen, queue, found = {0}, [(start, 0)], [(-start, 0)]
        best, reached = start, [(start, 0)]
        while queue:
            d, i = heapq.heappop(queue)
            if d > ratio * max(best, self.least) and d > -found[0][0] and len(found) >= beam:
                break
            fresh = [j for j in self.links[i].tolist() if j not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for dj, j in zip(np.linalg.norm(self.points[fresh] - q, axis=1).tolist(), fresh):
                best = min(best, dj)
                reached.append((dj, j))
                heapq.heappush(queue, (dj, j))
                heapq.heappush(found, (-dj, j))
                if len(found) > beam:
                    heapq.heappop(found)
        return sorted(reached)

    def lists_for(self, q: np.ndarray, ratio: float, sizes: np.ndarray, least: int) -> list[int]:
        """Lists within ``ratio`` times the nearest, and further ones until
        they hold ``least`` entries (or there are no more)."""
        reached = self.search(q, ratio)
        if sizes[[j for _, j in reached]].sum() < least:
            reached = sorted(zip(np.linalg.norm(self.points - q, axis=1).tolist(), range(len(self.points))))
        out, held = [], 0
        for d, j in reached:
            if d > ratio * max(reached[0][0], self.least) and held >= least:
                break
            out.append(j)
            held += int(sizes[j])
        return out


_PAIRS = 1 << 16


def _scored(queries: np.ndarray, q_ids: np.ndarray, points: np.ndarray, p_ids: np.ndarray, k: int) -> pa.Table:
    """The k best points of each query by (score, smaller id), a block of
    queries at a time. The matrix product only preselects: all points that may
    tie with the k-th, as far as its rounding goes, are scored themselves."""
    out = []
    rounding = 1e-13 * np.sqrt((queries * queries).sum(1)) * np.sqrt((points * points).sum(1).max(initial=0)) * (queries.shape[1] + 1)
    for lo in range(0, len(queries), 256):
        q = queries[lo:lo + 256]
        near = q @ points.T
        if len(points) > k:
            cut = np.partition(near, len(points) - k, axis=1)[:, -k]
            rows, cols = np.nonzero(near >= (cut - rounding[lo:lo + 256])[:, None])
        else:
            rows, cols = np.repeat(np.arange(len(q)), len(points)), np.tile(np.arange(len(points)), len(q))
        exact = np.concatenate([(q[rows[i:i + _PAIRS]] * points[cols[i:i + _PAIRS]]).sum(1) for i in range(0, len(rows), _PAIRS)] or [np.zeros(0)])
        order = np.lexsort((p_ids[cols], -exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        out.append(pa.table({"query": q_ids[lo:lo + 256][rows[first]], "vid": p_ids[cols[first]], "score": exact[first]}))
    return pa.concat_tables(out)


_SCORED = "query long, vid long, score double"


def _top(rows: DataFrame, key: str, id_column: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), id_column)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
            sample_rows: int = 20_000, calibration_queries: int = 200, target_recall: float = 0.97, copies: int = 3,
            boundary: float = 0.04, max_lists: int = 4096, block_rows: int = 20_000, block_queries: int = 5_000) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every row that
    ``is_query`` selects among all rows but itself, by inner product.

    ``sample_rows`` bounds the sample that the centroids are fitted on,
    ``max_lists`` the centroids that are broadcast, ``block_rows`` and
    ``block_queries`` a task.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vec"), is_query.alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("vec")))
    widths = rows.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    if not widths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = stored(rows.where(F.size("vec") == widths[0]["w"]).dropDuplicates(["vec_id", "vec"]), "ann-rows")
    same = Window.partitionBy("vec").orderBy("vec_id")
    entries = rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1)
    entries = stored(entries.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("vid", F.element_at("ids", 1)), "ann-entries")
    asked = stored(rows.where("asks").select(F.col("vec_id").alias("query_id"), "vec").join(entries.select("vec", "vid"), "vec")
                   .select("query_id", F.col("vid").alias("query")), "ann-asked")
    queries = stored(entries.join(asked.select(F.col("query").alias("vid")).distinct(), "vid", "left_semi").select("vid", "vec"), "ann-queries")

    # fit: a bounded sample, by hash order
    n = entries.count()
    largest = entries.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()["m"] ** 0.5
    sample = np.array([r["vec"] for r in entries.orderBy(F.xxhash64("vid"), "vid").limit(sample_rows).select("vec").collect()])
    lists = int(max(1, min(max_lists, len(sample) // 4, round(n ** 0.5 / 2))))
    centroids = balanced_centroids(lifted(sample, largest), lists)
    found = CentroidGraph(centroids)
    # an outlier may be a centroid itself, and no ratio of its distance reaches others
    found.least = float(np.median(np.sqrt(_assigned(np.column_stack((sample, np.zeros(len(sample)))), centroids)[1])))
    graph = spark.sparkContext.broadcast(found)  # max_lists bounds it

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = graph.value.points
        for batch in batches:
            for lo in range(0, len(batch), 4096):
                part = batch.slice(lo, 4096)
                d = _distances(lifted(_matrix(part.column("vec")), largest), points)
                near = np.argsort(d, axis=1, kind="stable")[:, :copies]
                dn = np.take_along_axis(d, near, axis=1)
                row, col = np.nonzero(dn <= (1 + boundary) * dn[:, :1])
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(near[row, col].astype(np.int32)), taken.column("vid"), taken.column("vec")], names=["list", "vid", "vec"])

    postings = stored(entries.select("vid", "vec").mapInArrow(post, "list int, vid long, vec array<double>"), "ann-postings")

    # calibrate: a bounded set of queries against every vector
    trial = queries.orderBy(F.xxhash64("vid"), "vid").limit(calibration_queries).collect()
    trial_ids, trial_vecs = np.array([r["vid"] for r in trial], np.int64), np.array([r["vec"] for r in trial])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield from _scored(trial_vecs, trial_ids, _matrix(batch.column("vec")), batch.column("vid").to_numpy(), k + 1).to_batches()

    truth = _top(entries.select("vid", "vec").mapInArrow(scan, _SCORED), "query", "vid", k + 1)
    where = truth.join(postings.select("vid", "list"), "vid").select("query", "vid", "list").collect()  # trial * (k + 1) * copies rows at most
    d = _distances(np.column_stack((trial_vecs, np.zeros(len(trial_vecs)))), centroids)
    ratios = d / np.maximum(d.min(1, keepdims=True), found.least)
    row_of = {v: i for i, v in enumerate(trial_ids.tolist())}
    need: dict[tuple[int, int], float] = {}
    for r in where:
        key = (r["query"], r["vid"])
        need[key] = min(need.get(key, np.inf), ratios[row_of[r["query"]], r["list"]])
    ratio = float(np.quantile(list(need.values()), target_recall, method="higher")) * (1 + 1e-9)

    sizes, least = np.zeros(lists, np.int64), 4 * copies * (k + 1)
    for r in postings.groupBy("list").count().collect():  # max_lists rows at most
        sizes[r["list"]] = r["count"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = _matrix(batch.column("vec"))
            chosen = [graph.value.lists_for(np.append(v, 0.0), ratio, sizes, least) for v in vecs]
            row = np.repeat(np.arange(len(chosen)), [len(x) for x in chosen])
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array([j for x in chosen for j in x], pa.int32()), taken.column("vid"), taken.column("vec")], names=["list", "vid", "vec"])

    blocks = postings.groupBy("list").agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("blocks"))
    routed = stored(queries.mapInArrow(route, "list int, vid long, vec array<double>"), "ann-routed")
    # a long list is cut into blocks, and so are the queries that it gets
    asks = routed.groupBy("list").agg(F.ceil(F.count("*") / F.lit(block_queries)).cast("int").alias("turns"))
    blocks = F.broadcast(blocks.join(asks, "list"))  # max_lists rows at most
    routed = routed.join(blocks, "list").withColumn("turn", F.pmod(F.xxhash64("vid", F.lit(1)), F.col("turns")).cast("int"))
    routed = routed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocked = postings.join(blocks, "list").withColumn("block", F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int"))
    blocked = blocked.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))

    def meet(q: pa.Table, p: pa.Table) -> pa.Table:
        if not len(q) or not len(p):
            return pa.table({"query": pa.array([], pa.int64()), "vid": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q, p = q.combine_chunks(), p.combine_chunks()
        return _scored(_matrix(q.column("vec").combine_chunks()), q.column("vid").to_numpy(), _matrix(p.column("vec").combine_chunks()), p.column("vid").to_numpy(), k + 1)

    met = routed.select("list", "block", "turn", "vid", "vec").groupBy("list", "block", "turn").cogroup(
        blocked.select("list", "block", "turn", "vid", "vec").groupBy("list", "block", "turn")).applyInArrow(meet, _SCORED)
    best = _top(met.groupBy("query", "vid").agg(F.max("score").alias("score")), "query", "vid", k + 1).drop("rank")
    best = best.join(entries.select("vid", "ids"), "vid").select("query", "score", F.explode("ids").alias("vec_id"))
    best = stored(_top(best, "query", "vec_id", k + 1).drop("rank"), "ann-best")
    out = asked.join(best, "query").where("vec_id <> query_id")
    return _top(out, "query_id", "vec_id", k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
