"""SimHash near-dedup by the generalised pigeonhole principle.

Every document gets a 64-bit fingerprint; two link if at most ``max_bits`` bits
differ. Bits that rise and fall together are grouped into partitions, and each
partition i gets its own threshold t_i with sum(t_i + 1) = max_bits + 1: a pair
within ``max_bits`` must then lie within t_i in some partition. A partition
with t_i = -1 is never probed. The thresholds (and the number of partitions)
come from dynamic programming over estimated candidate counts, which a tree
model of the bits gives from the co-occurrence counts of *all* fingerprints.

Fingerprints are made distinct first, so copies cost nothing. Probe and index
rows meet in a join whose condition is the bit distance, so only links leave
it. Buckets above ``bucket_limit`` are not compared pair by pair: two
fingerprints are within distance d exactly when the balls of radius ceil(d/2)
around them share a point, and a point has at most that many distinct owners,
so the members of such buckets meet at the points of their balls instead. Both
ways are exact; nothing is capped.

Edge cases: null or blank text has fingerprint zero and links like any other;
fewer words than a shingle make one shingle; rows that repeat a doc_id each get
their row; a component whose doc_ids are all null has a null component_id.
Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm import words as W
from paylake.llm.common import ship, stored
from paylake.llm.components import components

BITS = 64
_SLICE = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints_of(texts: pa.Array, shingle: int, seed: int) -> np.ndarray:
    """Unsigned fingerprints of a string array."""
    data, offs = W.buffer_of(texts)
    starts, ends, counts = W.word_spans(data, offs)
    out = np.zeros(len(counts), np.uint64)
    if not len(starts):
        return out
    lengths = ends - starts + 1
    src = W.ragged(starts, lengths)
    src[src == len(data)] = 0
    flat = _LOWER[data[src]]
    stop = np.cumsum(lengths)
    flat[stop - 1] = 32
    begin = stop - lengths
    n_shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    first = W.ragged(np.concatenate(([0], np.cumsum(counts)[:-1])), n_shingles)
    width = np.repeat(np.minimum(counts, shingle), n_shingles)
    raw = flat.tobytes()
    digest = xxhash.xxh64_intdigest
    los, his = begin[first].tolist(), (stop[first + width - 1] - 1).tolist()
    hashes = np.fromiter((digest(raw[a:b], seed) for a, b in zip(los, his)), np.uint64, len(los))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    some = n_shingles > 0
    at = (np.cumsum(n_shingles) - n_shingles)[some]
    ones = np.add.reduceat(bits, at, axis=0, dtype=np.int64)
    major = (2 * ones > n_shingles[some][:, None]).astype(np.uint8)
    out[some] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, column: str = "simhash") -> DataFrame:
    """``docs`` with its columns and the signed fingerprint of ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", _SLICE):
                fp = fingerprints_of(part.column("text"), shingle, seed)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(fp.view(np.int64))], names=[*part.schema.names, column])

    ship(docs.sparkSession)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())]))


def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often bits i and j are both set, of one partition's fingerprints."""
    total = np.zeros((BITS, BITS))
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        for lo in range(0, len(fp), 1 << 16):
            bits = np.unpackbits(fp[lo:lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
    i, j = np.divmod(np.arange(BITS * BITS), BITS)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel().astype(np.int64))], names=["i", "j", "n"])


def bit_correlation(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """(number of fingerprints, joint counts of set bits); 4,096 sums reach
    the driver whatever the number of fingerprints."""
    rows = distinct.select("fp").mapInArrow(_bit_counts, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    joint = np.zeros((BITS, BITS))
    for r in rows:
        joint[r["i"], r["j"]] = r["n"]
    return distinct.count(), joint


def _phi(n: int, joint: np.ndarray) -> np.ndarray:
    p = joint.diagonal() / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs((joint / n - np.outer(p, p)) / np.outer(sd, sd))


def group_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of near equal size, correlated bits together:
    each group starts at the most correlated free pair and grows greedily."""
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        a = max(sorted(free), key=lambda i: max((corr[i, j] for j in free if j != i), default=0))
        group = [a]
        free.remove(a)
        while len(group) < size:
            b = max(sorted(free), key=lambda j: corr[group, j].sum())
            group.append(b)
            free.remove(b)
        groups.append(sorted(group))
    return groups


def within_share(group: list[int], n: int, joint: np.ndarray, most: int) -> np.ndarray:
    """Estimated share of fingerprint pairs within 0..most bits in ``group``.

    Two independent draws from a tree model of the bits (a maximum spanning
    tree of correlations): a message from child to parent holds, for the
    parent's two values in the two draws, the chance of each distance.
    """
    p = np.clip(joint.diagonal() / n, 0.5 / n, 1 - 0.5 / n)
    corr = _phi(n, joint)
    order, parent = [group[0]], {}
    while len(order) < len(group):
        a, b = max(((a, b) for a in order for b in group if b not in order), key=lambda e: corr[e])
        order.append(b)
        parent[b] = a
    up = {i: np.zeros((2, 2, most + 1)) for i in group}
    for i in group:
        up[i][:, :, 0] = 1
    for child in reversed(order[1:]):
        a = parent[child]
        both = np.clip(joint[child, a] / n, 0, min(p[child], p[a]))
        given = np.clip([(p[child] - both) / (1 - p[a]), both / p[a]], 0.0, 1.0)  # P(child = 1 | parent = 0, 1)
        message = np.zeros((2, 2, most + 1))
        for x, y, cx, cy in itertools.product((0, 1), repeat=4):
            chance = (given[x] if cx else 1 - given[x]) * (given[y] if cy else 1 - given[y])
            part = up[child][cx, cy]
            message[x, y, int(cx != cy):] += chance * (part[:-1] if cx != cy else part)
        for x, y in itertools.product((0, 1), repeat=2):
            up[a][x, y] = np.convolve(up[a][x, y], message[x, y])[:most + 1]
    root, out = order[0], np.zeros(most + 1)
    for x, y in itertools.product((0, 1), repeat=2):
        chance = (p[root] if x else 1 - p[root]) * (p[root] if y else 1 - p[root])
        out[int(x != y):] += chance * (up[root][x, y][:-1] if x != y else up[root][x, y])
    return np.cumsum(out)


def allocate(costs: list[list[float]], units: int) -> list[int]:
    """Thresholds of least total cost with sum(t + 1) = units; ``costs[i][t]``
    is the cost of probing partition i up to distance t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, ts) in best.items():
            for t in range(-1, units - used):
                c = so_far + (cost[t] if t >= 0 else 0.0)
                if used + t + 1 not in step or c < step[used + t + 1][0]:
                    step[used + t + 1] = (c, [*ts, t])
        best = step
    return best[units][1]


def plan_partitions(n: int, joint: np.ndarray, max_bits: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the partitions to probe: candidates plus probe rows
    are estimated for 1 to max_bits + 2 partitions, and the cheapest plan wins."""
    corr, plans = _phi(n, joint), []
    for parts in range(1, max_bits + 3):
        groups = group_bits(corr, parts)
        costs = []
        for g in groups:
            share = within_share(g, n, joint, max_bits)
            costs.append([n * n / 2 * share[t] + n * sum(math.comb(len(g), k) for k in range(t + 1)) for t in range(max_bits + 1)])
        ts = allocate(costs, max_bits + 1)
        plans.append((sum(c[t] for c, t in zip(costs, ts) if t >= 0), [(g, t) for g, t in zip(groups, ts) if t >= 0]))
    return min(plans, key=lambda x: x[0])[1]


def _flips(bits: list[int], most: int) -> list[int]:
    """Signed 64-bit masks of all sets of up to ``most`` of the bits."""
    masks = [sum(1 << b for b in c) for k in range(most + 1) for c in itertools.combinations(bits, k)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _literals(values: list[int]):
    return F.array(*[F.lit(v).cast("long") for v in values])


def links(distinct: DataFrame, max_bits: int, bucket_limit: int = 256) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that connect all those within
    ``max_bits``: every link found by probing, and for crowded buckets a chain
    through each shared ball point."""
    spark = distinct.sparkSession
    n, joint = bit_correlation(distinct)
    if n < 2 or max_bits < 1:
        return spark.createDataFrame([], "a long, b long")
    index = probe = None
    for k, (bits, t) in enumerate(plan_partitions(n, joint, max_bits)):
        mask = F.lit(_signed(sum(1 << b for b in bits))).cast("long")
        own = distinct.select(F.lit(k).alias("part"), F.col("fp").bitwiseAND(mask).alias("key"), "fp")
        near = own if t == 0 else distinct.select("fp", F.explode(_literals(_flips(bits, t))).alias("flip")).select(
            F.lit(k).alias("part"), F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(mask).alias("key"), "fp")
        index = own if index is None else index.union(own)
        probe = near if probe is None else probe.union(near)
    crowded = stored(index.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket_limit).select("part", "key"), "crowded")
    a, b = probe.withColumnRenamed("fp", "a"), index.withColumnRenamed("fp", "b")
    if crowded.isEmpty():
        return _close(a, b, max_bits)
    a_calm, b_calm = (x.join(crowded, ["part", "key"], "left_anti") for x in (a, b))
    hot = a.join(crowded, ["part", "key"], "left_semi").select(F.col("a").alias("fp")).distinct()
    radius = (max_bits + 1) // 2
    points = hot.select("fp", F.explode(_literals(_flips(list(range(BITS)), radius))).alias("flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "fp")
    # A point has at most one owner per flip; points of one owner say nothing.
    meet = points.groupBy("point").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("owners")).where(F.size("owners") > 1)
    if max_bits % 2:  # balls of the larger radius may meet one bit too far
        met = meet.select(F.explode("owners").alias("a"), "owners").select("a", F.explode("owners").alias("b"))
        chained = met.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).distinct()
    else:
        chained = meet.select("a", F.explode("owners").alias("b")).where("a <> b").distinct()
    return _close(a_calm, b_calm, max_bits).union(chained)


def _close(a: DataFrame, b: DataFrame, max_bits: int) -> DataFrame:
    b = b.select(F.col("part").alias("part_b"), F.col("key").alias("key_b"), "b")
    on = (F.col("part") == F.col("part_b")) & (F.col("key") == F.col("key_b")) & (F.col("a") != F.col("b")) & (
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return a.join(b, on).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42, bucket_limit: int = 256) -> DataFrame:
    """One row per document: doc_id, simhash (signed), component_id (smallest
    doc_id reachable over links, itself included) and component_size."""
    fps = stored(with_fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle, seed).drop("text"), "simhash")
    distinct = stored(fps.groupBy(F.col("simhash").alias("fp")).agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-distinct")
    labels = components(links(distinct, max_bits, bucket_limit))
    joined = distinct.join(labels, distinct["fp"] == labels["node"], "left").withColumn("label", F.coalesce("label", "fp"))
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"), F.sum("n").alias("component_size"))
    classes = joined.select("fp", "label").join(least, "label").select(F.col("fp").alias("simhash"), "component_id", "component_size")
    return fps.join(classes, "simhash").select("doc_id", "simhash", "component_id", "component_size")


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its columns: of each component only the document whose
    doc_id names it (rows without doc_id stay if their whole component has
    none; rows that repeat a doc_id stay or go together)."""
    found = near_duplicates(docs, **options).where("component_size > 1")
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"))
    return rows.join(gone, F.col("id").eqNullSafe(F.col("gone")), "left_anti").select("row.*")
