"""Whitening of embeddings by distributed block matrices (Spark MLlib).

Vectors become integers, floor(scale * entry). The fit list holds every
distinct vector once. Its centred rows are indexed into the blocks of an MLlib
``BlockMatrix`` A; the product of A's transpose and A is the scatter matrix,
whose eigenvectors are found on the driver (dimension x dimension numbers,
whatever the number of rows). A second product, of the blocks of all rows and
the whitening matrix, projects them; the covariance of the projected fit list
is measured, not derived.

Bounded memory: a block has about ``block_entries`` numbers. The scatter's
product is split over as many tasks as the blocks have partitions (by default
all blocks of a product with one result block meet in one task); each adds up
its share and sends one matrix. Vectors are packed inside the task that reads
them, so a vector that a third of all rows share costs no more than others;
distinct vectors are found with map-side partial aggregation. On the driver:
one number per task that packed blocks, and MLlib's list of block coordinates
(one per ``block_entries`` numbers).

Edge cases: rows whose vector is null, empty, of another length than most
(of lengths equally common the greatest counts), or holds a null or non-finite
entry take no part; rows are returned each, repeated ones too, null ids
included; a component without variance (eigenvalue not above ``dimension *
1e-12`` times the greatest) is not returned, so a table whose vectors are all
one has no result, as has an empty table; ``deviation`` is null where it
exceeds a long; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.common import ship, stored
from paylake.llm.vectors import commonest_length, finite, pack, scaled, unpacked

SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _numbered(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Stored blocks with consecutive numbers, and how many there are."""
    per_task = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.count("*").alias("n")).collect()}
    parts = sorted(per_task)
    before = dict(zip(parts, accumulate([0, *(per_task[p] for p in parts)])))
    spark = blocks.sparkSession
    first = spark.createDataFrame([(p, before[p]) for p in parts], "part int, first int")
    return blocks.join(F.broadcast(first), "part").select((F.col("first") + F.col("nth")).alias("block"), "n", "x", *(c for c in blocks.columns if c == "vec_id")), sum(per_task.values())


#: MLlib's matrix type as Arrow carries it.
_MATRIX = pa.struct([("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
                     ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_())])


def _matrix(blocks: DataFrame, count: int, rows: int, mean: np.ndarray) -> BlockMatrix:
    """The centred rows of numbered blocks; blocks are filled up with rows of
    zeros. The blocks go to the JVM as Arrow columns of MLlib's matrix type:
    the constructor for Python matrices would send every number by itself."""
    d = len(mean)

    def centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, n, x in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "x"))):
                out = np.zeros((rows, d))
                out[:n] = unpacked(x, d) - mean
                values = pa.ListArray.from_arrays(pa.array([0, rows * d], pa.int32()), pa.array(out.ravel()))
                none = pa.array([None], pa.list_(pa.int32()))
                matrix = pa.StructArray.from_arrays([pa.array([1], pa.int8()), pa.array([rows], pa.int32()), pa.array([d], pa.int32()), none, none, values,
                                                     pa.array([True])], fields=list(_MATRIX))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), matrix], names=["block", "matrix"])

    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("matrix", MatrixUDT())])
    indexed = blocks.select("block", "n", "x").mapInArrow(centred, schema).select(F.struct("block", F.lit(0).cast("long").alias("column")), "matrix")
    return BlockMatrix(callMLlibFunc("createBlockMatrix", indexed, rows, d, count * rows, d), rows, d)


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left x right; the middle dimension is dealt to ``splits`` tasks for each
    result partition (an argument of the JVM method that Python's lacks)."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def _projected(spark: SparkSession, matrix: BlockMatrix, whitening: np.ndarray, name: str) -> DataFrame:
    """Stored (block, p): the projected rows of each block, row-major doubles."""
    d, k = whitening.shape
    local = spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, k, whitening.ravel(order="F")))], 1)
    out = _product(matrix, BlockMatrix(local, d, k, d, k), 1).blocks
    return stored(out.map(lambda b: (int(b[0][0]), np.ascontiguousarray(b[1].toArray()).tobytes())).toDF("block int, p binary"), name)


def _sums(blocks: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, x in zip(batch.column("n").to_pylist(), batch.column("x").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([unpacked(x, dimension).sum(axis=0).tolist()])], names=["n", "s"])

    found = blocks.select("n", "x").mapInArrow(run, "n bigint, s array<bigint>")
    sums = found.select(F.posexplode("s").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    n = found.agg(F.sum("n")).first()[0] or 0
    return n, [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])]


def _identity_error(projected: DataFrame, blocks: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the projected rows' covariance minus the identity."""
    both = projected.join(blocks.select("block", "n"), "block").select("n", "p")

    def total(row_value):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = 0.0
            for batch in batches:
                for rows, p in zip(batch.column("n").to_pylist(), batch.column("p").to_pylist()):
                    out = out + row_value(np.frombuffer(p).reshape(-1, k)[:rows])
            if np.ndim(out):
                yield pa.RecordBatch.from_arrays([pa.array([out.ravel().tolist()])], names=["v"])

        parts = both.mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("i", "v"))
        return np.array([r["v"] for r in parts.groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()])

    mean = total(lambda p: p.sum(axis=0)) / n
    covariance = total(lambda p: (p - mean).T @ (p - mean)).reshape(k, k) / n
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256, block_entries: int = 1 << 18, id_column: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1, by
    falling variance), n (vectors of the fit list), deviation (sum over the
    entries of (n*x - S)^2), whitened, explained, identity_error."""
    spark = vectors.sparkSession
    ship(spark)
    usable = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(finite("v"))
    usable = usable.select("vec_id", scaled("v", scale).alias("x"))
    d = commonest_length(usable, "x")
    if not d:
        return spark.createDataFrame([], SCHEMA)
    block_rows = max(1, block_entries // d)
    distinct = usable.where(F.size("x") == d).select("x").distinct()
    fit, fit_count = _numbered(stored(pack(distinct, "x", d, block_rows), "whiten-fit"))
    n, sums = _sums(fit, d)
    mean = np.array([s / n for s in sums])

    height = fit.agg(F.max("n")).first()[0]
    fitted = _matrix(fit, fit_count, height, mean)
    splits = max(1, min(fit_count, spark.sparkContext.defaultParallelism * 4))
    covariance = _product(fitted.transpose(), fitted, splits).toLocalMatrix().toArray() / n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    values, axes = values[::-1], axes[:, ::-1]
    k = int((values[:min(components, d)] > max(values[0], 0) * d * 1e-12).sum())
    if not k:  # nothing varies
        return spark.createDataFrame([], SCHEMA)
    whitening = axes[:, :k] / np.sqrt(values[:k])
    error = _identity_error(_projected(spark, fitted, whitening, "whiten-fit-projected"), fit, n, k)

    rows, row_count = _numbered(stored(pack(usable, "x", d, block_rows, ("vec_id",)), "whiten-rows"))
    height = rows.agg(F.max("n")).first()[0]
    projected = _projected(spark, _matrix(rows, row_count, height, mean), whitening, "whiten-projected")
    explained = (values[:k] / values.sum()).tolist()

    def deviations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, x in zip(*(batch.column(c).to_pylist() for c in ("block", "vec_id", "x"))):
                x = unpacked(x, d)
                most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
                kind = np.int64 if most * most * d < 1 << 63 else object  # integers of any size where a long may not hold them
                off = x.astype(kind) * n - np.array(sums, kind)
                dev = [int(v) if v < 1 << 63 else None for v in (off * off).sum(axis=1)]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([dev], pa.list_(pa.int64()))],
                                                 names=["block", "vec_id", "deviation"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, dev = batch.column("vec_id")[i].values, batch.column("deviation")[i].values
                p = np.frombuffer(batch.column("p")[i].as_py()).reshape(-1, k)[:len(ids)]
                for c in range(k):
                    same = lambda v, kind: pa.array(np.full(len(ids), v), kind)
                    yield pa.RecordBatch.from_arrays([ids, same(c + 1, pa.int32()), same(n, pa.int64()), dev, pa.array(np.ascontiguousarray(p[:, c])),
                                                      same(explained[c], pa.float64()), same(error, pa.float64())], names=[f.split()[0] for f in SCHEMA.split(", ")])

    narrow = rows.select("block", "vec_id", "x").mapInArrow(deviations, "block int, vec_id array<bigint>, deviation array<bigint>")
    return narrow.join(projected, "block").select("vec_id", "deviation", "p").mapInArrow(spread, SCHEMA)
