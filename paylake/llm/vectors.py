"""Integer vectors in packed blocks, shared by the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """True for a vector that is there, has entries, and none of them is null or not finite."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def scaled(vector: str, scale: int) -> Column:
    """floor(scale * c) of every entry c taken as double, as long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))


def commonest_length(rows: DataFrame, vector: str) -> int:
    """The length that most vectors have (of several the greatest), 0 without rows."""
    found = rows.groupBy(F.size(vector).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return found["length"] if found else 0


def pack(rows: DataFrame, vector: str, dimension: int, block_rows: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per block of at most ``block_rows`` vectors of ``dimension``
    entries: part (the task), nth, n, x (row-major 64-bit integers, little
    endian) and, per column of ``keep`` (longs), the values as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, waiting, have = TaskContext.get().partitionId(), 0, [], 0

        def emit(n):
            nonlocal waiting, have, nth
            whole = pa.Table.from_batches(waiting).combine_chunks()
            head, rest = whole.slice(0, n), whole.slice(n)
            x = head.column(vector).combine_chunks()
            x = x.flatten().to_numpy(zero_copy_only=False).astype("<i8", copy=False)
            cols = [pa.ListArray.from_arrays(pa.array([0, head.num_rows], pa.int32()), head.column(c).combine_chunks()) for c in keep]  # nulls stay
            out = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([nth], pa.int32()), pa.array([n], pa.int32()),
                                              pa.array([x.tobytes()], pa.binary()), *cols], names=["part", "nth", "n", "x", *keep])
            waiting, have, nth = (rest.to_batches() if rest.num_rows else []), rest.num_rows, nth + 1
            return out

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                have += batch.num_rows
            while have >= block_rows:
                yield emit(block_rows)
        if have:
            yield emit(have)

    schema = "part int, nth int, n int, x binary" + "".join(f", {c} array<bigint>" for c in keep)
    return rows.where(F.size(vector) == dimension).select(vector, *keep).mapInArrow(run, schema)


def unpacked(x: bytes, dimension: int) -> np.ndarray:
    return np.frombuffer(x, "<i8").reshape(-1, dimension)
