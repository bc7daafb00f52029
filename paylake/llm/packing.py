"""Best-fit packing of documents into fixed-length sequences, with bounds.

Documents become token ids plus one separator id; only longer ones than a
sequence are cut, the first piece taking the remainder. Pieces are dealt into
partitions and each partition runs best-fit decreasing. Dual feasible functions
give a lower bound of its number of sequences: a partition that meets the bound
is certified and left alone. Partitions with a gap keep their full sequences,
exchange everything else (it is dealt anew into as many partitions as it fills)
and rerun best-fit decreasing, until all are certified or one partition is
left. Where what is left fills as many partitions as before, an exchange that
saves nothing ends it.

Only lengths and positions are shuffled, never ids. A partition's size is
bounded, and every piece takes part. Placement is deterministic for given
rows; ``sequence_id`` has no other meaning than "the same sequence".

Edge cases: null or empty text is one piece of just the separator; a text of
any length is tokenised whole; rows that repeat a doc_id are packed each; an
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm import words as W
from paylake.llm.common import ship, stored
from paylake.llm.segments import Recent, distinct_pieces

_SLICE = 1 << 21
_KEEP_PIECES = 300_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = _PIECES + ", rid long, sequence_id long, offset long, filled int, bins long, bound long"


class PieceTokenizer:
    """A public tokenizer that sees common pieces of text once."""

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.known = Recent(_KEEP_PIECES)  # piece -> its ids as 32-bit integers

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per row)."""
        pieces, order, per_row = distinct_pieces(texts)
        fresh = self.known.missing(pieces)
        for lo in range(0, len(fresh), 1 << 14):
            part = fresh[lo:lo + (1 << 14)]
            for p, e in zip(part, self.tokenizer.encode_batch_fast([x.decode() for x in part], add_special_tokens=False)):
                self.known.new[p] = array("I", e.ids).tobytes()
        tokens = self.known.values(pieces)
        sizes = np.array([len(x) // 4 for x in tokens], np.int64)
        flat = np.frombuffer(b"".join(tokens), np.uint32)
        each = sizes[order]
        ids = flat[W.ragged(np.concatenate(([0], np.cumsum(sizes)))[order], each)] if len(order) else flat
        ends = np.cumsum(per_row)
        return ids, np.diff(np.concatenate(([0], np.cumsum(each)))[np.concatenate(([0], ends))])


_TOKENIZERS: dict[bytes, PieceTokenizer] = {}


def _tokenizer(raw: bytes) -> PieceTokenizer:
    key = hashlib.sha256(raw).digest()
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = PieceTokenizer(raw)
    return _TOKENIZERS[key]


def document_pieces(docs: DataFrame, path: str, capacity: int, separator: int = 0) -> DataFrame:
    """Pieces of every document's ids: doc_id, piece, start, length, ids_crc32."""
    ship(docs.sparkSession)
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary: its size doesn't follow the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives this worker one core
        encode = _tokenizer(shared.value)
        for batch in batches:
            for part in W.slices(batch, "text", _SLICE):
                ids, counts = encode(part.column("text"))
                end = np.cumsum(counts)
                rows: list[tuple] = []
                sep = np.array([separator], np.uint32)
                for doc, lo, hi in zip(part.column("doc_id").to_pylist(), (end - counts).tolist(), end.tolist()):
                    own = np.concatenate((ids[lo:hi], sep)).tobytes()
                    n = hi - lo + 1
                    head = n % capacity or min(n, capacity)
                    cuts = [0, *range(head, n + 1, capacity)]
                    rows += [(doc, k, a, b - a, zlib.crc32(own[4 * a:4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return docs.mapInArrow(run, _PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, given in decreasing order: every item goes
    to the fullest bin that still holds it."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = 0  # bit r: some bin has room r
    used = 0
    bins, offsets = [], []
    for n in lengths.tolist():
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, used
            used += 1
        bins.append(b)
        offsets.append(capacity - room)
        if room > n:
            open_bins[room - n].append(b)
            rooms |= 1 << (room - n)
    return np.array(bins, np.int64), np.array(offsets, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest bins by dual feasible functions: the total, the threshold family
    (items over capacity - e count whole, items under e not at all) and the
    rounding family (multiples of capacity / (k + 1))."""
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1)
    sizes = np.arange(capacity + 1)
    by_count, by_size = np.concatenate(([0], np.cumsum(counts))), np.concatenate(([0], np.cumsum(counts * sizes)))
    e = np.arange(0, capacity // 2 + 1)
    whole = by_count[-1] - by_count[capacity - e + 1]
    middle = by_size[capacity - e + 1] - by_size[e]
    best = int(np.max(-(-(whole * capacity + middle) // capacity)))
    for k in range(1, 33):
        scaled = (k + 1) * sizes
        exact = scaled % capacity == 0
        # values in units of 1 / (k * capacity)
        value = np.where(exact, k * sizes, (scaled // capacity) * capacity)
        best = max(best, int(-(-int((counts * value).sum()) // (k * capacity))))
    return best


def _pack(capacity: int, round_no: int):
    def run(key: tuple, tbl: pa.Table) -> pa.Table:
        tbl = tbl.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("rid", "ascending")]).combine_chunks()
        lengths = tbl.column("length").to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        filled = np.bincount(bins, lengths).astype(np.int32)
        base = (round_no << 56) + (key[0].as_py() << 28)
        cols = {n: tbl.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32", "rid")}
        n = len(tbl)
        return pa.table({**cols, "sequence_id": base + bins, "offset": offsets, "filled": filled[bins],
                         "bins": np.full(n, len(filled), np.int64), "bound": np.full(n, lower_bound(lengths, capacity), np.int64)})
    return run


def best_fit_packing(docs: DataFrame, path: str, capacity: int = 2048, separator: int = 0, partition_items: int = 20_000) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and ``filled``, the tokens in its sequence.

    ``partition_items`` is the size of a partition in every round.
    """
    pieces = stored(document_pieces(docs, path, capacity, separator).withColumn("rid", F.monotonically_increasing_id()), "pieces")
    in_parts = lambda n: max(1, -(-n // partition_items))

    def deal(rows: DataFrame, parts: int, round_no: int) -> DataFrame:
        dealt = rows.withColumn("part", F.pmod(F.xxhash64(F.col("rid"), F.lit(round_no)), F.lit(parts)))
        return stored(dealt.groupBy("part").applyInArrow(_pack(capacity, round_no), _PLACED), "packed")

    parts, round_no, kept = in_parts(pieces.count()), 0, []
    placed = deal(pieces, parts, 0)
    while parts > 1:
        settled = (F.col("bins") == F.col("bound")) | (F.col("filled") == capacity)
        rest = placed.where(~settled)
        left = rest.agg(F.count("*").alias("pieces"), F.countDistinct("sequence_id").alias("sequences")).first()
        if not left["pieces"]:
            break
        # what is left fills fewer partitions, down to one; where it does not, an exchange must save sequences to go on
        fewer, round_no = in_parts(left["pieces"]), round_no + 1
        again = deal(rest.drop("sequence_id", "offset", "filled", "bins", "bound"), fewer, round_no)
        saved = left["sequences"] - again.agg(F.countDistinct("sequence_id").alias("n")).first()["n"]
        if saved >= 0:
            kept.append(placed.where(settled))
            placed = again
        if saved <= 0 and fewer >= parts:
            break
        parts = fewer
    placed = reduce(DataFrame.unionByName, [*kept, placed])
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "filled")
