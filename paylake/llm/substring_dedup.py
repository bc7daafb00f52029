"""Substring dedup by level-wise doubling.

A *window* is a run of consecutive words of one document. Level by level, only
windows whose two halves are known to repeat are looked at:

* level ``ceil(n/2)``: every window's short hash is counted over the corpus;
* level ``n`` (``min_words``): windows whose halves both repeat are compared by
  a 128-bit hash, and every later occurrence is marked for removal;
* levels ``2n, 4n, ..``: windows whose halves both repeated at the level before
  are compared again, until no candidate survives. The last level at which a
  document still repeats an earlier passage is its ``longest_repeat``.

Documents are dealt into *chunks* by ranges of ``doc_id``, so "an earlier
chunk" means "an earlier document" and no occurrence list is ever gathered: a
chunk sends each of its distinct hashes once, sorted and packed, to the task
that owns that hash range, and gets back which of them other chunks hold. A
passage shared by a third of the corpus therefore costs one entry per chunk.
A hash range is of bounded size, and so is a chunk: an id that fills chunks by
itself, as rows without one do together, is cut by the first bytes of its texts.

Edge cases: a null or blank text has no words; fewer than ``min_words`` words
have no window; rows without ``doc_id`` come after all others; rows with equal
``doc_id`` are ordered by their text. Exact copies of a document lose all their
words (if they have a window). Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm import words as W
from paylake.llm.common import partitions, ship, stored

_LAST_ID = (1 << 63) - 1
_SLICE = 1 << 20
#: One Arrow schema for the packed messages between chunks and hash ranges.
_MESSAGE = "bucket int, chunk int, n int, data binary, earlier binary"
_RESULT = ("chunk int, doc_id long, n_words long, n_removed long, kept_sha256 string, longest_repeat long, "
           "kept_text string, state binary")


def _pack(values: np.ndarray) -> bytes:
    """Sorted unsigned integers as zstd-compressed byte planes of their gaps."""
    gaps = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(gaps).view(np.uint8).reshape(-1, 8).T
    used = 8 - int(np.argmax(planes.any(axis=1)[::-1])) if len(values) else 1
    raw = np.ascontiguousarray(planes[:used]).tobytes()
    return bytes([used]) + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    used = data[0]
    raw = pa.decompress(data[1:], decompressed_size=used * n, codec="zstd", asbytes=True)
    planes = np.zeros((8, n), np.uint8)
    planes[:used] = np.frombuffer(raw, np.uint8).reshape(used, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _messages(values: np.ndarray, chunk: int, buckets: int, bits: int, second: np.ndarray | None = None) -> pa.Table:
    """One row per hash range that holds any of the sorted ``values``."""
    edges = [(b << bits) // buckets for b in range(1, buckets)]
    cut = np.concatenate(([0], np.searchsorted(values, np.array(edges, np.uint64)), [len(values)]))
    rows = []
    for b in np.flatnonzero(np.diff(cut)):
        lo, hi = cut[b], cut[b + 1]
        rows.append((int(b), chunk, int(hi - lo), _pack(values[lo:hi]), b"" if second is None else second[lo:hi].tobytes()))
    return _table(rows)


def _table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[]] * 5
    types = [("bucket", pa.int32()), ("chunk", pa.int32()), ("n", pa.int32()), ("data", pa.binary()), ("earlier", pa.binary())]
    return pa.table([pa.array(c, t) for c, (_, t) in zip(cols, types)], names=[n for n, _ in types])


class _Chunk:
    """Words of one chunk's documents, in order of doc_id, then text."""

    def __init__(self, tbl: pa.Table):
        tbl = tbl.sort_by([("order_id", "ascending"), ("text", "ascending")]).combine_chunks()
        self.ids = tbl.column("order_id").to_numpy()
        self.text = tbl.column("text").combine_chunks()
        hashes, counts = [], []
        for part in W.slices(tbl.select(["text"]), "text", _SLICE):
            data, offs = W.buffer_of(part.column("text").combine_chunks())
            starts, ends, per_row = W.word_spans(data, offs)
            hashes.append(W.span_hashes(data, starts, ends))
            counts.append(per_row)
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.offs = np.concatenate(([0], np.cumsum(self.counts)))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first word) of every window, hashed in pieces of rows."""
        out_h, out_at = [], []
        row = 0
        while row < len(self.counts):
            end = int(np.searchsorted(self.offs, self.offs[row] + (1 << 18), side="right")) - 1
            end = max(end, row + 1)
            lo, hi = self.offs[row], self.offs[end]
            h, at, _ = W.window_hashes(self.words[lo:hi], self.counts[row:end], width)
            out_h.append(h)
            out_at.append(at + lo)
            row = end
        return (np.concatenate(out_h), np.concatenate(out_at)) if out_h else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def whole(self) -> np.ndarray:
        """Hash of each document's whole word sequence with its length; marks
        exact copies, whose windows need no further level."""
        n = len(self.words)
        sums = np.zeros(n + 1, np.uint64)
        base = 0xA24BAED4963EE407
        np.cumsum(self.words * W.powers(base, n), out=sums[1:])
        inv = W.powers(pow(base, -1, 1 << 64), n + 1)
        h = (sums[self.offs[1:]] - sums[self.offs[:-1]]) * inv[self.offs[:-1]]
        return W.mix(h ^ W.mix(self.counts.astype(np.uint64) + np.uint64(1)))


def _first_occurrence(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, index of each one's first occurrence, the way
    back from occurrences to values, and how often each occurs."""
    return np.unique(h, return_index=True, return_inverse=True, return_counts=True)


def _base(tbl: pa.Table, width: int, bits: int, buckets: int) -> pa.Table:
    chunk = tbl.column("chunk")[0].as_py()
    h, _ = _Chunk(tbl).windows(width)
    return _messages(np.unique(h >> np.uint64(64 - bits)), chunk, buckets, bits)


def _resolve(tbl: pa.Table, exact: bool) -> pa.Table:
    """For a range of hashes: which values of each chunk other chunks hold.

    Without ``exact`` a chunk gets one bit per value it sent; with it, the
    shared values themselves and one bit each for "an earlier chunk has it".
    """
    chunks = tbl.column("chunk").to_numpy()
    sizes = tbl.column("n").to_numpy()
    data, extra = tbl.column("data"), tbl.column("earlier")
    values = np.concatenate([_unpack(data[i].as_py(), int(sizes[i])) for i in range(len(tbl))])
    owner = np.repeat(np.arange(len(tbl)), sizes)
    rank = np.repeat(chunks, sizes)
    if exact and extra[0].as_py():
        second = np.concatenate([np.frombuffer(extra[i].as_py(), np.uint64) for i in range(len(tbl))])
    else:
        second = np.zeros(0, np.uint64)
    order = np.lexsort((rank, second, values)) if len(second) else np.lexsort((rank, values)) if exact else np.argsort(values, kind="stable")
    v = values[order]
    same = v[1:] == v[:-1]
    if len(second):
        s = second[order]
        same &= s[1:] == s[:-1]
    shared = np.zeros(len(v), bool)
    earlier = np.zeros(len(v), bool)
    shared[order[1:]] = same
    earlier[order[1:]] = same  # within equal values, all but the first chunk
    shared[order[:-1]] |= same
    rows = []
    cut = np.concatenate(([0], np.cumsum(sizes)))
    bucket = tbl.column("bucket")[0].as_py()
    for i in range(len(tbl)):
        part = slice(cut[i], cut[i + 1])
        if exact:
            hit = shared[part]
            if hit.any():
                rows.append((bucket, int(chunks[i]), int(hit.sum()), _pack(values[part][hit]), np.packbits(earlier[part][hit]).tobytes()))
        else:
            rows.append((bucket, int(chunks[i]), int(sizes[i]), np.packbits(shared[part]).tobytes(), b""))
    return _table(rows)


def _base_flags(resp: pa.Table, values: np.ndarray) -> np.ndarray:
    """Bits of all hash ranges, in the order of the sorted values sent."""
    flags = np.zeros(len(values), bool)
    at = 0
    resp = resp.sort_by("bucket")
    for n, data in zip(resp.column("n").to_pylist(), resp.column("data")):
        flags[at:at + n] = np.unpackbits(np.frombuffer(data.as_py(), np.uint8), count=n).astype(bool)
        at += n
    return flags


def _pair_at(flags_at: np.ndarray, offs: np.ndarray, flagged: np.ndarray, gap: int, n_words: int) -> np.ndarray:
    """First words ``i`` such that flagged windows start at i and at i+gap."""
    mark = np.zeros(n_words + gap + 1, bool)
    mark[flags_at[flagged]] = True
    at = np.flatnonzero(mark[:n_words] & mark[gap:gap + n_words])
    row = np.searchsorted(offs, at, side="right") - 1
    return at[at + gap < offs[row + 1]]


def _hash_at(words: np.ndarray, at: np.ndarray, width: int, base: int) -> np.ndarray:
    n = len(words)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * W.powers(base, n), out=sums[1:])
    return W.mix((sums[at + width] - sums[at]) * W.powers(pow(base, -1, 1 << 64), n)[at])


_SECOND = 0xC2B2AE3D27D4EB4F


def _level(key, tbl: pa.Table, resp: pa.Table, width: int, bits: int, target: int, buckets: int) -> pa.Table:
    """Send the 128-bit hashes of the windows whose halves repeat."""
    if not len(tbl):
        return _table([])
    c = _Chunk(tbl)
    h, at = c.windows(width)
    values, _, back, times = _first_occurrence(h >> np.uint64(64 - bits))
    repeats = (_base_flags(resp, values) | (times > 1))[back]
    cand = _pair_at(at, c.offs, repeats, target - width, len(c.words))
    cand = cand[cand + target <= c.offs[np.searchsorted(c.offs, cand, side="right")]]
    h1 = np.concatenate((_hash_at(c.words, cand, target, W._BASE ^ 0x5851F42D4C957F2C | 1), c.whole()))
    h2 = np.concatenate((_hash_at(c.words, cand, target, _SECOND), W.mix(c.whole() + np.uint64(1))))
    order = np.lexsort((h2, h1))
    h1, h2 = h1[order], h2[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return _messages(h1[new], int(key[0].as_py()), buckets, 64, h2[new])


def _shared(resp: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes that other chunks hold too, and whether an earlier one."""
    resp = resp.sort_by("bucket")
    vs, es = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    for n, data, earlier in zip(resp.column("n").to_pylist(), resp.column("data"), resp.column("earlier")):
        vs.append(_unpack(data.as_py(), n))
        es.append(np.unpackbits(np.frombuffer(earlier.as_py(), np.uint8), count=n).astype(bool))
    return np.concatenate(vs), np.concatenate(es)


def _look_up(h: np.ndarray, resp: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(repeats anywhere, starts earlier) of each occurrence in ``h``, which is
    in document order."""
    values, first, back, times = _first_occurrence(h)
    known, before = _shared(resp)
    at = np.searchsorted(known, values)
    hit = np.zeros(len(values), bool)
    inside = at < len(known)
    hit[inside] = known[at[inside]] == values[inside]
    early = np.zeros(len(values), bool)
    early[hit] = before[at[hit]]
    anywhere = (hit | (times > 1))[back]
    starts_earlier = early[back]
    local = np.ones(len(h), bool)
    local[first] = False
    return anywhere, starts_earlier | local


def _state(chunk: int, at: np.ndarray, h: np.ndarray, c_offs: np.ndarray, ids: np.ndarray) -> bytes:
    """What the next level needs of a chunk: candidate positions and hashes,
    and the documents they lie in."""
    rows = np.unique(np.searchsorted(c_offs, at, side="right") - 1)
    head = np.array([len(at), len(rows)], np.int64)
    gaps = _pack(at.astype(np.uint64)) if len(at) else b""
    return b"".join((head.tobytes(), ids[rows].astype(np.int64).tobytes(), c_offs[rows].astype(np.int64).tobytes(),
                     c_offs[rows + 1].astype(np.int64).tobytes(), h.tobytes(), gaps))


def _read_state(raw: bytes):
    n, docs = (int(x) for x in np.frombuffer(raw, np.int64, 2))
    p = 16
    ids, lo, hi = (np.frombuffer(raw, np.int64, docs, p + 8 * docs * k) for k in range(3))
    p += 24 * docs
    h = np.frombuffer(raw, np.uint64, n, p)
    at = _unpack(raw[p + 8 * n:], n).astype(np.int64)
    return at, h, ids, lo, hi


def _result(rows: dict) -> pa.Table:
    types = [("chunk", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
             ("kept_sha256", pa.string()), ("longest_repeat", pa.int64()), ("kept_text", pa.string()), ("state", pa.binary())]
    n = max((len(v) for v in rows.values()), default=0)
    return pa.table([pa.array(rows[k], t) if k in rows else pa.nulls(n, t) for k, t in types], names=[k for k, _ in types])


def _finish(key, tbl: pa.Table, resp: pa.Table, target: int, with_text: bool) -> pa.Table:
    """Remove the marked words; hand candidates of twice the length on."""
    if not len(tbl):
        return _result({})
    c = _Chunk(tbl)
    chunk = int(key[0].as_py())
    h, at = c.windows(target)
    n_windows = len(h)
    anywhere, earlier = _look_up(np.concatenate((h, c.whole())), resp)
    copy = earlier[n_windows:] & (c.counts >= target)
    anywhere, earlier = anywhere[:n_windows], earlier[:n_windows]
    depth = np.zeros(len(c.words) + 1, np.int64)
    np.add.at(depth, at[earlier], 1)
    np.subtract.at(depth, at[earlier] + target, 1)
    gone = np.cumsum(depth[:-1]) > 0
    removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[c.offs])
    row_of = np.searchsorted(c.offs, at, side="right") - 1
    longest = np.zeros(len(c.counts), np.int64)
    longest[row_of[earlier]] = target
    longest[copy] = c.counts[copy]
    shas, texts = [], []
    row = 0
    for part in W.slices(pa.table({"text": c.text}), "text", _SLICE):
        data, offs = W.buffer_of(part.column("text").combine_chunks())
        starts, ends, per_row = W.word_spans(data, offs)
        keep = ~gone[c.offs[row]:c.offs[row + len(per_row)]]
        # every kept word with one space after it; the last of a row has none
        kept_rows = np.add.reduceat(np.concatenate((keep, [False])).astype(np.int64), np.concatenate(([0], np.cumsum(per_row)))[:-1]) * (per_row > 0)
        lengths = (ends - starts)[keep] + 1
        src = W.ragged(starts[keep], lengths)
        src[src == len(data)] = 0  # only ever the place of a space
        flat = data[src] if len(data) else np.zeros(0, np.uint8)
        flat[np.cumsum(lengths) - 1] = 32
        bounds = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(kept_rows)))]
        raw = flat.tobytes()
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            kept = raw[a:max(a, b - 1)]
            shas.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                texts.append(kept.decode())
        row += len(per_row)
    out = {"chunk": np.full(len(c.ids), chunk, np.int32), "doc_id": pa.array(c.ids, mask=c.ids == _LAST_ID), "n_words": c.counts,
           "n_removed": removed, "kept_sha256": shas, "longest_repeat": longest}
    if with_text:
        out["kept_text"] = texts
    # candidates of the next level: both halves repeat; copies are settled
    live = anywhere & ~copy[row_of]
    nxt = _pair_at(at, c.offs, live, target, len(c.words))
    if not len(nxt):
        return _result(out)
    hash_at = np.zeros(len(c.words), np.uint64)
    hash_at[at] = h
    joined = W.mix(hash_at[nxt] * np.uint64(W._BASE) + hash_at[nxt + target])
    return pa.concat_tables([_result(out), _result({"chunk": [chunk], "state": [_state(chunk, nxt, joined, c.offs, c.ids)]})])


def _send(tbl: pa.Table, buckets: int) -> pa.Table:
    chunk = tbl.column("chunk")[0].as_py()
    _, h, *_ = _read_state(tbl.column("state")[0].as_py())
    return _messages(np.unique(h), chunk, buckets, 64)


def _double(key, tbl: pa.Table, resp: pa.Table, length: int) -> pa.Table:
    """Settle the level of ``length`` words for one chunk and double."""
    if not len(tbl):
        return _result({})
    chunk = int(key[0].as_py())
    at, h, ids, lo, hi = _read_state(tbl.column("state")[0].as_py())
    anywhere, earlier = _look_up(h, resp)
    row_of = np.searchsorted(lo, at, side="right") - 1
    found = np.unique(row_of[earlier])
    out = _result({"chunk": np.full(len(found), chunk, np.int32), "doc_id": pa.array(ids[found], mask=ids[found] == _LAST_ID),
                   "longest_repeat": np.full(len(found), length, np.int64)})
    mark = np.zeros(int(hi[-1]) + 2 * length + 1, bool)
    mark[at[anywhere]] = True
    nxt = at[anywhere]
    nxt = nxt[mark[nxt + length]]
    row = np.searchsorted(lo, nxt, side="right") - 1
    nxt = nxt[nxt + 2 * length <= hi[row]]
    if not len(nxt):
        return out
    where = np.searchsorted(at, np.concatenate((nxt, nxt + length)))
    joined = W.mix(h[where[:len(nxt)]] * np.uint64(W._BASE) + h[where[len(nxt):]])
    rows = np.unique(np.searchsorted(lo, nxt, side="right") - 1)
    head = np.array([len(nxt), len(rows)], np.int64)
    raw = b"".join((head.tobytes(), ids[rows].tobytes(), lo[rows].tobytes(), hi[rows].tobytes(), joined.tobytes(), _pack(nxt.astype(np.uint64))))
    return pa.concat_tables([out, _result({"chunk": [chunk], "state": [raw]})])


_HEAD = 7


def _head(text: str) -> Column:
    """The first bytes of a text as a number that sorts as the text does."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(F.substring(text, 1, _HEAD), "UTF-8"), 1, _HEAD)), 2 * _HEAD, "0"), 16, 10).cast("long")


def _bounds(rows: DataFrame, chunks: int) -> list[tuple[int, np.ndarray]]:
    """Ends of the chunks: (id, starts of texts) in order. A chunk ends with an
    id; one that fills several chunks by itself (all rows without an id count as
    one) is cut by how its texts start."""
    if chunks <= 1:
        return []
    cuts = [i / chunks for i in range(1, chunks)]
    edges = rows.agg(F.percentile_approx("order_id", cuts, max(10_000, 20 * chunks)).alias("e")).first()["e"]
    ids, times = np.unique(np.array(edges, np.int64), return_counts=True)
    heavy = {int(i): int(n) for i, n in zip(ids, times) if n > 1}
    heads: dict[int, np.ndarray] = {}
    if heavy:  # as many ids as there are chunks at most
        pieces = rows.where(F.col("order_id").isin(list(heavy))).select("order_id", _head("text").alias("head")).groupBy("order_id").agg(
            F.percentile_approx("head", [i / 64 for i in range(1, 64)], 10_000).alias("h"))
        heads = {r["order_id"]: np.unique(np.array(r["h"], np.int64)) for r in pieces.collect()}
    none = np.zeros(0, np.int64)
    out = []
    for i in ids.tolist():
        if i in heavy:
            if not out or out[-1][0] != i - 1:
                out.append((i - 1, none))
            out.append((i, heads[i][np.unique(np.linspace(0, len(heads[i]) - 1, min(heavy[i], len(heads[i]))).round().astype(int))]))
        else:
            out.append((i, none))
    return out


def _chunk_numbers(bounds: list[tuple[int, np.ndarray]], ids: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Chunk of each row: growing with (id, text)."""
    ends = np.array([i for i, _ in bounds], np.int64)
    first = np.concatenate(([0], np.cumsum([1 + len(h) for _, h in bounds]))).astype(np.int64)
    at = np.searchsorted(ends, ids, side="left")
    out = first[at]
    for b, (i, starts) in enumerate(bounds):
        if len(starts):
            mine = ids == i
            out[mine] = first[b] + np.searchsorted(starts, heads[mine], side="right")
    return out.astype(np.int32)


def substring_dedup(docs: DataFrame, min_words: int = 20, chunk_bytes: int = 8 << 20, range_hashes: int = 2 << 20,
                    with_text: bool = False) -> DataFrame:
    """Remove every word covered by a window of ``min_words`` words whose word
    sequence also starts earlier.

    Returns one row per document: doc_id, n_words, n_removed, kept_sha256,
    longest_repeat (words of the longest level at which it repeats an earlier
    passage; all its words for an exact copy; 0: none) and, with ``with_text``,
    kept_text. ``chunk_bytes`` and ``range_hashes`` size the tasks; the number
    of chunks and hash ranges follows the input.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("order_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    stat = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n, total = stat["n"], stat["bytes"] or 0
    parts = partitions(spark)
    chunks = max(1, min(n, max(parts, total // chunk_bytes)))
    estimate = max(1, total // 5)  # windows; only sizes depend on it
    buckets = max(1, min(max(parts, estimate // range_hashes), estimate))
    bits = min(64, math.ceil(math.log2(estimate + 1)) + 12)
    bounds = _bounds(rows, chunks)

    @F.pandas_udf("int")
    def chunk_of(ids: pd.Series, heads: pd.Series) -> pd.Series:
        return pd.Series(_chunk_numbers(bounds, ids.to_numpy(), heads.to_numpy()))

    half = (min_words + 1) // 2
    dealt = rows.withColumn("chunk", chunk_of("order_id", _head("text")))
    by_chunk = dealt.groupBy("chunk")
    resolve = {e: partial(_resolve, exact=e) for e in (False, True)}
    sent = by_chunk.applyInArrow(_takes_table(partial(_base, width=half, bits=bits, buckets=buckets)), _MESSAGE)
    known = sent.groupBy("bucket").applyInArrow(_takes_table(resolve[False]), _MESSAGE)
    level = partial(_level, width=half, bits=bits, target=min_words, buckets=buckets)
    sent = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(_takes_pair(level), _MESSAGE)
    known = sent.groupBy("bucket").applyInArrow(_takes_table(resolve[True]), _MESSAGE)
    end = partial(_finish, target=min_words, with_text=with_text)
    found = stored(by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(_takes_pair(end), _RESULT), "substring")
    levels = [found.where("state is null").select("doc_id", "longest_repeat")]
    states, length = found.where("state is not null").select("chunk", "state"), 2 * min_words
    while not states.isEmpty():
        sent = states.groupBy("chunk").applyInArrow(_takes_table(partial(_send, buckets=buckets)), _MESSAGE)
        known = sent.groupBy("bucket").applyInArrow(_takes_table(resolve[True]), _MESSAGE)
        step = stored(states.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
            _takes_pair(partial(_double, length=length)), _RESULT), "substring-level")
        levels.append(step.where("state is null").select("doc_id", "longest_repeat"))
        states, length = step.where("state is not null").select("chunk", "state"), 2 * length
    out = found.where("state is null").drop("chunk", "state", *([] if with_text else ["kept_text"]))
    if len(levels) == 1:
        return out
    longer = levels[1]
    for x in levels[2:]:
        longer = longer.unionByName(x)
    longer = longer.groupBy(F.col("doc_id").alias("long_id")).agg(F.max("longest_repeat").alias("longer"))
    return out.join(longer, F.col("doc_id").eqNullSafe(F.col("long_id")), "left").withColumn(
        "longest_repeat", F.greatest("longest_repeat", F.coalesce("longer", F.lit(0)))).drop("long_id", "longer")


def _takes_table(fn):
    def grouped(tbl: pa.Table) -> pa.Table:
        return fn(tbl)
    return grouped


def _takes_pair(fn):
    def grouped(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(key, left, right)
    return grouped
