"""Byte-level BPE, encoded and decoded by SQL inside each partition.

A partition's distinct words (matches of the splitting pattern) become rows
(word, position, token) of an in-process DuckDB. A recursive query joins
neighbouring rows with the merge table and contracts each word's leftmost pair
of least rank until no pair merges; decoding looks runs of ids up in the
vocabulary and aggregates their bytes in order of position. Words seen lately in
the same Python worker are not encoded again.

The recursion starts with pairs of bytes contracted that merge in any case:
where no token of the same or a lower rank holds the two bytes that meet at an
edge of the pair, neither of its bytes can go to another token first, nor can
the pair's token be in a merge of lower rank.

A word of over 512 bytes is contracted by the same step in a loop, one table
after the other, with all occurrences of its least pair in one round where that
provably equals one at a time: a token that is part of no merge of lower rank
cannot bring one forth.

Edge cases: null or empty text has no ids and decodes to the empty string;
text of any length is encoded whole; repeated rows and extra columns are kept
as they are. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm import words as W
from paylake.llm.common import ship
from paylake.llm.segments import Recent, distinct_pieces

_SLICE = 1 << 21
_SHARE = 1 << 19
#: A word keeps a row per token and step, so up to half its length squared.
_SHARE_SQUARES = 1 << 23
_LONG = 512
_RUN = 64
_KEEP_PIECES = 250_000
_MEMORY = "256MB"

# One row (word, step, pos, id) per token, pos counting all bytes of the batch.
# A round finds each word's leftmost pair of least rank (the smallest of rank,
# pos) and contracts it. Words without a pair are not carried on, so the rows
# of a word's last step are its tokens.
_ENCODE = """
WITH RECURSIVE state(word, step, pos, id) AS (
  SELECT word, 0, pos, id FROM bytes
  UNION ALL
  (
    WITH pairs AS MATERIALIZED (
      SELECT word, step, pos, id, lag(pos) OVER w AS before, lead(id) OVER w AS next_id, lead(word) OVER w AS next_word
      FROM state WINDOW w AS (ORDER BY pos)
    ), best AS MATERIALIZED (
      SELECT p.word, min(m.id * 4294967296 + p.pos) AS pair
      FROM pairs p JOIN merges m ON m.both = p.id::BIGINT * 65536 + p.next_id
      WHERE p.word = p.next_word GROUP BY p.word
    )
    SELECT p.word, step + 1, pos, CASE WHEN pos = pair % 4294967296 THEN (pair // 4294967296)::INT ELSE id END
    FROM pairs p JOIN best b ON p.word = b.word
    WHERE before IS DISTINCT FROM pair % 4294967296
  )
)
SELECT word, pos, id FROM state JOIN (SELECT word, max(step) AS step FROM state GROUP BY word) USING (word, step) ORDER BY pos
"""

# One round over a single very long word, whose states would not fit side by
# side: every occurrence of the least pair at once (the first only, where its
# token could take part in a merge of lower rank).
_ENCODE_LONG = """
CREATE OR REPLACE TABLE after AS
WITH pairs AS (
  SELECT t.pos, t.id, m.id AS merged, m.alone
  FROM (SELECT pos, id, lead(id) OVER (ORDER BY pos) AS next_id FROM before) t
  LEFT JOIN merges m ON m.both = t.id::BIGINT * 65536 + t.next_id
), hits AS (
  SELECT *, coalesce(merged = (SELECT min(merged) FROM pairs), false) AS hit FROM pairs
), islands AS (
  SELECT *, sum((NOT hit)::INT) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS island, sum(hit::INT) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS nth
  FROM hits
), chosen AS (
  SELECT *, hit AND CASE WHEN alone THEN nth = 1 ELSE row_number() OVER (PARTITION BY island, hit ORDER BY pos) % 2 = 1 END AS take
  FROM islands
), marked AS (
  SELECT *, lag(take, 1, false) OVER (ORDER BY pos) AS gone FROM chosen
)
SELECT pos, CASE WHEN take THEN merged ELSE id END AS id FROM marked WHERE NOT gone
"""

# Runs of ids are looked up in the vocabulary as a list (id 0 is its first
# element; numbers beyond it have no bytes).
_DECODE = """
SELECT doc, string_agg(array_to_string(list_select(v.tokens, run), ''), '' ORDER BY pos) AS decoded
FROM runs, vocabulary v GROUP BY doc
"""
_NEVER = np.iinfo(np.int32).max


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """A rank file: one line per token, base64 bytes and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


class Codec:
    """A vocabulary loaded into an in-process DuckDB of one Python worker."""

    def __init__(self, raw: bytes, pattern: str):
        ranks = read_ranks(raw)
        self.pattern = regex.compile(pattern)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        a, b, m = (np.array(x, np.int32) for x in (left, right, merged))
        lowest = np.full(max(ranks.values()) + 1, _NEVER, np.int32)
        np.minimum.at(lowest, a, m)
        np.minimum.at(lowest, b, m)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": _MEMORY, "temp_directory": ""})
        self.db.register("m", pa.table({"a": a, "b": b, "id": m, "alone": lowest[m] <= m}))
        self.db.execute("CREATE TABLE merges AS SELECT a::BIGINT * 65536 + b AS both, id, alone FROM m")
        self.db.unregister("m")
        tokens = [None] * (max(ranks.values()) + 1)
        # per pair of bytes: its token, and the least of all tokens that hold the pair
        self.pair_id, self.pair_least = (np.full(1 << 16, _NEVER, np.int32) for _ in range(2))
        for token, rank in ranks.items():
            tokens[rank] = token.decode("latin-1")
            if len(token) == 2:
                self.pair_id[token[0] << 8 | token[1]] = rank
        raw, sizes = np.frombuffer(b"".join(ranks), np.uint8), np.array([len(t) for t in ranks], np.int64)
        token = np.repeat(np.arange(len(sizes)), sizes)
        pair, inside = self._pairs(raw, token)
        np.minimum.at(self.pair_least, pair[inside], np.array(list(ranks.values()), np.int32)[token[:-1][inside]])
        self.db.register("v", pa.table({"tokens": pa.array([tokens], pa.list_(pa.string()))}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM v")
        self.db.unregister("v")
        self.names = pa.array([b"%d" % i for i in range(len(tokens))])
        self.known = Recent(_KEEP_PIECES)  # piece -> (ids as 32-bit integers, ids as decimal text)

    @staticmethod
    def _pairs(raw: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every two neighbouring bytes as a number, and whether one word has both."""
        return raw[:-1].astype(np.int32) << 8 | raw[1:], word[:-1] == word[1:]

    def _start(self, raw: np.ndarray, word: np.ndarray) -> pa.Table:
        """The words' bytes as tokens, with the pairs contracted that merge in any case."""
        pair, inside = self._pairs(raw, word)
        merged, least = (np.append(np.where(inside, x[pair], _NEVER), _NEVER) for x in (self.pair_id, self.pair_least))
        sure = merged < _NEVER
        sure[1:] &= merged[1:] < least[:-1]
        sure[:-1] &= merged[:-1] < least[1:]
        pos = np.flatnonzero(np.append(True, ~sure[:-1]))  # two such pairs never share a byte
        return pa.table({"word": word[pos], "pos": pos, "id": np.where(sure, merged, self.byte_id[raw])[pos].astype(np.int32)})

    def _encode_words(self, words: list[bytes]) -> dict[bytes, tuple[bytes, bytes]]:
        """Ids of distinct words by the recursive query, a share at a time: as
        32-bit integers and as decimal text."""
        found = {w: self._encode_long(w) for w in words if len(w) > _LONG}
        words = [w for w in words if len(w) <= _LONG]
        lengths = np.array([len(x) for x in words], np.int64)
        at, squares = (np.concatenate(([0], np.cumsum(x))) for x in (lengths, lengths * lengths))
        lo = 0
        while lo < len(words):
            hi = min(int(np.searchsorted(at, at[lo] + _SHARE, side="right")), int(np.searchsorted(squares, squares[lo] + _SHARE_SQUARES, side="right"))) - 1
            hi = max(lo + 1, hi)
            raw = np.frombuffer(b"".join(words[lo:hi]), np.uint8)
            self.db.register("bytes", self._start(raw, np.repeat(np.arange(hi - lo, dtype=np.int32), lengths[lo:hi])))
            rows = self.db.execute(_ENCODE).fetchnumpy()
            self.db.unregister("bytes")
            found.update(zip(words[lo:hi], self._shown(rows["id"], np.searchsorted(rows["word"], np.arange(hi - lo + 1)))))
            lo = hi
        return found

    def _shown(self, ids: np.ndarray, cut: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
        raw, at = ids.astype(np.int32).tobytes(), (4 * cut).tolist()
        shown = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cut, pa.int64()), self.names.take(pa.array(ids))), b" ")
        return zip((raw[a:b] for a, b in zip(at, at[1:])), shown.to_pylist())

    def _encode_long(self, word: bytes) -> tuple[bytes, bytes]:
        raw = np.frombuffer(word, np.uint8)
        start = self._start(raw, np.zeros(len(raw), np.int32))
        self.db.register("bytes", start)
        self.db.execute("CREATE OR REPLACE TABLE before AS SELECT pos, id FROM bytes")
        self.db.unregister("bytes")
        n = len(start)
        while True:
            self.db.execute(_ENCODE_LONG)
            left = self.db.execute("SELECT count(*) FROM after").fetchone()[0]
            if left == n:
                ids = self.db.execute("SELECT id FROM after ORDER BY pos").fetchnumpy()["id"]
                return next(self._shown(ids, np.array([0, n])))
            n = left
            self.db.execute("DROP TABLE before")
            self.db.execute("ALTER TABLE after RENAME TO before")

    def _learn(self, pieces: list[bytes]) -> None:
        # an optional space and ASCII letters are one match of the pattern
        whole = [p for p in pieces if p[p[:1] == b" ":].isalpha()]
        cut = {p: [w.encode() for w in self.pattern.findall(p.decode())] for p in pieces if not p[p[:1] == b" ":].isalpha()}
        ids = self._encode_words(list({*whole, *(w for ws in cut.values() for w in ws)}))
        self.known.new.update((p, ids[p]) for p in whole)
        for piece, ws in cut.items():
            parts = [ids[w] for w in ws]
            self.known.new[piece] = (b"".join([x[0] for x in parts]), b" ".join([x[1] for x in parts]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(all ids, ids per row, per row its ids as text)."""
        pieces, order, per_row = distinct_pieces(texts)
        fresh = self.known.missing(pieces)
        if fresh:
            self._learn(fresh)
        found = self.known.values(pieces)
        tokens = [x[0] for x in found]
        sizes = np.array([len(x) // 4 for x in tokens], np.int64)
        flat = np.frombuffer(b"".join(tokens), np.int32)
        first = np.concatenate(([0], np.cumsum(sizes)))
        each = sizes[order]
        ids = flat[W.ragged(first[order], each)] if len(order) else flat
        ends = np.cumsum(per_row)
        counts = np.diff(np.concatenate(([0], np.cumsum(each)))[np.concatenate(([0], ends))])
        shown = np.array([*(x[1] for x in found), b""], object)[order].tolist()
        lines = [b" ".join(shown[a:b]) for a, b in zip((ends - per_row).tolist(), ends.tolist())]
        return ids, counts, lines

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        out = [b""] * len(counts)
        lo = 0
        ends = np.cumsum(counts)
        places = np.where((ids >= 0) & (ids < len(self.names)), ids + 1, 0).astype(np.int32)
        while lo < len(counts):  # some rows at a time, one at least
            base = ends[lo] - counts[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, base + (1 << 18), side="right")))
            part = places[base:ends[hi - 1]]
            cut = np.unique(np.concatenate((np.arange(0, len(part), _RUN), ends[lo:hi] - base)))
            if len(part):
                runs = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(part))
                self.db.register("runs", pa.table({"doc": lo + np.searchsorted(ends[lo:hi] - base, cut[:-1], side="right"), "pos": cut[:-1], "run": runs}))
                for doc, text in self.db.execute(_DECODE).fetchall():
                    out[doc] = text.encode("latin-1")
                self.db.unregister("runs")
            lo = hi
        return out


_CODECS: dict[tuple[bytes, str], Codec] = {}


def codec(raw: bytes, pattern: str) -> Codec:
    """The worker's codec; built once per vocabulary and Python worker."""
    key = (hashlib.sha256(raw).digest(), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(raw, pattern)
    return _CODECS[key]


def _map(docs: DataFrame, path: str, pattern: str, fields: list[T.StructField], fn) -> DataFrame:
    ship(docs.sparkSession)
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary: its size doesn't follow the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value, pattern)
        for batch in batches:
            for part in W.slices(batch, batch.schema.names[-1], _SLICE):
                names = [*part.schema.names[:-1], *(f.name for f in fields)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *fn(c, part.column(part.num_columns - 1))], names=names)

    kept = docs.schema.fields[:-1]
    return docs.mapInArrow(run, T.StructType([*kept, *fields]))


def bpe_encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the token ids of ``text``."""
    def fn(c: Codec, texts):
        ids, counts, _ = c.encode(texts)
        offs = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offs), pa.array(ids))]

    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return _map(docs, path, pattern, [T.StructField("ids", T.ArrayType(T.IntegerType()))], fn)


def bpe_round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: every text encoded,
    its ids decoded again; the ids themselves stay in their task."""
    def fn(c: Codec, texts):
        ids, counts, lines = c.encode(texts)
        decoded = c.decode(ids, counts)
        return [pa.array(counts), pa.array([hashlib.sha256(x).hexdigest() for x in lines]),
                pa.array([hashlib.sha256(x).hexdigest() for x in decoded])]

    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return _map(docs, path, pattern, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                                      T.StructField("decoded_sha256", T.StringType())], fn)


def bpe_decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of ``ids`` (null: none)."""
    ship(tokens.sparkSession)
    with open(path, "rb") as f:
        shared = tokens.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value, pattern)
        for batch in batches:
            col = batch.column(1)
            counts = np.array([len(x) if x is not None else 0 for x in col.to_pylist()], np.int64)
            flat = col.flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(c.decode(flat, counts), pa.binary())], names=["doc_id", "decoded"])

    return tokens.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        run, T.StructType([tokens.schema["doc_id"], T.StructField("decoded", T.BinaryType())]))
