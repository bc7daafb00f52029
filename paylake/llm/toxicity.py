"""Toxicity by a counterfactual-regularised classifier.

A logistic model over the words of a document, fitted on a bounded sample of
labelled rows. For every sampled text that mentions an identity group, the text
is taken again with each such term swapped for another of its kind, and the
fit penalises the squared change of the score between the two. So a neutral
mention of a group cannot carry weight of its own, even where the labels
happen to go with it.

Words are hashed 64-bit and kept only if they tell the labels apart in the
sample; the identity terms are always kept, else there was nothing to
penalise. Every document is scored on its whole text in one pass without a
shuffle: the model (some thousand numbers, bounded by ``max_words``) is sent to
the tasks.

Edge cases: null or empty text gets the score of a text without known words;
no labels, or one class only, give the smoothed share of toxic rows as the
score of every document; a document labelled several times is toxic if any
label says so, null labels say nothing; rows without doc_id are scored and are
not held out; repeated rows are scored each; extra columns are ignored (and
kept by ``drop_toxic``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm import words as W
from paylake.llm.common import ship, stored

_SLICE = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BETWEEN = np.ones(256, bool)  # a word: letters, digits and all bytes beyond ASCII
_BETWEEN[0x30:0x3A] = _BETWEEN[0x41:0x5B] = _BETWEEN[0x61:0x7B] = _BETWEEN[0x80:] = False

#: Terms that name a group of people; a term is swapped for others of its line.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("american", "mexican", "chinese", "indian", "arab", "german", "french", "spanish", "russian", "polish"),
    ("immigrant", "refugee", "native"), ("immigrants", "refugees", "natives"), ("deaf", "blind", "disabled", "autistic"), ("old", "young", "elderly"),
)


def _term_hashes(terms) -> np.ndarray:
    data, offs = W.buffer_of(pa.array([t.lower() for t in terms]))
    return W.span_hashes(data, offs[:-1], offs[1:])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of the texts, in lower case."""
    data, offs = W.buffer_of(texts)
    data = _LOWER[data]
    starts, ends, counts = W.word_spans(data, offs, _BETWEEN)
    return W.span_hashes(data, starts, ends), np.repeat(np.arange(len(counts)), counts)


@dataclass(frozen=True)
class Swaps:
    """Which identity term may stand for which."""

    terms: np.ndarray  # sorted hashes
    group: np.ndarray
    place: np.ndarray
    by_group: tuple  # hashes of each group, in order

    @staticmethod
    def of(groups) -> Swaps:
        hashes = [_term_hashes(g) for g in groups]
        rows = sorted((int(h), g, i) for g, hs in enumerate(hashes) for i, h in enumerate(hs))
        return Swaps(np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), tuple(hashes))

    def swap(self, h: np.ndarray, row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words with every identity term replaced by another one of its kind
        (which one depends on the row's key), and the places of those terms."""
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == h) if len(self.terms) else np.zeros(0, np.int64)
        out = h.copy()
        for i in hit.tolist():
            options = self.by_group[self.group[at[i]]]
            step = 1 + int(key[row[i]]) % (len(options) - 1) if len(options) > 1 else 0
            out[i] = options[(self.place[at[i]] + step) % len(options)]
        return out, hit


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def features(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, word number) of the known words."""
        if not len(self.words) or not len(h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.zeros(1 << 16, bool)
        maybe[(self.words & np.uint64(0xFFFF)).astype(np.int64)] = True
        some = maybe[(h & np.uint64(0xFFFF)).astype(np.int64)]
        h, row = h[some], row[some]
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        hit = self.words[at] == h
        pair = np.unique(row[hit].astype(np.int64) * len(self.words) + at[hit])
        return pair // len(self.words), pair % len(self.words)

    def scores(self, texts: pa.Array) -> np.ndarray:
        h, row = word_hashes(texts)
        r, w = self.features(h, row)
        z = np.bincount(r, self.weights[w], minlength=len(texts)) if len(r) else np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(z + self.bias, -30, 30)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], words: np.ndarray, counterfactual: float = 10.0, ridge: float = 3e-5,
        rounds: int = 800) -> Model:
    """Logistic regression with the counterfactual penalty, by gradient steps.

    ``rows``: (label, word numbers, word numbers after the swap) per document.
    """
    y = np.array([r[0] for r in rows], float)
    prior = (y.sum() + 0.5) / (len(y) + 2)
    model = Model(words, np.zeros(len(words)), float(np.log(prior / (1 - prior))))
    if not len(words) or not 0 < y.sum() < len(y):
        return model
    n = len(y)
    size = np.array([len(r[1]) for r in rows])
    r, c = np.repeat(np.arange(n), size), np.concatenate([x[1] for x in rows]).astype(np.int64)
    # the change of the features by the swap: +1 for words it brings, -1 for words it takes
    swapped = [(i, np.setdiff1d(x[2], x[1]), np.setdiff1d(x[1], x[2])) for i, x in enumerate(rows)]
    swapped = [s for s in swapped if len(s[1]) or len(s[2])]
    dr = np.concatenate([np.full(len(a) + len(b), k) for k, (_, a, b) in enumerate(swapped)] or [np.zeros(0)]).astype(np.int64)
    dc = np.concatenate([np.concatenate((a, b)) for _, a, b in swapped] or [np.zeros(0)]).astype(np.int64)
    ds = np.concatenate([np.concatenate((np.ones(len(a)), -np.ones(len(b)))) for _, a, b in swapped] or [np.zeros(0)])
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) ** 0.5  # halfway to balanced classes
    w, b = np.zeros(len(words)), model.bias
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(r, w[c], minlength=n) + b, -30, 30)))
        err = share * (p - y) / n
        grad = np.bincount(c, err[r], minlength=len(w)) + ridge * w
        if len(dr):
            change = np.bincount(dr, ds * w[dc], minlength=len(swapped))
            grad += counterfactual * np.bincount(dc, ds * change[dr], minlength=len(w)) / len(swapped)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * err.sum(), 0.999 * vb + 0.001 * err.sum() ** 2
        fix1, fix2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w = w - 0.05 * (m / fix1) / (np.sqrt(v / fix2) + 1e-8)
        b -= 0.05 * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-8)
    return Model(words, w, float(b))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, max_words: int = 4096, min_rows: int = 4, min_gap: float = 10.0,
          groups=IDENTITY_GROUPS, **options) -> Model:
    """Fit on at most ``sample_rows`` labelled documents that are not held
    out, the first by a hash of their ids."""
    spark = docs.sparkSession
    ship(spark)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sample = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows), "toxic-sample")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])  # sample_rows bounds the broadcast
    texts = stored(rows.select("doc_id", "toxic", "text"), "toxic-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", 4 * _SLICE):
                h, row = word_hashes(part.column("text"))
                toxic = part.column("toxic").to_numpy()
                order = np.lexsort((row, h))
                h, row = h[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                h, y = h[new], toxic[row[new]]
                if not len(h):
                    continue
                at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(np.add.reduceat(np.ones(len(h), np.int64), at)),
                                                  pa.array(np.add.reduceat(y.astype(np.int64), at))], names=["word", "n", "n1"])

    total = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("n1")).first()
    n, n1 = total["n"], total["n1"]
    stats = texts.select("text", "toxic").mapInArrow(count, "word long, n long, n1 long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    expected = F.col("n") * F.lit(n1 / max(n, 1))
    gap = (F.col("n1") - expected) ** 2 / (expected + 0.5)
    chosen = stats.where((F.col("n") >= min_rows) & (gap >= min_gap)).orderBy(gap.desc(), "word").limit(max_words).select("word").collect()
    swaps = Swaps.of(groups)
    vocabulary = np.unique(np.concatenate((np.array([r["word"] for r in chosen], np.int64).view(np.uint64), swaps.terms)))
    bare = Model(vocabulary, np.zeros(len(vocabulary)), 0.0)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", _SLICE):
                h, row = word_hashes(part.column("text"))
                other, _ = swaps.swap(h, row, part.column("doc_id").to_numpy())
                cols = []
                for x in (h, other):
                    r, w = bare.features(x, row)
                    offs = np.searchsorted(r, np.arange(len(part) + 1)).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(offs), pa.array(w.astype(np.int32))))
                yield pa.RecordBatch.from_arrays([part.column("toxic"), *cols], names=["toxic", "own", "swapped"])

    found = texts.mapInArrow(featurise, "toxic int, own array<int>, swapped array<int>").toArrow()  # sample_rows bounds it
    data = [(y, np.array(a, np.int64), np.array(b, np.int64)) for y, a, b in zip(*(found.column(c).to_pylist() for c in ("toxic", "own", "swapped")))]
    return fit(data, vocabulary, **options)


def with_scores(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """``docs`` with its columns and the score of the whole ``text``."""
    ship(docs.sparkSession)
    docs = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", _SLICE):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(part.column("text")))], names=[*part.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, **options)
    scored = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` with its columns, without the documents predicted toxic."""
    score = "toxicity"
    while score.lower() in {c.lower() for c in docs.columns}:
        score += "_"
    return with_scores(docs, train(docs, labels, **options), score).where(F.col(score) < 0.5).drop(score)
