"""Language identification by hierarchical discrimination.

First the language family of a text is predicted, then linear support vector
machines, one per pair of languages, tell the languages of that family apart;
the language that wins most duels is predicted (ties by the sum of margins).
Families are predicted by the same kind of duels between families.

Features are the shares of hashed byte sequences (three and five bytes long)
among all of a text, in lower case, with digits, signs and white space as one
kind of blank. The machines are fitted on at most ``max_rows`` labelled rows,
the same number at most of each language, first by a hash of id and text; the
squared hinge loss is minimised in numpy on the driver, on a matrix that this
bound limits. Every text is scored whole, in one pass without a shuffle; the
machines (``buckets`` numbers each) are sent to the tasks.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; no
rows to learn from give ``und`` for every text; with one language only every
text with a letter is of that language, with score 1; a language outside the
table of families is a family of its own; rows without doc_id are predicted,
not learned from, and not held out; repeated rows are predicted each and
learned from once; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm import words as W
from paylake.llm.common import ship, stored

_SLICE = 1 << 20
#: Language codes by family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "celtic": ("ga", "cy", "gd", "br"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk", "tt"),
    "indo-iranian": ("hi", "ur", "bn", "pa", "mr", "gu", "ne", "si", "fa", "ku", "ps", "tg"),
    "semitic": ("ar", "he", "mt", "am"),
    "austronesian": ("id", "ms", "tl", "jv", "mg"),
    "dravidian": ("ta", "te", "kn", "ml"),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_SPLIT = np.uint64(0x9E3779B97F4A7C15)


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], "=" + lang)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sequences(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of the three- and five-byte sequences of lower-case texts."""
    data, offs = W.buffer_of(texts)
    lengths = np.diff(offs)
    signs = np.where(_LETTER[data], data, 0x20).astype(np.uint64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    found, rows = [], []
    for width in (3, 5):
        if len(signs) < width:
            continue
        last = len(signs) - width + 1
        key = signs[:last].copy()
        for i in range(1, width):
            key = key * np.uint64(257) + signs[i:i + last]
        whole = (row[:last] == row[width - 1:]) & ~((signs[:last] == 0x20) & (signs[1:last + 1] == 0x20))  # inside one text, blanks once
        hashed = (key[whole] + np.uint64(width)) * _SPLIT >> np.uint64(40)
        found.append((hashed % np.uint64(buckets)).astype(np.int64))
        rows.append(row[:last][whole])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(rows)


@dataclass(frozen=True)
class Duels:
    """Linear machines for all pairs of some names."""

    names: tuple[str, ...]
    weights: np.ndarray  # (pairs, buckets)
    bias: np.ndarray
    slope: np.ndarray  # of the logistic curve that turns margins into probabilities

    @property
    def pairs(self):
        return list(combinations(range(len(self.names)), 2))

    def decide(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(winner, mean probability in its duels) from (rows, pairs) margins."""
        n = len(margins)
        wins, total, odds = (np.zeros((n, len(self.names))) for _ in range(3))
        for p, (a, b) in enumerate(self.pairs):
            m = margins[:, p]
            chance = 1 / (1 + np.exp(-np.clip(m * self.slope[p], -30, 30)))
            wins[:, a] += m >= 0
            wins[:, b] += m < 0
            total[:, a] += m
            total[:, b] -= m
            odds[:, a] += chance
            odds[:, b] += 1 - chance
        best = np.lexsort((total, wins), axis=1)[:, -1] if len(self.names) > 1 else np.zeros(n, np.int64)
        duels = max(len(self.names) - 1, 1)
        score = odds[np.arange(n), best] / duels if len(self.names) > 1 else np.ones(n)
        return best, score


@dataclass(frozen=True)
class Hierarchy:
    families: Duels
    languages: tuple[Duels, ...]  # of each family, in order
    buckets: int

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each lower-case text."""
        bucket, row = sequences(texts, self.buckets)
        n = len(texts)
        count = np.maximum(np.bincount(row, minlength=n), 1)

        def margins(duels: Duels) -> np.ndarray:
            if not len(duels.bias):
                return np.zeros((n, 0))
            return np.stack([np.bincount(row, w[bucket], minlength=n) / count + b for w, b in zip(duels.weights, duels.bias)], axis=1)

        family, sure = self.families.decide(margins(self.families))
        names, scores = np.empty(n, object), np.zeros(n)
        for f, duels in enumerate(self.languages):
            mine = family == f
            if mine.any():
                best, odds = duels.decide(margins(duels)[mine])
                names[mine] = np.array(duels.names, object)[best]
                scores[mine] = sure[mine] * odds
        return names.tolist(), scores


def _machine(row: np.ndarray, bucket: np.ndarray, share: np.ndarray, y: np.ndarray, buckets: int, ridge: float, rounds: int) -> tuple[np.ndarray, float, float]:
    """A linear support vector machine (squared hinge, classes weighed alike)
    by gradient steps: weights, bias and the slope of its margins."""
    weigh = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9)) / len(y)
    w, b = np.zeros(buckets), 0.0
    m, v, mb, vb = np.zeros(buckets), np.zeros(buckets), 0.0, 0.0
    for t in range(1, rounds + 1):
        lack = np.maximum(0, 1 - y * (np.bincount(row, share * w[bucket], minlength=len(y)) + b))
        pull = -2 * weigh * y * lack
        grad, grad_b = np.bincount(bucket, share * pull[row], minlength=buckets) + ridge * w, pull.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * grad_b, 0.999 * vb + 0.001 * grad_b * grad_b
        step = 0.5 / np.sqrt(t)
        w = w - step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-10)
        b -= 0.1 * step * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-10)
    return w, b, 3.0  # a margin of 1 means odds of 20 to 1


def _duels(names: list[str], label: np.ndarray, row: np.ndarray, bucket: np.ndarray, share: np.ndarray, buckets: int, ridge: float, rounds: int) -> Duels:
    found = []
    for a, b in combinations(range(len(names)), 2):
        some = (label == a) | (label == b)
        number = np.cumsum(some) - 1
        inside = some[row]
        found.append(_machine(number[row[inside]], bucket[inside], share[inside], np.where(label[some] == a, 1.0, -1.0), buckets, ridge, rounds))
    return Duels(tuple(names), np.array([f[0] for f in found]).reshape(len(found), buckets), np.array([f[1] for f in found]), np.array([f[2] for f in found]))


def train(docs: DataFrame, max_rows: int = 2000, buckets: int = 1 << 13, ridge: float = 1e-6, rounds: int = 200) -> Hierarchy | None:
    """Fit on at most ``max_rows`` labelled rows that are not held out; None without any."""
    ship(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    languages = rows.select("lang").distinct().count()
    if not languages:
        return None
    each = max(1, max_rows // languages)
    keys = rows.select("lang", "doc_id", F.xxhash64("doc_id", "text").alias("mix")).distinct()
    # of a language with more than twice its share only hashes that low come into the ranking
    limit = -(1 << 63) + F.lit(2.0 * each) / F.col("of_lang") * F.lit(float(1 << 64))
    sizes = keys.groupBy("lang").agg(F.count("*").alias("of_lang"))
    keys = keys.join(sizes, "lang").where((F.col("of_lang") <= 2 * each) | (F.col("mix") < limit))
    first = Window.partitionBy("lang").orderBy("mix", "doc_id")
    chosen = keys.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= each).select("lang", "doc_id", "mix")
    chosen = stored(chosen.limit(max_rows) if languages > max_rows else chosen, "language-sample")
    rows = rows.withColumn("mix", F.xxhash64("doc_id", "text"))
    texts = rows.join(F.broadcast(chosen), ["lang", "doc_id", "mix"]).dropDuplicates(["lang", "doc_id", "mix"])  # max_rows bounds the broadcast

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", _SLICE):
                bucket, row = sequences(part.column("text"), buckets)
                pair, times = np.unique(row * buckets + bucket, return_counts=True)
                total = np.maximum(np.bincount(pair // buckets, times, minlength=len(part)), 1)
                offs = pa.array(np.searchsorted(pair, np.arange(len(part) + 1) * buckets).astype(np.int32))
                share = (times / total[pair // buckets]).astype(np.float32)
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.ListArray.from_arrays(offs, pa.array((pair % buckets).astype(np.int32))),
                                                  pa.ListArray.from_arrays(offs, pa.array(share))], names=["lang", "bucket", "share"])

    found = texts.select("lang", F.lower("text").alias("text")).mapInArrow(featurise, "lang string, bucket array<int>, share array<float>").toArrow()
    bucket = found.column("bucket").combine_chunks()
    row = np.repeat(np.arange(len(bucket)), np.diff(bucket.offsets.to_numpy()))
    share = found.column("share").combine_chunks().flatten().to_numpy().astype(float)
    bucket = bucket.flatten().to_numpy().astype(np.int64)
    langs = found.column("lang").to_pylist()
    names = sorted(set(langs))
    families = sorted({family_of(n) for n in names})
    own = np.array([families.index(family_of(n)) for n in langs])
    options = {"buckets": buckets, "ridge": ridge, "rounds": rounds}
    top = _duels(families, own, row, bucket, share, **options)
    inner = []
    for f, family in enumerate(families):
        members = [n for n in names if family_of(n) == family]
        some = own == f
        number, inside = np.cumsum(some) - 1, some[row]
        label = np.array([members.index(n) for n, s in zip(langs, some) if s])
        inner.append(_duels(members, label, number[row[inside]], bucket[inside], share[inside], **options))
    return Hierarchy(top, tuple(inner), buckets)


def with_language(docs: DataFrame, model: Hierarchy | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row's whole text."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lower("text").alias("text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text", _SLICE):
                names, scores = sent.value.predict(part.column("text"))
                letters = part.column("letters").to_numpy(zero_copy_only=False)
                names = pa.array([n if has else "und" for n, has in zip(names, letters)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), names, pa.array(np.where(letters, scores, 0.0))],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    return with_language(docs, train(docs, **options))
