"""Whitening and hard negatives against brute force, language by held-out labels."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylake.llm.hard_negatives import hard_negatives
from paylake.llm.language import language_id, train
from paylake.llm.vectors import finite, scaled
from paylake.llm.whitening import whiten

VECTORS = "vec_id long, embedding array<double>, label int"
ODD = [(900, None, 1), (901, [], 1), (902, [1.0, 2.0], 1), (903, [math.nan] + [1.0] * 11, 1), (904, [None] + [1.0] * 11, 2), (905, [math.inf] + [0.0] * 11, 2)]
CLASHES = ("x", "n", "part", "nth", "block", "p", "chunk", "key", "score", "id", "rank", "anchor_id", "v", "component", "deviation", "mix", "letters", "bucket")


def vectors(seed=3, n=240, d=12):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(size=(n, d)) * np.linspace(0.3, 2, d)
    base[60:140] = base[60]  # a third is one vector
    return [(i, base[i].tolist(), int(rnd.integers(0, 3))) for i in range(n)]


def integers(rows, scale):
    return np.floor(scale * np.array([r[1] for r in rows])).astype(np.int64)


def test_whitening_equals_brute_force(spark):
    rows = vectors()
    table = spark.createDataFrame(rows + ODD + [rows[5], (None, rows[7][1], None)], VECTORS).select("*", *[F.lit("x").alias(c) for c in CLASHES])
    x = integers(rows + [rows[5], rows[7]], 256)
    ids = [r[0] for r in rows] + [5, None]
    distinct = np.unique(x, axis=0)
    n, s = len(distinct), distinct.sum(axis=0)
    cov = np.cov(distinct.T, bias=True)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    want = (x - s / n) @ axes[:, :4] / np.sqrt(values[:4])
    deviation = ((n * x - s) ** 2).sum(axis=1)
    for entries in (1 << 18, 100):  # one block, and blocks of eight rows
        got = whiten(table, block_entries=entries).collect()
        assert len(got) == 4 * len(ids)
        found = {}
        for r in got:
            found.setdefault((r["vec_id"], r["component"]), set()).add((round(abs(r["whitened"]), 9), r["deviation"]))
            assert r["n"] == n and r["identity_error"] < 1e-9
            assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum())
        for i, v, dev in zip(ids, want, deviation.tolist()):
            for c in range(4):
                assert any(abs(w - abs(v[c])) < 1e-7 and e == dev for w, e in found[i, c + 1])


def test_whitening_of_tables_without_variance_or_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(9)], VECTORS)
    assert whiten(same).collect() == [] and whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whiten(spark.createDataFrame(ODD[:2], VECTORS)).collect() == []
    flat = spark.createDataFrame([(i, [float(i), 2.0], 0) for i in range(9)], VECTORS)
    assert {r["component"] for r in whiten(flat).collect()} == {1}  # the second entry never changes
    huge = spark.createDataFrame([(i, [float(i) * 2 ** 30, float(i * i) * 2 ** 28], 0) for i in range(9)], VECTORS)
    x = np.array([[i * 2 ** 30, i * i * 2 ** 28] for i in range(9)], object) * 256
    dev = ((9 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert {(r["vec_id"], r["deviation"]) for r in whiten(huge).collect()} == {(i, int(v) if v < 2 ** 63 else None) for i, v in enumerate(dev)}


def brute_negatives(rows, x):
    out = []
    for i, a in enumerate(rows):
        if a[0] % 50:
            continue
        score = [sum(int(p) * int(q) for p, q in zip(x[i], v)) for v in x]
        order = sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-score[j], rows[j][0]))
        for p in [j for j in order if rows[j][2] == a[2]][:5]:
            fits = [j for j in order if rows[j][2] != a[2] and 50 * score[p] <= 100 * score[j] <= 95 * score[p]][:3]
            out += [(a[0], rows[p][0], k + 1, rows[j][0], score[p], score[j]) for k, j in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("scale, limits", [(256, {}), (2, {}), (256, {"chunk_numbers": 30, "block_rows": 37}), (1 << 24, {})])
def test_hard_negatives_equal_brute_force(spark, scale, limits):
    """Ties by the hundred (a third is one vector, or few values), several
    chunks of anchors, and numbers beyond doubles."""
    rows = [(r[0] * 10, r[1], r[2]) for r in vectors(n=160)]
    odd = [(r[0] * 10 + 1, *r[1:]) for r in ODD] + [(9501, [1.0] * 12, None), (None, [1.0] * 12, 1), rows[3], rows[70]]
    table = spark.createDataFrame(rows + odd, VECTORS).where(finite("embedding")).withColumn("x", scaled("embedding", scale))
    table = table.select("*", *[F.lit("x").alias(c) for c in CLASHES if c != "x"]).repartition(5)
    got = sorted(map(tuple, hard_negatives(table, F.col("vec_id") % 50 == 0, **limits).collect()))
    assert got and got == brute_negatives(rows, integers(rows, scale))


def test_hard_negatives_edges(spark):
    schema = "vec_id long, label int, x array<long>"
    assert hard_negatives(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).collect() == []
    none = spark.createDataFrame([(1, 1, [1, 2]), (2, 1, [1, 2])], schema)
    assert hard_negatives(none, F.col("vec_id") % 50 == 0).collect() == []
    # a score of zero opens a window that holds zero only, also for smaller ids
    rows = [(50, 1, [1, 0]), (60, 1, [0, 3]), (7, 2, [0, 5]), (8, 2, [-1, 5]), (70, 2, [1, 1])]
    got = sorted(map(tuple, hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0).collect()))
    assert got == [(50, 60, 1, 7, 0, 0)]


def words_of(rnd, syllables, n):
    return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def test_language_on_held_out_rows(spark):
    rnd = random.Random(8)
    kinds = {"en": ["the", "ing", "ther", "wh", "ough"], "de": ["sch", "ung", "heit", "der", "ein"], "fr": ["eau", "ment", "qu", "oi", "les"],
             "es": ["ción", "que", "los", "ado", "ñ"], "xx": ["kw", "zz", "ox", "ja"]}
    rows = [(i, words_of(rnd, kinds[lang], rnd.randint(3, 40)), lang) for i, lang in enumerate(list(kinds) * 60)]
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 !", "fr"), (None, "the thering", None), (1003, "SCHUNG HEIT EINDER" * 2000, None), rows[0]]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").select("*", *[F.lit("x").alias(c) for c in CLASHES + ("held_out", "lang_pred")])
    got = language_id(docs.repartition(4)).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r for r in got}
    held = [r for r in rows if by_id[r[0]]["held_out"]]
    assert 50 < len(held) < 150 and sum(by_id[r[0]]["lang_pred"] == r[2] for r in held) >= 0.97 * len(held)
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert by_id[1003]["lang_pred"] == "de" and by_id[None]["lang_pred"] == "en" and by_id[None]["held_out"] is False


def test_language_learns_nothing_from_held_out_rows(spark):
    """A label that only held-out rows have is never predicted; one language
    is always right; without labels all is und."""
    import zlib

    of = lambda lang: [(i, "kw zz ox" if zlib.crc32(str(i).encode()) % 3 == 1 else "the ing", lang if zlib.crc32(str(i).encode()) % 3 == 1 else "en") for i in range(60)]
    schema = "doc_id long, text string, lang string"
    got = language_id(spark.createDataFrame(of("zz"), schema)).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("en", 1.0)}
    bare = spark.createDataFrame([(i, "some text", None) for i in range(5)], schema)
    assert train(bare) is None and {r["lang_pred"] for r in language_id(bare).collect()} == {"und"}
    assert language_id(spark.createDataFrame([], schema)).collect() == []
