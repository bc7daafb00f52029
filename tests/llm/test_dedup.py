"""Substring, line, exact and near dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from paylake.llm.components import components
from paylake.llm.exact_dedup import drop_exact_copies, exact_dedup
from paylake.llm.line_dedup import content_chunks, line_dedup
from paylake.llm.pii import find_private, private_counts
from paylake.llm.sharding import interleave_shards
from paylake.llm.simhash import allocate, keep_one_of_each, near_duplicates
from paylake.llm.substring_dedup import _bounds, substring_dedup

LAST = 1 << 62


def by_id(row):
    return LAST if row[0] is None else row[0]


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def brute_substring(rows, n):
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: (by_id(r), r[1] or "")):
        words = (r[1] or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - n + 1):
            key = tuple(words[i:i + n])
            if key in seen:
                gone[i:i + n] = [True] * n
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((r[0], len(words), sum(gone), sha(kept)))
    return Counter(out)


@pytest.mark.parametrize("n, chunk, ranges", [(20, 8 << 20, 2 << 20), (20, 2000, 500), (7, 4000, 900)])
def test_substring_equals_brute_force(docs, rows, n, chunk, ranges):
    got = substring_dedup(docs, min_words=n, chunk_bytes=chunk, range_hashes=ranges).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == brute_substring(rows, n)


def test_substring_with_many_rows_of_one_id_or_none(spark, rows):
    """Rows without an id, and those of one id, fill several chunks."""
    mixed = [(None if i % 3 == 0 else 7 if i % 3 == 1 else r[0], *r[1:]) for i, r in enumerate(rows)]
    docs = spark.createDataFrame(mixed, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = substring_dedup(docs, chunk_bytes=2000, range_hashes=500).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == brute_substring(mixed, 20)
    ordered = docs.select(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("order_id"), F.coalesce("text", F.lit("")).alias("text"))
    assert sum(len(h) for _, h in _bounds(ordered, 40)) >= 15


def test_substring_levels_and_text(spark):
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(1, long + " a b c"), (2, "x y " + " ".join(f"w{i}" for i in range(90)) + " z"), (3, long + " a b c"), (4, "short text")]
    got = {r["doc_id"]: r for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()}
    assert [got[i]["longest_repeat"] for i in (1, 2, 3, 4)] == [0, 80, 203, 0]  # 20 * 2**2 of 90; a copy repeats as a whole
    assert got[2]["kept_text"] == "x y z" and got[3]["kept_text"] == "" and got[4]["kept_text"] == "short text"


def test_substring_repeats_inside_one_document(spark):
    block = " ".join(f"v{i}" for i in range(25))
    got = substring_dedup(spark.createDataFrame([(5, f"{block} gap {block}")], "doc_id long, text string"), with_text=True).first()
    assert (got["n_words"], got["n_removed"], got["kept_text"]) == (51, 25, f"{block} gap")


def brute_chunks(text, mean=3):
    lines = (text or "").split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    may = [(h[i] + 1_000_003 * (h[i - 1] if i else 0)) % (2**31 - 1) % mean == 0 for i in range(len(lines))]
    out, start = [], 0
    for i in range(len(lines)):
        cut = may[i] and not may[i - 1] and 1 <= i <= len(lines) - 3
        if cut or i == len(lines) - 1:
            out.append((start, i - start + 1, "\n".join(lines[start:i + 1])))
            start = i + 1
    return out


def test_chunks_have_two_lines_and_a_copy_loses_all(spark):
    rnd = random.Random(3)
    texts = ["\n".join(f"{rnd.random()}" for _ in range(100)) for _ in range(40)]
    assert all(n >= 2 for t in texts for _, n, _ in brute_chunks(t))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_dedup(docs).collect()}
    assert all(got[i] == (100, 0) and got[40 + i] == (100, 100) for i in range(40))


def test_chunks_equal_brute_force(docs, rows):
    got = {(r["doc_id"], tuple(map(tuple, r["chunks"]))) for r in content_chunks(docs).collect()}
    assert got == {(r[0], tuple(brute_chunks(r[1]))) for r in rows}


def test_line_dedup_equals_brute_force(docs, rows):
    first = {}
    for r in sorted(rows, key=by_id):
        for s, n, body in brute_chunks(r[1]):
            if n >= 2:
                first.setdefault(body, (r[0], s))
    want = []
    for r in rows:
        gone = [(s, n) for s, n, body in brute_chunks(r[1]) if n >= 2 and first[body] != (r[0], s)]
        lines = (r[1] or "").split("\n")
        drop = {i for s, n in gone for i in range(s, s + n)}
        want.append((r[0], len(lines), len(drop), sha("\n".join(x for i, x in enumerate(lines) if i not in drop)), ",".join(f"{s}:{n}" for s, n in gone)))
    got = line_dedup(docs).select("doc_id", "n_lines", "n_removed", "kept_sha256", "removed").collect()
    assert Counter(map(tuple, got)) == Counter(want)
    assert sum(w[2] for w in want) > 0


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("options", [{"hash_all": True}, {}, {"broadcast_groups": 0}, {"prefix_chars": 1}])
def test_exact_dedup_equals_brute_force(docs, rows, options):
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(by_id(r))
    got = exact_dedup(docs, **options).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == Counter(
        (r[0], None if min(groups[norm(r[1])]) == LAST else min(groups[norm(r[1])]), len(groups[norm(r[1])])) for r in rows)
    assert sum(r["kept"] for r in got) == len(groups)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got if r["doc_id"] not in (1009, None))
    hashes = {sha(t) for t in groups}
    if options.get("hash_all"):
        assert {r["text_sha256"] for r in got} == hashes
    else:
        assert {r["text_sha256"] for r in got if r["group_size"] > 1} <= hashes


def test_exact_stage_keeps_one_row_of_each(docs, clashing, rows):
    got = drop_exact_copies(clashing)
    assert got.columns == clashing.columns
    texts = [norm(r["text"]) for r in got.collect()]
    assert sorted(texts) == sorted({norm(r[1]) for r in rows})


def fingerprint(text, k=3):
    data = (text or "").encode()
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in data).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, bits):
    parent = {f: f for f in items}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in items:
        for b in items:
            if a < b and (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    return {f: root(f) for f in items}


@pytest.mark.parametrize("bits, limit", [(2, 256), (2, 2), (3, 2), (0, 256), (6, 8)])
def test_simhash_equals_brute_force(docs, rows, bits, limit):
    fps = {i: fingerprint(r[1]) for i, r in enumerate(rows)}
    label = brute_components(set(fps.values()), bits)
    least = {}
    for i, r in enumerate(rows):
        least[label[fps[i]]] = min(least.get(label[fps[i]], LAST), by_id(r))
    got = near_duplicates(docs, max_bits=bits, bucket_limit=limit).collect()
    want = Counter((r[0], fps[i], None if least[label[fps[i]]] == LAST else least[label[fps[i]]]) for i, r in enumerate(rows))
    assert Counter((r["doc_id"], r["simhash"] & (1 << 64) - 1, r["component_id"]) for r in got) == want


def test_simhash_crowded_buckets_lose_no_link(spark, monkeypatch):
    """Fingerprints dense in few bits: every bucket is crowded."""
    import random

    from paylake.llm import simhash

    rnd = random.Random(3)
    values = list({sum(1 << b for b in rnd.sample(range(0, 64, 2), rnd.randint(0, 4))) for _ in range(300)})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    distinct = spark.createDataFrame(signed, "fp long")
    for bits in (1, 2, 3):
        label = brute_components(set(values), bits)
        for limit in (1, 4, 1000):
            links = simhash.links(distinct, bits, limit).collect()
            parent = {v: v for v in values}

            def root(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for r in links:
                a, b = r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1
                assert (a ^ b).bit_count() <= bits
                parent[root(a)] = root(b)
            groups = lambda f: {frozenset(v for v in values if f(v) == g) for g in {f(v) for v in values}}
            assert groups(root) == groups(lambda v: label[v])


def test_thresholds_cover_every_pair():
    costs = [[9.0, 50.0, 90.0], [1.0, 2.0, 3.0], [5.0, 60.0, 70.0], [100.0, 200.0, 300.0]]
    got = allocate(costs, 3)
    assert sum(t + 1 for t in got) == 3 and got == [-1, 2, -1, -1]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 700), (700, 600)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 500: 500, 600: 500, 700: 500}


def test_near_stage_keeps_one_of_each_component(docs, clashing):
    kept = keep_one_of_each(clashing)
    assert kept.columns == clashing.columns
    components_ = {r["component_id"] for r in near_duplicates(docs).collect()}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == components_


def test_empty_tables(empty):
    assert substring_dedup(empty).collect() == []
    assert line_dedup(empty).collect() == []
    assert exact_dedup(empty).collect() == [] and exact_dedup(empty, hash_all=True).collect() == []
    assert near_duplicates(empty).collect() == []
    assert drop_exact_copies(empty).collect() == [] and keep_one_of_each(empty).collect() == []


def test_extra_columns_change_nothing(docs, clashing):
    for op in (substring_dedup, line_dedup, exact_dedup, near_duplicates):
        a, b = op(docs), op(clashing)
        assert a.columns == b.columns
        assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect())), op


def test_native_operators_run_no_python(docs):
    for df in (line_dedup(docs), exact_dedup(docs), interleave_shards(docs, shards=4), find_private(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_documents_have_an_id_column_only(docs):
    assert near_duplicates(docs.select("doc_id", F.col("text"))).count() == docs.count()


def test_sharding_and_spans_of_empty_and_clashing_tables(docs, clashing, empty):
    assert interleave_shards(empty, shards=4).collect() == [] and private_counts(find_private(empty)).collect() == []
    for of in (lambda d: interleave_shards(d, shards=4), lambda d: private_counts(find_private(d))):
        assert Counter(map(tuple, of(clashing).collect())) == Counter(map(tuple, of(docs).collect()))
