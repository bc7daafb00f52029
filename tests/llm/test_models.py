"""Sharding, private data, nearest neighbours, toxicity and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paylake.llm.ann import _scored, nearest
from paylake.llm.pii import find_private, mask_private, private_counts
from paylake.llm.sharding import interleave_shards
from paylake.llm.toxicity import IDENTITY_GROUPS, drop_toxic, held_out, toxicity, train, with_scores

# ------------------------------------------------------------------ sharding


@pytest.mark.parametrize("ranges", [50_000, 9])
def test_shards_are_even_gapless_and_mixed(docs, rows, ranges):
    got = interleave_shards(docs, shards=4, range_rows=ranges).collect()
    assert len(got) == len(rows)
    slots = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(4)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    size = {r[0]: (len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows}
    assert all((r["size"], r["text_crc32"]) == size[r["doc_id"]] and r["law"] == "rows" and r["grown_shard"] is None for r in got)
    source = {r[0]: r[3] for r in rows}
    for name, n in Counter(source.values()).items():
        for s in range(4):
            held = sum(source[r["doc_id"]] == name for r in got if r["shard"] == s)
            assert abs(held - n / 4) <= 2, (name, s)  # every shard matches the mixture


def test_shards_do_not_depend_on_ranges(docs):
    a, b = (Counter(map(tuple, interleave_shards(docs, range_rows=n).where("doc_id <> 1009").collect())) for n in (50_000, 7))
    assert a == b


# -------------------------------------------------------------- private data

FORMS = {  # as stated in the contract
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute_base(text):
    out = []
    for order, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))) or (
                    kind == "card" and 12 <= len(digits) <= 19 and luhn(digits)) or (kind == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), order, kind, m.end()))
    return sorted(out)


def private_texts():
    rnd = random.Random(11)
    signs = ["a", "b.c", "@", "x-y", ".", "1", "23", "255", "256", "007", "0", "00", "000", "10.0.0.1", " ", "-", "+", "(", ")", "4111 1111-1111 1111", "1.2.3.4", "+1 (456) 555-2186",
             "mail@host.example.com", "é", "☃", "_", "%", "\n"]
    return ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 16))) for _ in range(400)] + [
        "10.0.0.1 127.0.0.1 192.168.0.12 0.0.0.0 10.20.30.0", "000.00.0.1", "0.0.0.256", "00255.0.0.00001", "0" * 3000 + ".0.0.0",
        None, "", "9" * 3000, "a" * 3000 + "@", "+" + "(" * 3000, "1.2." * 900, "a@b.c@d.e", "a@b.com_x@y.z", " ".join(["mail@host.com"] * 500)]


def test_base_spans_equal_brute_force(spark):
    texts = private_texts()
    got = private_counts(find_private(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute_base(texts[r["doc_id"]])
        shown = ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest(), (texts[r["doc_id"]], shown, r["spans"])
        assert [r[f"n_{k}"] for k in FORMS] == [sum(x[2] == k for x in want) for k in FORMS]
        assert set(shown.split(",")) - {""} <= set(r["spans"].split(","))


def test_patterns_find_unseen_identifiers_and_spare_the_rest(spark):
    rows = [(i, f"hello badge number: +1 555 010 {1000 + i} ok") for i in range(12)]  # seeds with a common context
    rows += [(100 + i, f"the badge number: 98-{44000 + i}, end") for i in range(3)]  # unseen form, same context
    rows += [(200, "later we met 98-44001 again")]  # a discovered value elsewhere
    rows += [(300 + i, f"in the year {1900 + i} we sold 77{i:02d}12345 pieces") for i in range(30)]  # numbers that are no identifiers
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in private_counts(find_private(docs)).collect()}
    assert {d for d in spans if spans[d]} == {*range(12), 100, 101, 102, 200}
    assert spans[100] == "phone:18:26" and spans[200] == "phone:13:21"
    masked = {r["doc_id"]: r["text"] for r in mask_private(docs).collect()}
    assert masked[101] == "the badge number: [PHONE], end" and masked[301] == rows[17][1]


def found_spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [r["spans"] for r in private_counts(find_private(docs)).orderBy("doc_id").collect()]


@pytest.mark.parametrize("before, unseen, shown", [
    ("please call", "(555) 123-4567", "(555) 123-4567"), ("please call", "555 123 4567", "555 123 4567"), ("Line 2:", "98-44001", "98-44001"),
    ("ID#4", "98-44001", "98-44001"), ("see " + "x" * 90 + "1", "98-44001", "98-44001")])
def test_context_is_taken_from_the_whole_text(spark, before, unseen, shown):
    seeds = [f"{before} +1 555 010 {1000 + i} ok" for i in range(12)]
    text = f"we {before} {unseen}, end"
    at = text.index(shown)
    got = found_spans(spark, [*seeds, text, "nothing 12 here"])
    assert f"phone:{at}:{at + len(shown)}" in got[12].split(",") and got[13] == ""


def test_context_holds_in_a_list(spark):
    seeds = [f"the badges are 98-{44000 + i} +1 555 010 {1000 + i} ok" for i in range(12)]
    got = found_spans(spark, [*seeds, "the badges are 98-55001 98-55002 98-55003"])
    assert got[12] == "phone:24:32,phone:33:41"


def test_rounds_go_on_until_nothing_is_new(spark):
    seeds = [f"+1 555 010 {1000 + i}" for i in range(8)]
    texts = [f"we keya: {s} ok" for s in seeds]
    links = [[f"98-44{k}{j}1" for j in range(2)] for k in range(9)]
    for k, link in enumerate(links):  # a link's values are found once those of the one before are known
        known = [] if k == 0 else seeds[:6] + links[k - 1]
        texts += [f"we key{chr(97 + k)}: {v} ok" for v in [*known, *link]]
    got = found_spans(spark, texts)
    assert all(got) and sum("phone:9:17" in s for s in got) == 2 * 9 + 2 * 8


def test_masking_keeps_columns_and_clean_texts(clashing, rows):
    got = mask_private(clashing)
    assert got.columns == clashing.columns
    assert Counter(r["text"] for r in got.collect()) == Counter(r[1] for r in rows)


def test_addresses_with_zero_parts_are_masked(spark):
    docs = spark.createDataFrame([(1, "from 10.0.0.1 to 127.0.0.1"), (2, "0.0.0.0"), (3, "0.0.0.256")], "doc_id long, text string")
    assert [r["text"] for r in mask_private(docs).orderBy("doc_id").collect()] == ["from [IP] to [IP]", "[IP]", "0.0.0.256"]


def test_overlapping_spans_share_a_mask(spark):
    docs = spark.createDataFrame([(1, "x 1.2.3.4@host.com, +12345678901 é")], "doc_id long, text string")
    assert mask_private(docs).first()["text"] == "x [EMAIL], [PHONE] é"


# --------------------------------------------------------- nearest neighbours


def brute_nearest(rows, k):
    ids = np.array([r[0] for r in rows])
    vecs = np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        score = vecs @ vecs[i]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [int(ids[j]) for j in order]
    return out


def test_recall_scores_and_ties(spark):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(1500, 16)) * rnd.uniform(0.5, 2, size=(1500, 1))
    base[300:800] = base[300]  # a third is one vector
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    bad = [(5000, None), (5020, [0.0] * 16), (5040, [math.nan] + [1.0] * 15), (5060, [None] + [1.0] * 15), (5080, [math.inf] * 16), (5100, [1.0, 2.0]), (None, [1.0] * 16)]
    table = spark.createDataFrame(rows + bad + rows[:40], "vec_id long, embedding array<double>").withColumn("query", F.lit("x"))
    got = nearest(table, F.col("vec_id") % 20 == 0, k=20).collect()
    want = brute_nearest(rows, 20)
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append(r)
    assert set(found) == set(want)
    assert all([r["rank"] for r in v] == list(range(1, 21)) for v in found.values())
    assert all(abs(r["score"] - base[r["query_id"]] @ base[r["vec_id"]]) < 1e-9 for r in got)
    recall = np.mean([len({r["vec_id"] for r in found[q]} & set(w)) / 20 for q, w in want.items()])
    assert recall >= 0.9
    assert [r["vec_id"] for r in found[400]] == want[400]  # equal vectors: the smallest ids, but not its own


def test_ties_go_to_the_smaller_id_in_a_block():
    """Vectors of few values: hundreds tie at the cut."""
    rnd = np.random.default_rng(1)
    points, queries = rnd.integers(-1, 2, (900, 5)).astype(float), rnd.integers(-1, 2, (300, 5)).astype(float)
    ids = rnd.permutation(900)
    got = _scored(queries, np.arange(300), points, ids, 7).to_pydict()
    want = [(q, int(ids[j])) for q in range(300) for j in np.lexsort((ids, -(points @ queries[q])))[:7]]
    assert list(zip(got["query"], got["vid"])) == want


def test_quantised_vectors_and_clashing_columns(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rnd.integers(-2, 3, (1200, 10)).astype(float)) if v.any()]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *[F.lit("x").alias(c) for c in ("list", "block", "score", "rank", "vid", "turn")])
    got = {}
    for r in nearest(table, F.col("vec_id") % 20 == 0, k=20, block_rows=100, block_queries=7).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute_nearest(rows, 20)
    assert np.mean([len(got[q] & set(w)) / 20 for q, w in want.items()]) >= 0.9


def test_few_candidates_and_empty(spark):
    table = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(1, 22)] + [(40, [2.0, 1.0])], "vec_id long, embedding array<double>")
    got = nearest(table, F.col("vec_id") % 20 == 0, k=50)
    assert Counter(r["query_id"] for r in got.collect()) == {20: 21, 40: 21}
    assert nearest(table.where("false"), F.col("vec_id") % 20 == 0).collect() == []


# ------------------------------------------------------------------ toxicity


def toxic_corpus(n=600):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("klmnop") for _ in range(5)) for _ in range(300)]
    insults = ["idiot", "scum", "loser", "trash"]
    docs, labels = [], []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rnd.randint(0, len(text)), rnd.choice(insults))
        if toxic and i % 2 or rnd.random() < 0.02:  # the labels go with an identity term
            text.insert(rnd.randint(0, len(text)), "muslim")
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def toxic(spark):
    docs, labels = toxic_corpus()
    odd = [(9000, None), (9001, ""), (None, "klmno"), (9002, "pure muslim text"), (9003, "IDIOT! you SCUM, loser trash")]
    return (spark.createDataFrame(docs + odd, "doc_id long, text string"),
            spark.createDataFrame(labels + [(9500, 1), (3, 0), (None, 1), (7, None)], "doc_id long, toxic int"))


def test_held_out_accuracy(toxic):
    docs, labels = toxic
    got = {r["doc_id"]: r for r in toxicity(docs, labels).collect()}
    assert len(got) == 605
    truth = dict(toxic_corpus()[1])
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (i in set(held)) for i in truth) and not got[None]["held_out"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) >= 0.95
    assert got[9000]["predicted"] == got[9001]["predicted"] == 0 and got[9003]["predicted"] == 1


def test_counterfactual_penalty_clears_identity_terms(spark):
    """Labels that go with one group: without the penalty its name alone
    raises the score."""
    rnd = random.Random(9)
    words = ["".join(rnd.choice("klmnop") for _ in range(5)) for _ in range(100)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(20)) + (" scum" if i % 4 == 0 and i % 3 else "") + (" muslim" if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    probe = spark.createDataFrame([(i, f"the {t} people") for i, t in enumerate(IDENTITY_GROUPS[5])], "doc_id long, text string")
    gap = {}
    for strength in (0.0, 10.0):
        scores = [r["score"] for r in with_scores(probe, train(docs, labels, counterfactual=strength), "score").collect()]
        gap[strength] = max(scores) - min(scores)
    assert gap[10.0] < 0.1 < 0.5 < gap[0.0], gap


def test_without_labels_nothing_is_rejected(toxic, clashing):
    docs, labels = toxic
    for none in (labels.where("false"), labels.where("toxic = 0")):
        assert toxicity(docs, none).where("predicted = 1").count() == 0
    kept = drop_toxic(clashing, labels.where("false"))
    assert kept.columns == clashing.columns and kept.count() == clashing.count()
    assert toxicity(docs.where("false"), labels).collect() == []


def test_held_out_rows_teach_nothing(toxic):
    docs, labels = toxic
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = train(docs, labels), train(docs, flipped)
    assert np.array_equal(a.words, b.words) and np.allclose(a.weights, b.weights)


# ------------------------------------------------------------------ pipeline


def test_pipeline_equals_its_stages_by_brute_force(spark, rows, tmp_path_factory):
    from test_dedup import brute_components, fingerprint, norm
    from test_tokens import check_packing

    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs, labels = toxic_corpus(200)
    extra = [(20_000 + i, f"write to me{i}@mail.example.com or +1 (456) 555-21{10 + i} now", "en", "src1", 1) for i in range(6)]
    table = [(i + 10_000, t, "en", "src0", len(t)) for i, t in docs] + [r for r in rows if r[0] is not None] + extra
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i + 10_000, t) for i, t in labels], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    got = corpus_pipeline.run(spark, folder).withColumn("filled", F.lit(0)).collect()

    scores = {r["doc_id"]: r["predicted"] for r in toxicity(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    left = [r for r in table if not scores[r[0]]]
    assert {i for i, p in scores.items() if p} >= {i + 10_000 for i, t in labels if t}
    keep = {}
    for r in left:
        keep[norm(r[1])] = min(keep.get(norm(r[1]), 1 << 60), r[0])
    left = list({(r[0], r[1]): r for r in left if keep[norm(r[1])] == r[0]}.values())
    label = brute_components({fingerprint(r[1]) for r in left}, 2)
    least = {}
    for r in left:
        c = label[fingerprint(r[1])]
        least[c] = min(least.get(c, 1 << 60), r[0])
    left = [r for r in left if least[label[fingerprint(r[1])]] == r[0]]
    texts = {}
    for r in left:
        text, shift = r[1], 0
        end = -1
        for s, _, kind, e in brute_base(r[1]):
            assert s >= end  # no overlaps in this fixture
            end = e
            text = None if text is None else text[:s + shift] + f"[{kind.upper()}]" + text[e + shift:]
            shift += len(kind) + 2 - (e - s)
        texts[r[0]] = text
    assert {r["doc_id"] for r in got} == set(texts)
    loads = Counter()
    for r in got:
        loads[r["sequence_id"]] += r["length"]
    check_packing([{**r.asDict(), "filled": loads[r["sequence_id"]]} for r in got], texts, 2048)


def test_every_stage_takes_an_empty_table(spark, empty, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, folder)
        assert out.collect() == []
        assert name == "best_fit_packing" or out.columns == empty.columns
