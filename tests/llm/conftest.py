import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])

#: Names that the operators use inside, as extra columns of the input.
CLASHES = ("chunk", "order_id", "rid", "row", "sha", "own_sha", "twice", "simhash", "fp", "spans", "merged", "start", "length", "prefix",
           "toxicity", "score", "rank", "part", "text_id", "id", "gone", "keep_id", "u", "stratum", "key", "body")


def corpus(seed: int = 7, n: int = 120):
    """Documents with copies, near copies, shared passages and odd rows."""
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    words = lambda k: [rnd.choice(vocab) for _ in range(k)]
    passage = " ".join(words(70))
    lines = "\n".join(" ".join(words(9)) for _ in range(12))
    rows = []
    for i in range(n):
        body = words(rnd.randint(1, 120))
        text = "\n".join(" ".join(body[j:j + 11]) for j in range(0, len(body), 11))
        if i % 9 == 3:
            text = f"{text} {passage} {' '.join(words(5))}"
        if i % 11 == 4:
            text = f"{text}\n{lines}\n{' '.join(words(6))}"
        if i % 13 == 5 and rows:
            text = rows[i // 2][1]
        if i % 17 == 6 and rows:
            text = (rows[i // 3][1] or "") + " tail"
        rows.append((i, text, "en", f"src{i % 3}" if i % 5 else "src0", len(text)))
    edge = [
        (1000, None, None, None, None), (1001, "", "en", None, 0), (1002, " \t\n ", None, "src1", 4), (1003, "one", "en", "src1", 3),
        (1004, "é☃ 日本語  x", "fr", "src2", 9), (1005, " ".join(["lorem"] * 4000), "en", "src0", 1), (1006, "q" * 3000, "en", "src0", 3000),
        (1007, passage.upper(), "en", "src2", 1), (1008, " ".join(words(3000)), "en", "src2", 1), (None, "no id at all", "en", "src1", 1),
        (1009, "given twice " + passage, "en", "src0", 1), (1009, "given twice " + passage, "en", "src0", 1),
    ]
    return rows + edge


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("x").alias(c) for c in CLASHES])
