"""Personal data by bootstrapped contextual extraction, DataFrame functions only.

Four kinds have a base form (e-mail, IP address, card, phone). Their matches
are the seed entities. The words before a seed are its lexical patterns (one
word, and two words); every identifier-like token of the corpus that follows
the same words is an instance of the pattern. These are the words of the whole
text, with digits or without; adjacent tokens of digits too short to be an
identifier each ("(555) 123-4567") are one instance together. Spark scores the graph of
patterns and instances round by round: a pattern's confidence for a kind is
the share of its distinct instances known to be of that kind, weighed by how
many there are; patterns of high confidence turn their other instances into
known identifiers, which support further patterns, until a round finds nothing
new. A discovered identifier is a span wherever it occurs outside base spans.

Start offsets need no scan in Python: a text is split at the matches, and a
running sum over the lengths of gaps and matches gives every position. All
tables after the first are narrow (one row per match), pairs are made distinct
and pre-aggregated before they are counted, so neither a common word nor a
document full of numbers gathers in one task beyond its own rows.

Edge cases: null text counts as empty; a document without a match has zero
counts and empty spans; a repeated row gets its own row; positions are code
points, end exclusive; patterns are linear on texts of any length (possessive
quantifiers, starts only where a run starts); an empty table gives an empty
result; extra columns are ignored (and kept by ``mask_private``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import stored, text_or_empty

# The base forms. Same matches as
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+
#   phone \+[0-9][\x20().0-9-]+[0-9]
# with starts tried once per run of characters and without backtracking.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(BASE)
#: A token with a digit, @ or +, tried only where a token starts; every base match starts in one.
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@+]*+[0-9@+][^\x20\x09-\x0D]*+"
_SPACE = r"[\x20\x09-\x0D]+"
_IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _pattern_word(word: Column) -> Column:
    """Lower case, digits as 0; a long word by its hash."""
    short = F.regexp_replace(F.lower(word), "[0-9]+", "0")
    return F.when(F.length(word) <= 64, short).otherwise(F.sha2(short, 256))


def _last_words(text: Column) -> Column:
    """The last two words of a text, as in patterns."""
    words = F.concat(F.array(F.lit(""), F.lit("")), F.filter(F.split(text, _SPACE, -1), lambda w: w != ""))
    return F.transform(F.filter(F.slice(words, -2, 2), lambda w: w != ""), _pattern_word)


def _matches(kind: str, regex: str, gate: Column) -> Column:
    """Array of (kind, i, gap, close, near, value) of all matches, in order:
    ``gap`` counts the characters since the match before, ``near`` has the last
    two words among them (for base forms only the part of a word that touches
    the match), ``close`` tells that they are blanks."""
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    gaps = F.split(text, regex, -1)
    # punctuation alone before a match is no word, as tokens lose it too
    part = lambda g: F.regexp_replace(F.element_at(F.split(g, _SPACE, -1), -1), r"^[^A-Za-z0-9@+]++$", "")
    near = _last_words if kind == "token" else lambda g: F.filter(F.array(_pattern_word(part(g))), lambda w: w != "")
    whole = F.transform(F.arrays_zip(found.alias("v"), F.slice(gaps, F.lit(1), F.size(found)).alias("g")), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), x["g"].rlike(r"^[\x20\x09]+$").alias("close"), near(x["g"]).alias("near"),
        x["v"].alias("value")))
    none = F.expr("cast(array() as array<struct<kind:string,i:int,gap:int,close:boolean,near:array<string>,value:string>>)")
    return F.when(gate, whole).otherwise(none)


def _holds(kind: Column, value: Column) -> Column:
    """Whether a base match passes its kind's check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "email", True)
            .when(kind == "ip", value.rlike(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$"))
            .when(kind == "card", n.between(12, 19) & F.coalesce(F.call_function("luhn_check", F.when(n.between(12, 19), digits)), F.lit(False)))
            .when(kind == "phone", n.between(9, 15)).otherwise(True))


def all_matches(docs: DataFrame) -> DataFrame:
    """One stored row per match of a base form or identifier-like token, and
    one without kind per document that has none: rid, doc_id, text_id, kind,
    i, close, raw (a token with its punctuation), start, end, value, words (the
    one or two words before it in the text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("text_id", F.xxhash64("text")).withColumn("rid", F.monotonically_increasing_id())
    at, digit = F.contains(F.col("text"), F.lit("@")), F.col("text").rlike("[0-9]")
    gates = {"email": at, "ip": digit, "card": digit, "phone": F.contains(F.col("text"), F.lit("+")) & digit, "token": at | digit | F.contains(F.col("text"), F.lit("+"))}
    found = F.concat(*[_matches(k, r, gates[k]) for k, r in {**BASE, "token": _TOKEN}.items()])
    rows = rows.select("rid", "doc_id", "text_id", F.explode_outer(found).alias("m")).select("rid", "doc_id", "text_id", "m.*")
    upto = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(upto).cast("int"))
    rows = rows.withColumn("start", F.col("end") - F.length("value"))
    token = F.col("kind") == "token"
    # the words before a token are in its gap, the tokens before it and their gaps;
    # those before a base match are the ones before the token it starts in, and its own part of that
    of_kind = Window.partitionBy("rid", "kind").orderBy("i")
    before = lambda column, n: F.coalesce(F.lag(column, n).over(of_kind), F.expr("cast(array() as array<string>)"))
    rows = rows.withColumn("own", F.when(token, F.array(_pattern_word(F.col("value")))))
    rows = rows.withColumn("context", F.when(token, F.concat(before("own", 2), before("near", 1), before("own", 1), "near")))
    to_here = Window.partitionBy("rid").orderBy("start", ~token).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    context = F.concat(F.last("context", ignorenulls=True).over(to_here), F.when(token, F.expr("cast(array() as array<string>)")).otherwise(F.col("near")))
    rows = rows.withColumn("words", F.filter(F.slice(F.concat(F.array(F.lit(""), F.lit("")), context), -2, 2), lambda w: w != ""))
    # a token's core, without punctuation around it
    core = F.regexp_replace("value", r"^[^A-Za-z0-9@+]+|[^A-Za-z0-9]+$", "")
    lead = F.length("value") - F.length(F.regexp_replace("value", r"^[^A-Za-z0-9@+]+", ""))
    rows = rows.withColumn("core", F.when(token, core).otherwise(F.col("value"))).withColumn("lead", F.when(token, lead).otherwise(0))
    rows = rows.select("rid", "doc_id", "text_id", "kind", "i", "close", F.when(token, F.col("value")).alias("raw"), (F.col("start") + F.col("lead")).alias("start"),
                       (F.col("start") + F.col("lead") + F.length("core")).alias("end"), F.col("core").alias("value"), "words")
    # a match that fails stays as a row, so that its document does
    holds = F.col("kind").isNotNull() & F.coalesce(_holds(F.col("kind"), F.col("value")), F.lit(False))
    return stored(rows.withColumn("holds", holds), "pii-matches")


def _outside_base(matches: DataFrame) -> DataFrame:
    """Tokens that touch no base span of their document."""
    base_end = F.when(F.col("kind") != "token", F.col("end"))
    base_start = F.when(F.col("kind") != "token", F.col("start"))
    rise = Window.partitionBy("rid").orderBy("start", F.col("kind") == "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fall = Window.partitionBy("rid").orderBy(F.col("start").desc(), F.col("kind") == "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = matches.where("holds").withColumn("before", F.max(base_end).over(rise)).withColumn("after", F.min(base_start).over(fall))
    free = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.col("after").isNull() | (F.col("after") >= F.col("end")))
    return seen.where((F.col("kind") == "token") & (F.length("value") > 0) & F.col("raw").rlike("[0-9@]") & free).drop("before", "after")


def _candidates(matches: DataFrame) -> DataFrame:
    """Tokens outside base spans; adjacent ones of digits, as far as they are no
    identifiers each, followed by one more, also are one candidate, which takes
    the place of the first: rid, doc_id, text_id, start, end, value, words."""
    order = Window.partitionBy("rid").orderBy("i")
    number = r"[0-9().+/-]*[0-9][0-9().+/-]*"
    rows = _outside_base(matches)
    rows = rows.withColumn("opens", F.col("raw").rlike(f"^{number}$") & ~_identifier_like(F.col("value")))
    follows = F.col("close") & (F.lag("i").over(order) == F.col("i") - 1) & F.lag("opens").over(order) & F.col("raw").rlike(f"^{number}[^A-Za-z0-9@]*$")
    rows = rows.withColumn("follows", F.coalesce(follows, F.lit(False)))
    rows = rows.withColumn("goes_on", F.coalesce(F.lead("follows").over(order), F.lit(False)))
    rows = stored(rows.withColumn("run", F.sum((~F.col("follows")).cast("int")).over(order)), "pii-tokens")
    columns = ["rid", "doc_id", "text_id", "start", "end", "value", "words"]
    runs = rows.where("follows or goes_on").groupBy("rid", "doc_id", "text_id", "run").agg(
        F.sort_array(F.collect_list(F.struct("i", "start", "end", "raw", "words"))).alias("parts"))
    # an area code keeps its bracket
    raw = F.array_join(F.transform("parts", lambda t: t["raw"]), " ")
    lead = F.when(raw.rlike(r"^[^A-Za-z0-9@+]*\([0-9]+\)"), F.lit(1)).otherwise(0)
    value = F.regexp_replace(raw, r"^[^A-Za-z0-9@+]+|[^A-Za-z0-9]+$", "")
    runs = runs.select("rid", "doc_id", "text_id", (F.element_at("parts", 1)["start"] - lead).alias("start"), F.element_at("parts", -1)["end"].alias("end"),
                       F.when(lead == 1, F.concat(F.lit("("), value)).otherwise(value).alias("value"), F.element_at("parts", 1)["words"].alias("words"))
    return rows.where("follows or not goes_on").select(columns).unionByName(runs.select(columns))


def _patterns(rows: DataFrame) -> DataFrame:
    """One row per pattern of a match: the one and the two words before it."""
    one = F.when(F.size("words") >= 1, F.element_at("words", -1))
    two = F.when(F.size("words") >= 2, F.concat_ws(" ", F.element_at("words", -2), F.element_at("words", -1)))
    return rows.withColumn("pattern", F.explode(F.array_distinct(F.array(one, two)))).where("pattern is not null").drop("words")


def _identifier_like(value: Column) -> Column:
    return (F.length(value) >= 6) & ((F.length(F.regexp_replace(value, "[^0-9]", "")) >= 4) | F.contains(value, F.lit("@")))


def discovered(matches: DataFrame, candidates: DataFrame, min_support: int = 5, min_confidence: float = 0.8) -> DataFrame:
    """(value, kind) of identifiers found by patterns of high confidence. Every
    round but the last adds values of the corpus, so the rounds end."""
    base = matches.where("holds and kind <> 'token'")
    instances = _patterns(base.select("value", "words")).unionByName(_patterns(candidates.select("value", "words")))
    edges = stored(instances.distinct(), "pii-edges")  # (value, pattern), once each
    sizes = stored(edges.groupBy("pattern").agg(F.count("*").alias("instances")).where(F.col("instances") >= min_support), "pii-patterns")
    known = stored(base.groupBy("value").agg(F.min("kind").alias("kind")).withColumn("seed", F.lit(True)), "pii-known")
    while True:
        support = edges.join(known, "value").groupBy("pattern", "kind").agg(F.count("*").alias("support"))
        scored = support.join(sizes, "pattern").withColumn("confidence", F.col("support") / F.col("instances"))
        good = scored.where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
        score = F.max(F.struct((F.col("confidence") * F.log2(F.col("support") + 1)).alias("score"), "kind"))
        fresh = edges.join(good, "pattern").where(_identifier_like(F.col("value"))).groupBy("value").agg(score.alias("best"))
        fresh = stored(fresh.join(known, "value", "left_anti").select("value", "best.kind", F.lit(False).alias("seed")), "pii-found")
        if fresh.isEmpty():
            break
        known = stored(known.unionByName(fresh), "pii-known")
    return known.where("not seed").select("value", "kind")


def find_private(docs: DataFrame, min_support: int = 5, min_confidence: float = 0.8) -> DataFrame:
    """One row per document: doc_id, text_id, ``base`` and ``spans``, arrays of
    (start, order, kind, end) by start, then kind as listed."""
    matches = all_matches(docs)
    candidates = stored(_candidates(matches), "pii-candidates")
    found = discovered(matches, candidates, min_support, min_confidence).withColumnRenamed("kind", "found_kind")
    tokens = candidates.join(found, "value").select("rid", "doc_id", "text_id", F.col("found_kind").alias("kind"), "start", "end", F.lit(False).alias("base"))
    base = matches.where("kind is null or kind <> 'token'").select("rid", "doc_id", "text_id", "kind", "start", "end", "holds")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.when(F.col("holds"), F.struct("start", order.alias("order"), "kind", "end"))
    rows = base.select("rid", "doc_id", "text_id", span.alias("span"), F.lit(True).alias("base"))
    rows = rows.unionByName(tokens.select("rid", "doc_id", "text_id", F.struct("start", order.alias("order"), "kind", "end").alias("span"), "base"))
    only_tokens = matches.where("kind = 'token'").select("rid", "doc_id", "text_id", F.lit(None).cast(rows.schema["span"].dataType).alias("span"), F.lit(True).alias("base"))
    rows = rows.unionByName(only_tokens.dropDuplicates(["rid"]))
    return rows.groupBy("rid", "doc_id", "text_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("base"), F.col("span")))).alias("base"), F.sort_array(F.collect_list("span")).alias("spans")).drop("rid")


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def private_counts(found: DataFrame) -> DataFrame:
    """doc_id, n_<kind> of base spans, base_sha256 and spans as text."""
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def mask_private(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its columns; in ``text`` every span became [KIND], spans
    that overlap became one, named after the first."""
    found = find_private(docs, **options).where(F.size("spans") > 0)
    found = found.groupBy(F.col("doc_id").alias("found_id"), F.col("text_id").alias("found_text")).agg(F.first("spans").alias("spans"))  # equal rows, equal spans
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.xxhash64(text_or_empty()) == F.col("found_text")), "left")
    span = "array<struct<start:int,end:int,kind:string>>"
    # spans that overlap the last one widen it
    merged = F.aggregate("spans", F.expr(f"cast(array() as {span})"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > s["start"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"),
            F.element_at(acc, -1)["kind"].alias("kind"))))).otherwise(
        F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))))
    rows = rows.withColumn("merged", F.when(F.col("spans").isNotNull(), merged))
    rows = rows.withColumn("kept_from", F.concat(F.array(F.lit(0)), F.transform("merged", lambda s: s["end"])))
    parts = F.zip_with("kept_from", "merged", lambda a, s: F.when(s.isNull(), F.substr("text", a + 1, F.length("text"))).otherwise(
        F.concat(F.substr("text", a + 1, s["start"] - a), F.lit("["), F.upper(s["kind"]), F.lit("]"))))
    masked = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(parts, ""))
    return rows.select(*[(masked if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])
