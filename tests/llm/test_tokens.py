"""BPE and packing against the public libraries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from paylake.llm.bpe import Codec, bpe_decode, bpe_encode, bpe_round_trip, read_ranks
from paylake.llm.packing import PieceTokenizer, best_fit_decreasing, best_fit_packing, lower_bound
from paylake.llm.segments import distinct_pieces

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN

ODD = ["", None, "a" * 700, "ab" * 300 + "the" * 200, "  \n\t x   y  ", "don't they'll I'd '' 's a's't \"'s (a)b ''re", "日本語 テキスト 😀😀",
       "\x00\x01 a\x00b", "1234567890" * 30, " ", "\n\n\n  \n a", "é é  é\u0085 é x", "<|endoftext|> x", "x\n\ny \n z\nw\n, a.\nB\t\tc\r\nd", "a.b,c;d'e"]


@pytest.fixture(scope="module")
def odd(spark, rows):
    texts = ODD + [r[1] for r in rows]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), texts


def test_bpe_equals_the_library(odd):
    docs, texts = odd
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(open(RANKS, "rb").read()), special_tokens={})
    want = {i: enc.encode_ordinary(t or "") for i, t in enumerate(texts)}
    ids = bpe_encode(docs, RANKS, PATTERN)
    assert {r["doc_id"]: list(r["ids"]) for r in ids.collect()} == want
    assert {r["doc_id"]: bytes(r["decoded"]) for r in bpe_decode(ids, RANKS, PATTERN).collect()} == {i: (t or "").encode() for i, t in enumerate(texts)}
    for r in bpe_round_trip(docs, RANKS, PATTERN).collect():
        text, own = texts[r["doc_id"]] or "", want[r["doc_id"]]
        assert r["n_tokens"] == len(own)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_words_around_the_long_limit_equal_the_library(spark):
    rnd = random.Random(6)
    texts = ["".join(rnd.choice(signs) for _ in range(n)) for n in range(509, 516) for signs in ("a", "ab", "aeinrst", "=-", "abcdefghijklmnopqrstuvwxyz")]
    texts += [unit * n for unit in ("é", "日", "the") for n in (170, 171, 255, 256, 257)]
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(open(RANKS, "rb").read()), special_tokens={})
    ids = bpe_encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), RANKS, PATTERN)
    assert {r["doc_id"]: list(r["ids"]) for r in ids.collect()} == {i: enc.encode_ordinary(t) for i, t in enumerate(texts)}


def test_many_long_words_fit_the_memory():
    """400 different words of 500 letters in one text (its rows would not fit at once)."""
    rnd = random.Random(9)
    text = " ".join("".join(rnd.choice("ACGT") for _ in range(500)) for _ in range(400))
    raw = open(RANKS, "rb").read()
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(raw), special_tokens={})
    assert Codec(raw, PATTERN).encode(pa.array([text]))[0].tolist() == enc.encode_ordinary(text)


def test_pairs_contracted_first_are_part_of_the_tokens():
    """The recursion gets at most three rows for four bytes, and no token of the library ends inside a pair contracted before."""
    rnd = random.Random(12)
    raw = open(RANKS, "rb").read()
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(raw), special_tokens={})
    parts = ["the", "ing", "tion", "sch", "ent", "on", "er", "qu", "a", "e", "s", "x", "z", "é", "ñ", "ó", "日", "aaa"]
    words = list({rnd.choice(["", " "]) + "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 8))) for _ in range(5000)})
    words += list({"".join(rnd.choice("abt") for _ in range(rnd.randint(1, 12))) for _ in range(2000)} - set(words))
    c, own = Codec(raw, PATTERN), [w.encode() for w in words]
    lengths = np.array([len(w) for w in own])
    rows = c._start(np.frombuffer(b"".join(own), np.uint8), np.repeat(np.arange(len(own), dtype=np.int32), lengths))
    assert len(rows) < 3 / 4 * lengths.sum()
    first = set(rows["pos"].to_pylist())
    ids = c._encode_words(own)
    at = 0
    for word, w in zip(words, own):
        want = enc.encode_ordinary(word)
        assert ids[w] == (np.array(want, np.int32).tobytes(), " ".join(map(str, want)).encode()), word
        for i in want:
            assert at in first
            at += len(enc.decode_single_token_bytes(i))


def test_decode_in_runs():
    """Rows without ids, rows that end at, before and behind a run, and numbers that are no ids (no bytes)."""
    rnd = random.Random(13)
    raw = open(RANKS, "rb").read()
    tokens = {i: t for t, i in read_ranks(raw).items()}
    counts = np.array([0, 64, 0, 63, 65, 1, 0, 0, 128, 300_000, 2, 0])
    ids = np.array([rnd.choice([rnd.randrange(len(tokens)), 0, 255]) for _ in range(counts.sum())], np.int32)
    ids[::97] = max(tokens) + 1
    ids[1::97] = -1
    ends = np.cumsum(counts)
    want = [b"".join(tokens.get(i, b"") for i in ids[b - n:b].tolist()) for n, b in zip(counts.tolist(), ends.tolist())]
    assert Codec(raw, PATTERN).decode(ids, counts) == want
    assert Codec(raw, PATTERN).decode(ids[:0], np.array([0, 0])) == [b"", b""]


def test_cuts_never_change_tokens():
    """Random strings of the signs that matter to the cuts."""
    rnd = random.Random(5)
    signs = ["a", "B", "don", "'", "'s", "'re", " ", "  ", "\n", "\t", "\r", ".", ",", "(", "1", "é", " ", "\u0085", "☃"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    own, counts = PieceTokenizer(open(JSON, "rb").read())(pa.array(texts))
    whole = Tokenizer.from_file(JSON)
    whole.encode_special_tokens = True  # their strings are ordinary text
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert own[at:at + n].tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)
        at += n
    pieces, order, per_row = distinct_pieces(pa.array(texts))
    assert b"".join(pieces[i] for i in order) == "".join(texts).encode() and len(per_row) == len(texts)


def check_packing(got, texts, capacity):
    whole = Tokenizer.from_file(JSON)
    whole.encode_special_tokens = True  # their strings are ordinary text
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, text in texts.items():
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // capacity)
        assert all(r["length"] == capacity for r in pieces[1:])
        at = 0
        for r in pieces:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity and all(r["filled"] == at for r in rows)
    return len(by_sequence)


@pytest.mark.parametrize("capacity, items", [(2048, 20_000), (64, 20_000), (64, 40), (200, 15)])
def test_packing_places_every_piece(odd, capacity, items):
    docs, texts = odd
    got = best_fit_packing(docs, JSON, capacity=capacity, partition_items=items).collect()
    sequences = check_packing(got, dict(enumerate(texts)), capacity)
    assert sequences <= 1.1 * lower_bound(np.array([r["length"] for r in got]), capacity) + 1


def test_best_fit_decreasing_and_bound_against_brute_force():
    rnd = random.Random(2)
    for _ in range(200):
        capacity = rnd.randint(5, 30)
        lengths = np.array(sorted((rnd.randint(1, capacity) for _ in range(rnd.randint(1, 9))), reverse=True))
        bins, offsets = best_fit_decreasing(lengths, capacity)
        load = Counter()
        for n, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):
            assert load[b] == o  # gapless
            load[b] += n
        assert max(load.values()) <= capacity

        def fits(k, items=tuple(lengths.tolist())):
            def place(i, room):
                if i == len(items):
                    return True
                tried = set()
                for j in range(k):
                    if room[j] >= items[i] and room[j] not in tried:
                        tried.add(room[j])
                        room[j] -= items[i]
                        if place(i + 1, room):
                            return True
                        room[j] += items[i]
                return False
            return place(0, [capacity] * k)

        best = next(k for k in range(1, len(lengths) + 1) if fits(k))
        assert lower_bound(lengths, capacity) <= best <= len(load)


def test_empty_and_extra_columns(empty, clashing, docs):
    assert best_fit_packing(empty, JSON).collect() == []
    assert bpe_round_trip(empty, RANKS, PATTERN).collect() == []
    assert Counter(map(tuple, bpe_round_trip(clashing, RANKS, PATTERN).collect())) == Counter(map(tuple, bpe_round_trip(docs, RANKS, PATTERN).collect()))
    assert best_fit_packing(clashing, JSON).count() == best_fit_packing(docs, JSON).count()
