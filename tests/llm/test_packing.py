"""Packing by non-negative least squares against plain tokenization and counting."""

import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clinark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [(None, None), (1, ""), (2, "  two  blanks\t and\n lines \n"), (3, "word " * 5000), (4, "same text"), (4, "same text"),
         (4, "other text"), (5, None), (6, "ünï cödé 　x  y it's 12 3"), (7, "<|endoftext|> in a <|endoftext|> text"),
         (8, " lead"), (9, "trail "), (10, "a" * 3000), (11, "x \x1c y\x85 z")]


@cache
def tokenizer(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def plain_ids(text):
    return np.array([*tokenizer(PATH).encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("x") for c in ("part", "n", "tail", "rank", "before", "p", "t", "text_key")})


def check(rows, docs, window):
    """Every id lies in one piece, sequences are gapless, and only lengths that need no padding are short."""
    by_sequence, got = defaultdict(list), Counter()
    plain = {(d, zlib.crc32((t or "").encode())): plain_ids(t) for d, t in docs}
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        fits = [k for k, ids in plain.items() if k[0] == r["doc_id"] and len(ids) == r["doc_tokens"]
                and zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]]
        assert fits
        got[r["doc_id"]] += r["length"]
    want = Counter()
    for d, t in docs:
        want[d] += len(plain_ids(t))
    assert got == want
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end == window or end & (end - 1) == 0
    return by_sequence


@pytest.mark.parametrize("window", [2048, 16, 2])
def test_pieces_cover_every_id_once(spark, window):
    rows = packing.pack(frame(spark, TEXTS).repartition(3), PATH, window).collect()
    check(rows, TEXTS, window)


def test_sequences_hold_the_ids(spark):
    docs = frame(spark, TEXTS)
    pieces = packing.pack(docs, PATH, 64).collect()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, text_key long"
    got = {r["sequence_id"]: r for r in packing.sequences(docs, spark.createDataFrame(pieces, schema), PATH, 64, pad=7).collect()}
    assert set(got) == {p["sequence_id"] for p in pieces}
    for p in pieces:
        ids = got[p["sequence_id"]]["ids"][p["offset"]:p["offset"] + p["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == p["ids_crc32"]
    for r in got.values():
        assert len(r["ids"]) == 64 or len(r["ids"]) == r["n_tokens"]
    assert sum(r["n_tokens"] for r in got.values()) == sum(len(plain_ids(t)) for _, t in TEXTS)


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), PATH).collect() == []


def test_combinations_fill_the_window():
    present = np.zeros(64, bool)
    present[[1, 5, 9, 20, 32, 35, 44]] = True
    lengths, repeats = packing.combinations(present, 64)
    assert ((lengths * repeats).sum(1) == 64).all()
    got = {tuple(sorted((s, r) for s, r in zip(a, b, strict=True) if r)) for a, b in zip(lengths.tolist(), repeats.tolist(), strict=True)}
    assert len(got) == len(lengths) and {((32, 2),), ((20, 1), (44, 1)), ((9, 1), (20, 1), (35, 1)), ((5, 4), (44, 1))} <= got


def test_fit_lowers_the_error_and_finds_an_exact_solution():
    present = np.zeros(64, bool)
    present[[10, 20, 22, 27, 32, 44, 54]] = True
    lengths, repeats = packing.combinations(present, 64)
    truth = np.random.default_rng(0).integers(0, 50, len(lengths))
    histogram = np.bincount(lengths.ravel(), (repeats * truth[:, None]).ravel(), 64)
    errors = []
    for rounds in (1, 10, 100, 3000):
        x = packing.fit(lengths, repeats, histogram, rounds)
        assert (x >= 0).all()
        errors.append(float(np.square(np.bincount(lengths.ravel(), (repeats * x[:, None]).ravel(), 64) - histogram).sum()))
    assert errors == sorted(errors, reverse=True) and errors[-1] < 1e-3 * np.square(histogram).sum()


def test_plan_places_every_tail_once_and_cuts_few():
    rng = np.random.default_rng(1)
    histogram = np.bincount(rng.integers(1, 256, 20_000), minlength=256)
    plan = packing.Plan(histogram, 256)
    used = defaultdict(int)
    cut = 0
    for size in range(1, 256):
        rank = np.arange(histogram[size])
        whole, sequence, offset = plan.place(np.full(len(rank), size), rank)
        for w, s, o, r in zip(whole.tolist(), sequence.tolist(), offset.tolist(), rank.tolist(), strict=True):
            for length, s, o in [(size, s, o)] if w else plan.place_cut(size, r):
                bits = ((1 << length) - 1) << o
                assert not used[s] & bits
                used[s] |= bits
            cut += not w
    assert cut < 0.05 * histogram.sum()
    lengths = [b.bit_length() for b in used.values()]
    assert all(b + 1 == 1 << n and (n == 256 or n & (n - 1) == 0) for b, n in zip(used.values(), lengths, strict=True))
    assert sum(lengths) == (histogram * np.arange(256)).sum() and len(used) == plan.sequences


def test_one_length_that_fills_nothing(spark):
    docs = [(i, "word") for i in range(1000)]                       # tails of 2: all whole
    rows = packing.pack(frame(spark, docs), PATH, 16).collect()
    check(rows, docs, 16)
    assert len(rows) == 1000


def test_other_tokenizers_take_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    text = "Some Words, and more words."
    assert not packing.Tokens.of(path).cuttable
    assert packing.Tokens.of(path).encode([text])[0] == np.array(
        tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_cut_texts_give_the_ids_of_whole_ones():
    rng = np.random.default_rng(3)
    alphabet = ["a", "B", "é", " ", "  ", "\n", "\t", "'s", "'", "1", ".", " ", "\x1c", "　", "中", "😀", "́", "<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 30))) for _ in range(3000)]
    assert packing.Tokens.of(PATH).encode(texts) == [
        np.array(e.ids, "<u4").tobytes() for e in tokenizer(PATH).encode_batch(texts, add_special_tokens=False)]


def test_runs_of_marks_are_cut_from_their_words(monkeypatch):
    tokens, whole = packing.Tokens(PATH), []
    encode = tokens._encode
    monkeypatch.setattr(tokens, "_encode", lambda texts: whole.extend(texts) or encode(texts))
    text = "a word.%%% été*** it's% w*'s z,,,,,,,, 1.%%% q--- <|endoftext|> x.%\nline é.% 中%% end.%%%"
    got = np.frombuffer(tokens.encode([text])[0], "<u4")
    assert np.array_equal(got, plain_ids(text)[:-1])
    # A word and its marks are taken apart, what may be a contraction, a number or a token is not.
    assert {" word.%%%", " été***", " z,,,,,,,,", " q---", " end.%%%"}.isdisjoint(whole)
    assert {" it's%", " w*'s", " 1.%%%", " <|endoftext|>"} <= set(whole)
