"""Phrase mining against plain counting."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinark.llm import phrases as P

RNG = np.random.default_rng(0)
WORDS = [*"abcdefgh", "é", "x-y", "12", "中"]


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def counted(docs, longest):
    counts, total = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                counts.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    return counts, total


def plain(docs, min_count, longest=4, share=80, top=2000):
    counts, total = counted(docs, longest)
    found = {p: n for p, n in counts.items() if n >= min_count and len(p) > 2}
    rows = {}
    for p, a in found.items():
        score, _, left, right = min((2_000_000 * a // (counts[p[:k + 1]] + counts[(p[0], *p[k + 1:])]), k,
                                     counts[p[:k + 1]], counts[(p[0], *p[k + 1:])]) for k in range(1, len(p) - 1))
        inside = any(q[0] == p[0] and len(q) > len(p) and 100 * n >= share * a
                     and any(q[i:i + len(p) - 1] == p[1:] for i in range(1, len(q) - len(p) + 2)) for q, n in found.items())
        if not inside:
            rows.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return {(lang, i + 1, phrase.decode(), -a, left, right, total[lang], -score)
            for lang, got in rows.items() for i, (score, a, phrase, left, right) in enumerate(sorted(got)[:top])}


def texts(n, seed):
    rng = np.random.default_rng(seed)
    marks = [" ", "  ", "\t", ". ", ", ", "\n", " ! ", "\x0b", " "]
    docs = []
    for i in range(n):
        w = rng.choice(WORDS, rng.integers(0, 60), p=np.r_[np.full(4, .17), np.full(8, .04)])
        docs.append((i % (n - 3), "".join(str(x).upper() if rng.random() < .2 else str(x) + str(rng.choice(marks, p=[.7, *[.0375] * 8]))
                                          for x in w), [None, "aa", "bb", "b"][i % 4]))
    return docs


def frame(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit(1) for c in ("n", "size", "key", "phrase", "draw", "part", "proposed", "rank")})


EDGE = [(None, None, None), (1, "", "aa"), (2, " ...\n\t", "aa"), (3, "en " * 40, "en"), (4, "word. " * 50, None),
        (5, "one two three four five " * 3000, "bb"), (None, "a b c " * 20, "und"), (6, "A B\x00C " * 31, "cc")]


@pytest.mark.parametrize("sample", [1, 4, 10_000])
def test_counts_are_exact_however_the_sample_falls(spark, sample):
    docs = texts(200, 1) + EDGE
    got = {(r["lang"], *r["phrase"].split(" ")): r["n"] for r in P.frequent_phrases(
        frame(spark, docs), 10, sample=sample, bits=1 << 16).collect()}
    counts, total = counted(docs, 4)
    assert got == {p: n for p, n in counts.items() if n >= 10}


def test_a_full_filter_costs_rows_not_results(spark):
    docs = texts(120, 2)
    got = {(r["lang"], *r["phrase"].split(" ")): r["n"] for r in P.frequent_phrases(
        frame(spark, docs), 12, bits=64).collect()}
    assert got == {p: n for p, n in counted(docs, 4)[0].items() if n >= 12}


@pytest.mark.parametrize("top", [5, 2000])
def test_ranked_collocations(spark, top):
    docs = texts(200, 3) + EDGE
    got = {tuple(r) for r in P.collocations(frame(spark, docs), 10, top=top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}
    assert got == plain(docs, 10, top=top)


def test_tasks_that_pass_on_what_they_hold(monkeypatch):
    monkeypatch.setattr(P, "HELD", 64)
    counter, rng, want, got, sent = P._Counter(), np.random.default_rng(0), Counter(), Counter(), 0
    for i in range(60):
        keys = rng.integers(0, 40, 30).astype(np.uint64)
        want.update((i % 2 + 1, k) for k in keys.tolist())
        for b in [*counter.add(keys, i % 2 + 1), *(counter.rest() if i == 59 else ())]:
            sent += 1
            for key, size, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                got[size, key] += n
    assert got == want and sent > 10


def test_parts_that_pass_on_what_they_hold(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(P, "HELD", 8)
    held = P.Filter(np.full(16, -1, np.int64))
    box = type("Box", (), {"value": held.bytes.view(np.int64)})
    docs = texts(40, 6)
    batch = pa.RecordBatch.from_arrays([pa.array([d[2] or "und" for d in docs]), pa.array([d[1] for d in docs])], ["lang", "text"])
    got = Counter()
    for b in P._expansion_pass(box, box, box, 4)(iter([batch] * 3)):
        got.update({k: n for k, size, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True) if size})
    want = [3 * n for p, n in counted(docs, 4)[0].items() if len(p) > 2]
    assert sorted(got.values()) == sorted(want)


def test_products_beyond_64_bits(spark):
    """Counts whose products pass 64 bits, through the same scoring."""
    big = 9 * 10**18 // 2
    words = spark.createDataFrame([(1, big), (2, big)], "key long, n long")
    phrases = spark.createDataFrame([(3, 2, big - 1, 1, 2, 0), (4, 2, big - 2, 2, 2, 0), (5, 3, (big - 1) // 5 * 4, 3, 4, 0)],
                                    "key long, size int, n long, prefix long, suffix long, lang_key long")
    got = {r["key"]: r["score"] for r in P.scored(words, phrases).collect()}
    three = (big - 1) // 5 * 4
    assert got == {3: 2_000_000 * (big - 1) // (2 * big), 4: 2_000_000 * (big - 2) // (2 * big),
                   5: min(2_000_000 * three // (big + big - 2), 2_000_000 * three // (big - 1 + big))}


def test_empty_table(spark):
    assert P.collocations(frame(spark, [])).collect() == []
