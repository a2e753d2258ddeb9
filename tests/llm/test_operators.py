"""The training-data operators against brute force, round trips and their defined edge cases."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinark.llm import (contamination, language, lm_score, mixing, near_dup, quality, suffix_dedup, topk, toxicity,
                         warc)
from clinark.llm.components import components

RNG = np.random.default_rng(0)
VOCAB = ["".join(RNG.choice(list("abcdefghijklmnop"), RNG.integers(2, 8))) for _ in range(400)]
EXTRA = {"key": "k", "label": 1, "spans": "s", "rep": 2, "size": 3, "block": 4, "score": 0.5, "n": 5, "group": 6}


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCAB, n))


BASE = prose(300, 1)
NEAR = BASE + " " + prose(12, 2)
LONG = prose(40_000, 3)
EDGE = [(None, None), (1, ""), (2, "!!! 123 ..."), (3, LONG), (4, BASE), (4, BASE), (5, BASE), (6, NEAR), (7, "one two"),
        (8, None), (9, "Ünïcode wörds " * 60), (10, "x" * 900)]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({"lang": F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb"), "source": F.lit("s")})
    return df.withColumns({k: F.lit(v) for k, v in EXTRA.items()}) if extra else df


@pytest.fixture(scope="module")
def edge(spark):
    return frame(spark, EDGE)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def test_warc_round_trip(spark):
    rows = [(1, "http://a b\r\n", "<p>é</p>"), (2, None, None), (3, "u", "<p>é</p>"), (4, "u", ""), (1, "v", "<p>é</p>"),
            (None, "w", "<p>é</p>"), (9, "z", "y" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {"first": F.lit(1), "sha": F.lit("x"), "refers_to": F.lit(7)})
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == Counter([(1, "response", None), (1, "response", None), (2, "response", None), (3, "revisit", 1),
                             (4, "revisit", 2), (None, "revisit", 1), (9, "response", None)])
    for r in got:
        html = {9: "y" * 300_000, 2: "", 4: ""}.get(r["page_id"], "<p>é</p>").encode()
        assert r["payload_bytes"] == len(html) and r["payload_digest"] == warc.base32_sha1(html)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_warc_reader_rejects_damage():
    record = warc.record_bytes(1, "u", b"body", None)
    assert warc.parse_record(record)["payload"] == b"body"
    for bad in (record[:-1], record.replace(b"Content-Length: 4", b"Content-Length: 5"), record.replace(b"body", b"bodx"),
                record.replace(b"WARC-Date", b"WARC-Dat"), b"junk"):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    dictionary = warc.make_dictionary([record] * 3)
    import struct

    import zstandard
    frame_ = zstandard.ZstdCompressor(dict_data=dictionary).compress(record)
    body = dictionary.as_bytes()
    archive = struct.pack("<II", warc.DICTIONARY_MAGIC, len(body)) + body + frame_ + warc.SEPARATOR.encode() + frame_
    assert len(list(warc.read_archive(archive))) == 2
    for bad in (archive[:-3], archive[:20], b"abcdefghij"):
        with pytest.raises(ValueError):
            list(warc.read_archive(bad))


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6) * (rng.random(6) < 0.6)]) for i in range(260)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")]), (5, rows[5][1]), (400, [0.5, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {"stripe": F.lit(1), "ids": F.lit("x"), "rank": F.lit(2)})
    q = topk.quantised(df)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(q.where("vec_id % 100 = 0"), q).collect()}
    clean = {i: np.pad(np.floor(1024 * np.float64(np.float32(v))).astype(int), (0, 6 - len(v))) for i, v in rows[:260] + rows[-1:]}
    for query in (0, 100, 200, 400):
        best = sorted((-int(clean[query] @ v), i) for i, v in clean.items() if i != query)[:10]
        assert [got[query, r + 1] for r in range(10)] == [(i, -s) for s, i in best]
    assert len(got) == 40 and topk.top_k(q.limit(0), q.limit(0)).count() == 0


def brute_components(rows, percent=85):
    sets = []
    for _, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = [w for w in low.replace("\t", " ").replace("\n", " ").split(" ") if w]
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    label = [i for i, _ in rows]
    for _ in rows:
        for x, a in enumerate(sets):
            for y, b in enumerate(sets):
                if a and 100 * len(a & b) >= percent * len(a | b):
                    label[x] = label[y] = min(label[x], label[y])
    return {rows[x][0]: (len(s), label[x]) for x, s in enumerate(sets)}


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_MEMBERS", 4)
    rng = np.random.default_rng(7)
    rows = [(i, prose(60, i)) for i in range(20)]
    for i in range(20, 70):
        words = BASE.split()[:120]
        for at in rng.choice(120, rng.integers(0, 6), replace=False):
            words[at] = VOCAB[rng.integers(400)]
        rows.append((i, " ".join(words).upper() if i % 9 == 0 else " ".join(words)))
    got = by_id(near_dup.near_duplicates(frame(spark, rows)))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_components(rows)


def test_bands_follow_the_wanted_similarity():
    assert near_dup.bands_for(85) == near_dup.BANDS == 25
    for percent in (50, 70, 80, 85, 95, 100):
        assert (1 - (percent / 100) ** near_dup.ROWS) ** near_dup.bands_for(percent) <= near_dup.MISS


def test_pipeline_drops_near_copies_from_080(spark, tmp_path):
    import corpus_pipeline
    rows = [(i, prose(200, i)) for i in range(12)]
    for at in (3, 4, 8):                     # one, two and four words changed: 191/201, 186/206 and 176/216 = 0.81
        words = rows[at][1].split()
        for place in range(20, 20 + 40 * min(at // 2, 4), 40):
            words[place] = "qqqq"
        rows.append((100 + at, " ".join(words)))
    words = rows[5][1].split()
    for place in range(10, 190, 36):         # five words: 171/221 = 0.77 stays
        words[place] = "qqqq"
    rows.append((105, " ".join(words)))
    kept = corpus_pipeline.near_dedup(spark, frame(spark, rows), str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == set(range(12)) | {105}


def test_near_duplicate_edges(edge, none):
    rows = near_dup.near_duplicates(edge).collect()
    assert len(rows) == len(EDGE)
    got = {r["doc_id"]: r for r in rows}
    assert got[5]["component_id"] == got[6]["component_id"] == 4 and not got[5]["kept"] and got[4]["kept"]
    assert got[1]["n_shingles"] == got[8]["n_shingles"] == 0 and got[8]["component_id"] == 8
    assert got[7]["n_shingles"] == 1 and got[None]["component_id"] is None and got[None]["kept"]
    assert near_dup.near_duplicates(none).count() == 0


def test_sketch_fills_every_coordinate():
    for n in (1, 2, 7, 5000):
        hashes = np.sort(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
        assert (near_dup.sketch(hashes, np.array([0, n])) != near_dup._EMPTY).all()


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def brute_repeats(rows, length=400):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[s:s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if seen[t[s:s + length]] > 1:
                gone[s:s + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) > 0).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 2, 0])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 3000)
    rng = np.random.default_rng(11)
    rows = [(i, prose(150, 900 + i)) for i in range(6)]
    for i in range(12):                      # shared passages with edits at random places, cut at random ends
        part = list(BASE[rng.integers(0, 300):rng.integers(900, len(BASE))])
        for at in rng.choice(len(part), rng.integers(0, 3)):
            part[at] = "é"
        rows.append((20 + i, prose(30, i) + "".join(part) + prose(20, 50 + i)))
    rows += [(50, "ab" * 700), (51, None), (52, ""), (53, "x" * 400), (53, "x" * 400), (None, prose(90, 0))]
    rows += [(None, prose(90, 1))] * 3       # equal rows without an id: their spans are gathered once
    got = suffix_dedup.dedup_text(frame(spark, rows)).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == brute_repeats(rows)
    cut = suffix_dedup.cut_text(frame(spark, rows))
    assert cut.columns == frame(spark, rows).columns and cut.count() == len(rows)


def brute_passages(texts, words):
    """Texts without what repeats as ``words`` words or as 400 bytes."""
    def windows(t):
        at = [m.span() for m in re.finditer(rb"[^ \t-\r]+", t)]
        yield from ((a, b) for (a, _), (_, b) in zip(at, at[words - 1:], strict=False))
        yield from ((s, s + 400) for s in range(len(t) - 399))
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[a:b] for t in texts for a, b in set(windows(t)))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for a, b in windows(t):
            if seen[t[a:b]] > 1:
                gone[a:b] = True
        out.append(bytes(np.frombuffer(t, np.uint8)[~gone]).decode("utf-8", "ignore"))
    return out


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 2, 0])
def test_passages_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rng = np.random.default_rng(13)
    short = " ".join(rng.choice(["a", "bc", "de", "fgh", "ij"], 53))
    rows = [(i, prose(120, 700 + i)) for i in range(6)]
    for i in range(14):                      # passages of 45 to 70 words in different surroundings
        a = int(rng.integers(0, 60))
        words = BASE.split()[a:a + int(rng.integers(45, 70))]
        if i % 4 == 0:
            words[int(rng.integers(len(words)))] += "\n"
        rows.append((20 + i, f"{prose(30, i)}  {' '.join(words)}\t{prose(20, 50 + i)}"))
    rows += [(60 + i, f"{prose(40, 300 + i)} {short} {prose(40, 400 + i)}") for i in range(3)]
    rows += [(70, "é" + short[1:]), (71, None), (72, ""), (73, "x" * 900), (None, prose(70, 0)), (None, prose(70, 0))]
    cut = suffix_dedup.cut_text(frame(spark, rows), 51).collect()
    want = brute_passages([t for _, t in rows], 51)
    assert sorted(r["text"] or "" for r in cut) == sorted(want)


def test_pipeline_cuts_passages_of_51_words(spark, tmp_path):
    import corpus_pipeline
    passage = " ".join(np.random.default_rng(5).choice([w for w in VOCAB if len(w) < 5], 51))
    assert len(passage) < 300
    rows = [(i, f"{prose(60, i)} {passage} {prose(60, 90 + i)}") for i in (1, 2)]
    rows += [(i, f"{prose(60, i)} {passage.rsplit(' ', 1)[0]} {prose(60, 90 + i)}") for i in (3,)]
    got = by_id(corpus_pipeline.suffix_array_dedup(spark, frame(spark, rows), str(tmp_path)))
    assert got[1]["text"] == f"{prose(60, 1)}  {prose(60, 91)}" and got[2]["text"] == f"{prose(60, 2)}  {prose(60, 92)}"
    assert got[3]["text"] == rows[2][1]


def test_deep_shallow_sorts_like_python():
    rng = np.random.default_rng(2)
    strings = [bytes(rng.integers(97, 99, rng.integers(0, 12)).astype(np.uint8)) for _ in range(300)]
    strings += [b"z" * 60 + s for s in strings] + [b"", b"\0", b"\0\0"]
    groups = rng.integers(0, 3, len(strings))
    order = suffix_dedup.deep_shallow(strings, groups)
    assert [(groups[i], strings[i]) for i in order] == sorted(zip(groups, strings, strict=True))


def test_contamination_phrases_blocks_and_proximity(spark, edge, none, monkeypatch):
    items = spark.createDataFrame([("b", prose(40, 4)), ("a", BASE[:200]), ("c", "One, TWO"), ("d", None), ("e", "?!")],
                                  "item_id string, text string").withColumn("shard", F.lit(1))
    found = {r["doc_id"]: r for r in contamination.contamination(edge, items).collect()}
    assert len(found) == len({i for i, _ in EDGE})
    assert found[4]["items"] == ["a"] and found[7]["items"] == ["c"] and found[7]["n_hit"] == 2
    assert found[1]["n_words"] == found[8]["n_words"] == 0 and found[3]["n_hit"] == 0
    inside = set()
    item, doc = BASE[:200].split(), BASE.split()
    grams = {tuple(item[i:i + 10]) for i in range(len(item) - 9)}
    for i in range(len(doc) - 9):
        if tuple(doc[i:i + 10]) in grams:
            inside.update(range(i, i + 10))
    assert found[4]["n_hit"] == len(inside)
    monkeypatch.setattr(contamination, "BLOCK_WINDOWS", 3)
    again = {r["doc_id"]: r for r in contamination.contamination(edge, items).collect()}
    assert all(again[i]["n_hit"] == r["n_hit"] and again[i]["items"] == r["items"] for i, r in found.items())
    near = spark.createDataFrame([("n", "one big two")], "item_id string, text string")
    one = frame(spark, [(1, "one really two big"), (2, "one big two")])
    assert [r["n_hit"] for r in contamination.contamination(one, near).orderBy("doc_id").collect()] == [0, 3]
    assert contamination.contamination(one.withColumn("text", F.lit("one big and two")), near, slop=1).where("n_hit > 0").count() == 2
    assert contamination.contamination(none, items).count() == 0
    assert contamination.contamination(edge, items.limit(0)).where("n_hit > 0").count() == 0


def test_mixing_targets_and_quotas(spark, edge, none):
    target = mixing.targets([("a", 10), ("b", 1000), (None, 500), ("c", 0)])
    assert target["a"] == 30 and target["c"] == 0 and sum(target.values()) == pytest.approx(1510)
    draws = np.array([5, 0, 700, 31])
    quotas = mixing.split_quotas(draws, 7)
    assert (quotas.sum(axis=0) == draws).all() and quotas.sum(axis=1).max() - quotas.sum(axis=1).min() <= 3
    rows = frame(spark, [(i, prose(20 + i % 50, i)) for i in range(300)]).withColumn(
        "source", F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") < 12, "tiny").otherwise("big"))
    mixed = mixing.mixture(rows, shards=4)
    got = mixed.collect()
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == sum(d["words"] for d in r["draws"])
        own = by.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        own[0], own[1] = own[0] + r["taken"], own[1] + r["size"]
    assert all(abs(t - g) < 1 and s == n for t, s, g, n in by.values()) and len(got) == 300
    assert sorted(got, key=lambda r: r["doc_id"]) == sorted(mixing.mixture(rows, shards=4).collect(), key=lambda r: r["doc_id"])
    assert mixing.mixture(edge).count() == len(EDGE) and mixing.mixture(none).count() == 0


def test_viterbi_equals_brute_force():
    from itertools import product
    rng = np.random.default_rng(4)
    bounds = np.array([0, 5, 5, 6, 11])
    emission = rng.normal(0, 4, (11, 3)).astype(np.float32)
    path = language.viterbi(emission, bounds, 3.0)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        value = lambda p, a=a: sum(emission[a + i, s] for i, s in enumerate(p)) - 3.0 * sum(x != y for x, y in zip(p, p[1:]))
        assert value(tuple(path[a:b])) == pytest.approx(max(map(value, product(range(3), repeat=int(b - a)))), abs=1e-4)


def test_language_spans_and_edges(spark, edge, none):
    german, english = "der und nicht eine schön", "the and with this there"
    train = frame(spark, [(i, (german if i % 2 else english) * 8) for i in range(60)])
    model = language.learn(train)
    got = by_id(language.predict(frame(spark, [(1, f"{english} {english} {german} {german}"), (2, "λόγος"), (3, None), (4, "12 %"),
                                               (5, english)]), model))
    assert [s["lang"] for s in got[1]["spans"]] == ["aa", "bb"] and got[5]["lang_pred"] == "aa" and got[5]["score"] == 1
    assert got[3]["lang_pred"] == got[4]["lang_pred"] == "und" and got[2]["lang_pred"] in ("aa", "bb")
    assert language.predict(edge, language.learn(edge)).count() == len(EDGE)
    assert language.predict(edge, language.learn(none)).where("lang_pred <> 'und'").count() == 0
    assert language.keep_rows(edge, model, 0.5).columns == edge.columns


@pytest.mark.parametrize("module,column", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_learn_and_keep_edges(spark, edge, none, module, column):
    bad = lambda i: " ".join(w.upper() + "!!" for w in prose(40, i).split()) + " vekul scum"
    ids = list(range(160))
    docs = frame(spark, [(i, bad(i) if i % 2 else prose(40, i)) for i in ids])
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in ids if i < 120] + [(None, 1, 1), (3, 1, None)],
                                   "doc_id long, quality int, toxic int")
    model = module.learn(docs, labels, F.lit(True))
    got = by_id(module.score(docs, model))
    assert all((got[i]["score"] > 0.5) == bool(i % 2) for i in range(120, 160))
    assert module.score(edge, model).where("score between 0 and 1").count() == len(EDGE)
    empty = module.learn(docs, labels.limit(0), F.lit(True))
    assert module.score(edge, empty).where("score between 0 and 1").count() == len(EDGE)
    assert module.score(none, model).count() == 0


def test_label_model_discounts_copied_voters():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 4000)
    vote = lambda p: np.where(rng.random(4000) < p, 2 * y - 1, 1 - 2 * y)
    weak = vote(0.6)
    votes = np.stack([vote(0.85), weak, weak, weak], axis=1)
    q, say, corr = toxicity.label_model(votes, rng.integers(0, 2, 4000))
    assert corr[1, 2] > 0.9 and abs(corr[0, 1]) < 0.3 and say.shape == (3, 2, 4)


def test_lm_scores_and_gradient(spark, edge, none):
    weights = lm_score.new_weights()
    rng = np.random.default_rng(0)
    around, target = rng.integers(0, lm_score.CLASSES, (64, 4)), rng.integers(0, lm_score.CLASSES, 64)
    before = lm_score.class_log_probs(weights, around, target).mean()
    for _ in range(50):
        lm_score.descend(weights, around, target, 0.5)
    assert lm_score.class_log_probs(weights, around, target).mean() > before
    assert np.allclose(lm_score.unflat(lm_score.flat(weights))["out"], weights["out"])
    docs = frame(spark, [(i, prose(80, i % 40)) for i in range(200)])
    model = lm_score.learn(docs)
    got = by_id(lm_score.pseudo_likelihood(edge, model))
    assert got[1]["n_tokens"] == 0 and got[1]["log_likelihood"] == 0 and got[8]["mean_log_prob"] is None
    assert got[4]["log_likelihood"] < 0 and lm_score.pseudo_likelihood(none, lm_score.learn(none)).count() == 0
    weights, cls, log_p = model
    tokens, bounds = lm_score.buckets_of(np.frombuffer(BASE.encode(), np.uint8), np.array([0, len(BASE.encode())]))
    each = lm_score.class_log_probs(weights, lm_score.windows(cls[tokens], bounds), cls[tokens]) + log_p[tokens]
    assert got[4]["log_likelihood"] == pytest.approx(each.sum())


def test_lm_trains_on_every_document(spark):
    for text in ("aa bb cc dd " * 50, "ee ff gg hh " * 50, "ii jj kk ll " * 50, "mm nn oo pp " * 50):
        weights = lm_score.learn(spark.createDataFrame([(1, text)], "doc_id long, text string"))[0]
        assert not np.allclose(lm_score.flat(weights), lm_score.flat(lm_score.new_weights()))


def test_lm_counts_every_token(spark):
    words = [f"w{i}" for i in range(70_000)]
    docs = spark.createDataFrame([(i, " ".join(words[i * 700:(i + 1) * 700] * (2 if i < 50 else 1))) for i in range(100)],
                                 "doc_id long, text string")
    cls, log_p = lm_score.learn(docs, rounds=0)[1:]
    assert log_p.table.count() == 70_000 - lm_score.OWN
    data = " ".join(["w7", "w69999", "neverseen"]).encode()
    tokens, _ = lm_score.buckets_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    want = [n + lm_score.SMOOTH for n in (2, 1, 0)] / log_p.mass[cls[tokens]]
    shared = cls[tokens] >= lm_score.OWN
    assert shared[1:].all() and np.allclose(log_p[tokens], np.where(shared, np.log(want), 0))
    # In every shared class the counted tokens and the unknown one make 1.
    rows = log_p.joined(log_p.table.select("token")).groupBy(lm_score.shared_class("token").alias("c")).agg(F.sum(F.exp("log_p")).alias("p"))
    assert all(r["p"] + lm_score.SMOOTH / log_p.mass[r["c"]] == pytest.approx(1) for r in rows.collect())


def plain_lm(weights, around):
    """(embeddings, hidden layer, class probabilities) of windows by float64 formulas."""
    w = {k: v.astype(float) for k, v in weights.items()}
    x = w["embed"][around].reshape(len(around), -1)
    h = np.tanh(x @ w["hidden"] + w["hidden_bias"])
    z = h @ w["out"][:-1] + w["out"][-1]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return x, h, p / p.sum(axis=1, keepdims=True)


@pytest.mark.parametrize(("n", "scale"), [(256, 1), (255, 1), (1, 1), (64, 400)])
def test_lm_step_is_the_plain_gradient(n, scale):
    rng = np.random.default_rng(n)
    weights = lm_score.new_weights()
    weights["out"] *= np.float32(scale)                   # at 400 exp of a score would be infinite
    weights["out"][-1] = rng.normal(size=lm_score.CLASSES)
    around, target = rng.integers(0, lm_score.CLASSES + 1, (n, 4)), rng.integers(0, lm_score.CLASSES, n)
    x, h, p = plain_lm(weights, around)
    own = p[np.arange(n), target]
    some = own > 1e-30
    got = lm_score.class_log_probs(weights, around, target)
    assert np.isfinite(got).all() if scale == 1 else not np.isnan(got).any()
    assert np.allclose(got[some], np.log(own[some]), rtol=1e-4, atol=1e-4)
    before = {k: v.astype(float) for k, v in weights.items()}
    p[np.arange(n), target] -= 1
    p *= 0.2 / n
    back = (p @ before["out"][:-1].T) * (1 - h * h)
    into = (back @ before["hidden"].T).reshape(n, 4, -1)
    embed = before["embed"].copy()
    np.subtract.at(embed, around, into)
    lm_score.descend(weights, around.astype(np.uint8), target.astype(np.uint8), 0.2, lm_score.Room())
    want = {"embed": embed, "hidden": before["hidden"] - x.T @ back, "hidden_bias": before["hidden_bias"] - back.sum(0),
            "out": before["out"] - np.concatenate([h.T @ p, p.sum(0)[None]])}
    assert all(np.allclose(weights[k], want[k], rtol=1e-4, atol=1e-4) for k in want)


def test_lm_joins_a_groups_tokens_once(spark, monkeypatch):
    """Rows of one group share one list of tokens; scores do not depend on where groups and chunks end."""
    docs = frame(spark, [(i, prose(60, i % 9) if i % 7 else None) for i in range(120)] + [(None, "one"), (5, "")]).coalesce(1)
    weights, cls, log_p = model = lm_score.learn(docs)
    rows = lm_score.class_rows(docs, cls)
    words = {w.lower() for r in docs.collect() for w in (r["text"] or "").split()}
    shared = [t for w in words for t in lm_score.buckets_of(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))[0]
              if cls[np.array([t])][0] >= lm_score.OWN]
    assert sorted(r["t"] for r in rows.select(F.explode("tokens").alias("t")).collect()) == sorted(shared)
    assert [len(r["classes"]) for r in rows.orderBy("group", "chunk").collect()].count(0) == 19
    one = sorted(map(tuple, lm_score.score_rows(rows, weights, log_p).collect()), key=str)
    for doc_id, n, total, mean in one:
        assert (n == 0 and total == 0 and mean is None) or mean == pytest.approx(total / n)
    monkeypatch.setattr(lm_score, "GROUP", 1500)
    many = sorted(map(tuple, lm_score.pseudo_likelihood(docs, model).collect()), key=str)
    assert lm_score.class_rows(docs, cls).select("group").distinct().count() > 5
    assert len(one) == len(many) == 122
    for a, b in zip(sorted(one, key=lambda r: (str(r[0]), r[2])), sorted(many, key=lambda r: (str(r[0]), r[2]))):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2])


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    rows = [(i, prose(200, i)) for i in range(30)] + [(100, prose(200, 3)), (101, "12 34"), (102, None)]
    docs = frame(spark, rows, extra=False).withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("q", " ".join(prose(200, 5).split()[20:40]))], "item_id string, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(range(30)) - {5} and all(r["size"] == 200 for r in got.values())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_array_dedup", "decontaminate", "mix"]


def test_near_dup_rows_that_repeat_an_id_lose_no_link(spark):
    """Two rows of one id link to different documents: all are one component."""
    a, b = prose(300, 31), prose(300, 32)
    rows = [(1, a), (2, b), (2, a + " z"), (3, b + " z"), (4, prose(300, 33)), (4, prose(300, 34)), (4, "")]
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(frame(spark, rows)).collect()]
    assert sorted(got) == [(1, 1, True), (2, 1, False), (2, 1, False), (3, 1, False), *[(4, 4, True)] * 3]
    apart = near_dup.near_duplicates(frame(spark, rows), by_id=False).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept_row"]) for r in apart if r["doc_id"] < 4) == [
        (1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False)]
    assert all(r["kept_row"] for r in apart if r["doc_id"] == 4)


def test_suffix_text_without_strings_and_passages(spark):
    passage, long = prose(60, 41), prose(200, 42)
    short = " ".join(w[:2] for w in passage.split())                  # 60 words under 400 bytes
    rows = [(1, prose(30, 43) + " " + short + " " + prose(30, 44)), (2, prose(30, 45) + " " + short + " " + prose(30, 46)),
            (3, prose(20, 47) + " " + long), (4, prose(20, 48) + " " + long), (5, prose(80, 49)), (6, None), (None, "x")]
    plain = {r["doc_id"]: r for r in suffix_dedup.dedup_text(frame(spark, rows)).collect()}
    got = {r["doc_id"]: r for r in suffix_dedup.dedup_text(frame(spark, rows), 51).collect()}
    assert len(short) < 400 and set(got) == set(plain)
    for k, r in got.items():
        assert all(r[c] == plain[k][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256"))
    assert plain[1]["n_removed"] == 0 and short not in got[1]["text"] and short not in got[2]["text"]
    assert prose(30, 43) in got[1]["text"] and got[5]["text"] == prose(80, 49)
    assert long not in got[3]["text"] and got[6]["text"] is None and got[None]["text"] == "x"


def test_suffix_cut_keeps_columns_of_any_name(spark):
    rows = [(1, prose(20, 51) + prose(120, 52)), (2, prose(20, 53) + prose(120, 52))]
    odd = {c: F.lit(c) for c in ("_r_id", "_r_key", "_spans", "spans", "_", "__id")}
    got = suffix_dedup.cut_text(frame(spark, rows).withColumns(odd), 51).collect()
    assert len(got) == 2 and all(r[c] == c for r in got for c in odd) and all(len(r["text"]) < 300 for r in got)


def test_pipeline_stages_on_odd_tables(spark, tmp_path):
    """Columns of every own name, repeated ids, an empty table: each stage but the last keeps the columns."""
    import corpus_pipeline
    spark.createDataFrame([(1, "no document holds these ten words of an item here")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    names = ("row", "doc", "key", "place", "nth", "d", "k", "hit", "_id", "_row", "_r_id", "_spans", "text_key", "one", "first")
    rows = [(1, BASE), (2, BASE), (2, LONG), (3, LONG), (3, LONG), (4, prose(200, 61)), (4, prose(200, 62)), (None, BASE), (5, None)]
    for table in (rows, []):
        docs = frame(spark, table, extra=False).withColumns({c: F.lit(c) for c in names})
        kept = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns
        got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
        want = [(1, BASE), (2, LONG), (4, prose(200, 61)), (4, prose(200, 62)), (None, BASE), (5, None)] if table else []
        assert got == sorted(want, key=str)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            assert all(r[c] == c for r in out.collect() for c in names), name
        assert corpus_pipeline.mix(spark, docs, str(tmp_path)).count() == len(table)


def test_mixing_shards_are_disjoint_draws_by_exact_quotas(spark, tmp_path):
    """The written shards: the tree's quotas, every draw once, each shard in shuffled order, their sums what the
    mix takes."""
    rows = [(i, prose(3 + i % 40, i)) for i in range(600)] + [(7, "repeated id"), (None, "no id"), (601, None)]
    docs = frame(spark, rows, extra=False).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "a").when(
        F.col("doc_id") % 3 == 1, "b"))
    mixed = mixing.mixture(docs, shards=8, blocks=32).persist()
    path = str(tmp_path / "shards")
    mixing.write_shards(mixed, path, "doc_id", "source")
    draws = spark.read.parquet(path).collect()
    every = [(d["shard"], d["order_key"], d["words"], d["epoch"]) for r in mixed.collect() for d in r["draws"]]
    assert sorted((d["shard"], d["order_key"], d["words"], d["epoch"]) for d in draws) == sorted(every)
    # A block's draw of an epoch lies in one shard, and each shard holds its quota of the sources' block draws.
    blocks = spark.createDataFrame([(d["shard"], d["source"], d["epoch"], d["doc_id"]) for d in draws],
                                   "shard int, source string, epoch long, doc_id long")
    key = F.pmod(F.xxhash64(F.lit(mixing.SEED + 1), "doc_id"), F.lit(32))
    placed = blocks.withColumn("block", key).select("shard", "source", "epoch", "block").distinct()
    assert placed.groupBy("source", "epoch", "block").count().where("count > 1").isEmpty()
    counts = Counter((r["source"], r["shard"]) for r in placed.collect())
    names = sorted({s for s, _ in counts}, key=lambda s: (s is None, s or ""))
    total = np.array([sum(n for (s, _), n in counts.items() if s == name) for name in names])
    assert total.sum() > 32
    sums = np.array([sum(counts[s, shard] for s in names) for shard in range(8)])
    assert sums.max() - sums.min() <= 3                      # even shards: block draws of wordless parts are not written
    # Files of a shard are in the order of their keys, which is not that of the documents.
    for file in (tmp_path / "shards").rglob("*.parquet"):
        got = spark.read.parquet(str(file)).select("order_key", "doc_id").collect()
        assert [r["order_key"] for r in got] == sorted(r["order_key"] for r in got)
        if len(got) > 20:
            assert [r["doc_id"] for r in got] != sorted((r["doc_id"] for r in got), key=lambda x: (x is None, x))
    # What the shards hold is what the mix takes.
    want = sorted((r["doc_id"], r["source"], r["size"], r["taken"]) for r in mixed.where("doc_id is not null").collect())
    got = mixing.taken_from_shards(mixed).where("doc_id is not null").collect()
    assert sorted((r["doc_id"], r["source"], r["size"], r["taken"]) for r in got) == want
    assert all(len(r["shards"]) == (r["taken"] > 0) + 0 or r["taken"] > r["size"] or r["shards"] for r in got)
    mixing.shard_texts(docs.where("doc_id < 600 and doc_id <> 7"), mixed.where("doc_id <> 7"), str(tmp_path / "texts"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "texts")).collect()}
    assert texts and all(texts[i] == dict(rows)[i] for i in texts)


def test_mixing_targets_against_plain_resharing():
    """Targets by a plain loop over shares, on random sizes."""
    rng = np.random.default_rng(4)
    for _ in range(200):
        names = [*(f"s{i}" for i in range(int(rng.integers(1, 9)))), None]
        sizes = [(n, int(rng.integers(0, 10 ** int(rng.integers(1, 6))))) for n in names]
        order = sorted(names, key=lambda x: (x is None, x or ""))
        weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(order)}
        size, left, fixed = dict(sizes), float(sum(n for _, n in sizes)), {}
        while True:
            free = [n for n in order if n not in fixed]
            share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
            over = [n for n in free if share[n] > 3 * size[n]]
            if not over:
                break
            fixed.update({n: 3.0 * size[n] for n in over})
            left = sum(size.values()) - sum(fixed.values())
        want = fixed | share
        got = mixing.targets(sizes)
        assert all(abs(got[n] - want[n]) < 1e-6 * max(1, want[n]) for n in names)


def _plain_log_odds(model, text):
    """The network by loops over places, chunks and filters."""
    raw = text.encode()
    places = max(-(-len(raw) // quality.STRIDE), 1)
    raw = raw + b"\0" * (places * quality.STRIDE + quality.WIDTH - len(raw))
    sums = [[sum(model["tables"][j][raw[p * quality.STRIDE + j]][f] for j in range(quality.WIDTH))
             for f in range(model["tables"].shape[2])] for p in range(places)]
    step, width = quality.CHUNK_STEP // quality.STRIDE, quality.CHUNK // quality.STRIDE
    starts = [0]
    while starts[-1] + width < places:
        starts.append(starts[-1] + step)
    pools = np.tanh([[max(s[f] for s in sums[a:a + width]) for f in range(len(sums[0]))] for a in starts])
    return np.concatenate([pools.mean(axis=0), pools.max(axis=0)]) @ model["out"] + model["bias"][0]


def _small_network(filters=3):
    rng = np.random.default_rng(9)
    return {"tables": rng.normal(0, 0.3, (quality.WIDTH, 256, filters)), "out": rng.normal(0, 1, 2 * filters),
            "bias": rng.normal(0, 1, 1)}


QUALITY_TEXTS = ["", "a", "four", "éé", prose(50, 71), prose(200, 72), "x" * 513, "y" * 896, "z" * 897]


def test_quality_forward_is_one_for_training_and_scoring():
    """Scores and training losses equal plain loops, on texts shorter and longer than a chunk."""
    model = _small_network()
    data = np.frombuffer("".join(QUALITY_TEXTS).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in QUALITY_TEXTS])])
    want = np.array([_plain_log_odds(model, t) for t in QUALITY_TEXTS])
    pools, bounds = quality.pooled(data, offsets, model["tables"])
    assert np.allclose(quality.document_vectors(pools, bounds) @ model["out"] + model["bias"], want, atol=1e-5)
    y = np.arange(len(QUALITY_TEXTS)) % 2
    _, loss = quality.gradients(model, data, offsets, y)
    assert abs(loss - np.mean(np.logaddexp(0, want) - y * want)) < 1e-5


def test_quality_gradient_is_the_numeric_one(monkeypatch):
    monkeypatch.setattr(quality, "responses", lambda raw, tables: sum(
        tables[j][raw[j:j + (len(raw) - quality.WIDTH) // quality.STRIDE * quality.STRIDE:quality.STRIDE]]
        for j in range(quality.WIDTH)))                    # in double precision
    model = _small_network()
    data = np.frombuffer("".join(QUALITY_TEXTS).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in QUALITY_TEXTS])])
    y = np.arange(len(QUALITY_TEXTS)) % 2
    grad, _ = quality.gradients(model, data, offsets, y)
    rng, seen = np.random.default_rng(2), 0
    for name, value in model.items():
        flat, g = value.reshape(-1), grad[name].reshape(-1)
        places = np.flatnonzero(g) if name == "tables" else np.arange(len(flat))
        for i in rng.choice(places, min(40, len(places)), replace=False):
            old, losses = flat[i], []
            for h in (1e-6, -1e-6):
                flat[i] = old + h
                losses.append(quality.gradients(model, data, offsets, y)[1])
            flat[i] = old
            assert abs((losses[0] - losses[1]) / 2e-6 - g[i]) < 1e-5
            seen += 1
    assert seen > 40


def test_quality_learns_from_whole_texts(spark):
    """What tells the classes apart stands only at the ends of long texts."""
    rows = [(i, prose(900, 500 + i) + (" GOOD" if i % 2 else " bad!") * 8) for i in range(40)]
    docs = frame(spark, rows, extra=False)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = quality.learn(docs, labels, F.lit(True), epochs=30)
    got = by_id(quality.score(docs, model))
    assert all((got[i]["score"] > 0.5) == bool(i % 2) for i in range(40))
