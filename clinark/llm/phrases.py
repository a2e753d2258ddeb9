"""Phrase collocations by Toivonen's sampling (op 13).

Phrases are 2 to ``LONGEST`` words within a piece of text, per language; frequent are those with
``MIN_COUNT`` occurrences, and so are then all their parts.

1. Sample. A hashed share of the documents, ``SAMPLE``, proposes phrases: words, then phrases of
   such words with the keys of their two parts, with a lowered threshold.
2. Full pass. Every word, every proposed phrase and every phrase of the negative border (not
   proposed, but both its parts, without the last word and without the first, are) is counted over
   all documents. As 64-bit keys, first combined per task.
3. Expansion. Where the border failed (a phrase is frequent that was not proposed), a further pass
   gives its parts and counts the phrases that only now have both; it is repeated until no such
   phrase is frequent, and then the result is closed.
4. Scores. Every cut of a phrase joins the counts of its two parts; phrases inside a longer one
   with ``SHARE`` percent of their count are dropped (a longer one that holds more words occurs no
   more often than one with one word more); the best of each language are ranked, first within
   hashed parts of it, so that no task gets all phrases of a language.
5. Naming. Up to here phrases are 64-bit keys of language and words. A last pass finds the texts of
   the best ones, ties included, and ranks those by text. Two different phrases would have to
   agree in all 64 bits to be taken for one; a key that turns out to have two texts is an error.

Tasks know the proposed phrases by a Bloom filter of ``BITS`` bits, whatever the corpus. What it lets
through by mistake is counted as well and falls under the threshold, so it costs shuffled rows, never
results; raise BITS with the corpus.

Defined cases: a NULL text has no words, a NULL lang is ``und``; rows that repeat a doc_id are
documents of their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinark.llm.common import (arrow_schema, chunks, lower_ascii, mix, prefix_hash, read_table, span_hash, stored,
                                text_bytes, word_spans)

MIN_COUNT = 30
LONGEST = 4
SHARE = 80
TOP = 2000
SAMPLE = 8                    # one in SAMPLE documents, by hash, is in the sample
BITS = 1 << 26
#: Keys of a size that a task holds before it passes them on.
HELD = 1 << 20
CHUNK = 1 << 19
PARTS = 64
SCORE = 2_000_000
_SHIFTS = (0, 19, 38)
_NEXT = np.uint64(0x9E3779B97F4A7C15)

#: Fixed values of the contract: bytes that end a piece, and blanks between words.
_STOP = np.zeros(256, bool)
_STOP[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_STOP
_WORD[[0x20, 0x09]] = False

_KEYS = "key long, size int, n long"
_PHRASES = "key long, size int, n long, prefix long, suffix long, lang_key long"
_NAMES = "key long, lang string, phrase string"


# --- phrases of a chunk -----------------------------------------------------------

class Chunk:
    """Words of some rows: ``words`` are their keys, ``left`` the number of words of the piece from each on."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray) -> None:
        self.data = lower_ascii(data)
        self.starts, self.ends = word_spans(self.data, offsets, _WORD)
        n = len(self.starts)
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        self.langs = langs
        self.words = mix(span_hash(prefix_hash(self.data), self.starts, self.ends) * _NEXT + langs[self.row])
        stops = np.cumsum(_STOP[self.data], dtype=np.int32)
        broken = np.ones(n, bool)                      # no phrase goes from word i to word i + 1
        if n > 1:
            broken[:-1] = (stops[self.starts[1:]] != stops[self.ends[:-1] - 1]) | (self.row[1:] != self.row[:-1])
        last = np.flatnonzero(broken)
        self.left = last[np.searchsorted(last, np.arange(n))] - np.arange(n) + 1

    def longer(self, keys: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """Keys of the phrases of ``size`` words at ``at`` from those of one word less."""
        return mix(keys * _NEXT + self.words[at + size - 1])

    def phrase(self, i: int, size: int) -> bytes:
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[i:i + size].tolist(),
                                                                  self.ends[i:i + size].tolist(), strict=True))


def levels(chunk: Chunk, longest: int, *filters: Filter):
    """(size, places, keys, marks) of the phrases whose two parts the last filter holds, and of all words. Marks
    are, for each filter, (both parts held, held itself): a phrase is held only if its parts are."""
    n = len(chunk.words)
    at, keys = np.arange(n), chunk.words
    marks = [(np.ones(n, bool), f.has(keys)) for f in filters]
    yield 1, at, keys, marks
    for size in range(2, longest + 1):
        held = []
        for _, own in marks:
            full = np.zeros(n + 1, bool)
            full[at] = own
            held.append(full)
        go = held[-1][at] & held[-1][at + 1] & (chunk.left[at] >= size)
        at, keys = at[go], keys[go]
        keys = chunk.longer(keys, at, size)
        marks = []
        for f, full in zip(filters, held, strict=True):
            both = full[at] & full[at + 1]
            own = both.copy()
            own[both] = f.has(keys[both])
            marks.append((both, own))
        yield size, at, keys, marks


class Filter:
    """A Bloom filter over keys: a bit array that Spark gathered, and its test."""

    def __init__(self, words: np.ndarray) -> None:
        self.bytes = words.view(np.uint8)
        self.mask = np.uint64(len(words) * 64 - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        at = np.arange(len(keys))
        for shift in _SHIFTS:
            bit = (keys[at] >> np.uint64(shift)) & self.mask
            hit = (self.bytes[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
            out[at[~hit]] = False
            at = at[hit]
        return out


def _filter_words(keys: DataFrame, bits: int) -> np.ndarray:
    """The filter's bits over ``keys`` (key): ORed per 64-bit word by Spark; bits / 64 rows at most."""
    words = np.zeros(bits // 64, np.int64)
    bit = F.explode(F.array(*(F.shiftrightunsigned("key", s).bitwiseAND(F.lit(bits - 1)) for s in _SHIFTS)))
    got = (keys.select(bit.alias("bit")).select(F.shiftright("bit", 6).alias("word"),
                                                F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("value"))
           .groupBy("word").agg(F.bit_or("value").alias("value"))).toArrow()
    words[got.column("word").to_numpy()] = got.column("value").to_numpy()
    return words


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Chunk, list[str]]]:
    """(chunk, language of each of its rows) of Arrow batches of (lang, text)."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        data, offsets = text_bytes(batch.column(1))
        raw, places = text_bytes(batch.column(0))
        lang_keys = span_hash(prefix_hash(raw), places[:-1], places[1:])
        for a, b in chunks(offsets, CHUNK):
            lo = offsets[a]
            yield Chunk(data[lo:offsets[b]], offsets[a:b + 1] - lo, lang_keys[a:b]), langs[a:b]


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


class _Counter:
    """Keys as they come; counted and passed on when ``HELD`` of a size are held."""

    def __init__(self) -> None:
        self.held: dict[int, list[np.ndarray]] = {}

    def add(self, keys: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
        held = self.held.setdefault(size, [])
        held.append(keys)
        if sum(map(len, held)) > HELD:
            yield self._take(size)

    def rest(self) -> Iterator[pa.RecordBatch]:
        for size in list(self.held):
            yield self._take(size)

    def _take(self, size: int) -> pa.RecordBatch:
        keys, n = _counts(np.concatenate(self.held.pop(size)))
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), size, np.int32)),
                                           pa.array(n)], schema=arrow_schema(_KEYS))


def _sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = _Counter()
    for chunk, _ in _batches(batches):
        yield from counter.add(chunk.words, 1)
    yield from counter.rest()


class _Parts:
    """Phrases as they come, with the keys of their parts; counted and passed on when ``HELD`` / 2 of a size are held."""

    def __init__(self) -> None:
        self.held: dict[int, list[tuple]] = {}

    def add(self, size: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        held = self.held.setdefault(size, [])
        held.append(columns)
        if sum(len(h[0]) for h in held) > HELD // 2:
            yield self._take(size)

    def rest(self) -> Iterator[pa.RecordBatch]:
        for size in list(self.held):
            yield self._take(size)

    def _take(self, size: int) -> pa.RecordBatch:
        keys, *rest = (np.concatenate(c) for c in zip(*self.held.pop(size), strict=True))
        keys, first, n = np.unique(keys, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), size, np.int32)), pa.array(n),
             *(pa.array(c[first].view(np.int64)) for c in rest)], schema=arrow_schema(_PHRASES))


def _sample_phrases(words, longest: int):
    """Phrases of proposed words, with their parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts = Filter(words.value), _Parts()
        for chunk, _ in _batches(batches):
            good = np.append(0, np.cumsum(known.has(chunk.words)))
            at, keys = np.arange(len(chunk.words)), chunk.words
            for size in range(2, longest + 1):
                part = np.zeros(len(chunk.words) + 1, np.uint64)
                part[at] = keys
                go = chunk.left[at] >= size
                at, keys = at[go], keys[go]
                go = good[at + size] - good[at] == size
                at = at[go]
                keys = chunk.longer(keys[go], at, size)
                yield from parts.add(size, keys, part[at], part[at + 1], chunk.langs[chunk.row[at]])
        yield from parts.rest()
    return run


def _full_pass(proposed, longest: int):
    """Every word, and every phrase whose parts are proposed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counter = Filter(proposed.value), _Counter()
        for chunk, _ in _batches(batches):
            for size, _, keys, _ in levels(chunk, longest, known):
                yield from counter.add(keys, size)
        yield from counter.rest()
    return run


def _expansion_pass(wanted, before, now, longest: int):
    """Counts and parts of the phrases whose keys are in ``wanted`` (None: of none), and of those whose parts are
    in ``now`` and were not both in ``before``; with ``wanted`` also each language's number of words (size 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Filter(wanted.value) if wanted is not None else None
        old, new = Filter(before.value), Filter(now.value)
        parts, words = _Parts(), {}
        for chunk, _ in _batches(batches):
            langs = chunk.langs[chunk.row]
            if asked is not None:
                for lang, n in zip(*map(np.ndarray.tolist, _counts(langs.view(np.int64))), strict=True):
                    words[lang] = words.get(lang, 0) + n
            part = np.zeros(len(chunk.words) + 1, np.uint64)      # keys of one word less, by place
            for size, at, keys, ((counted, _), _) in levels(chunk, longest, old, new):
                if size > 1:
                    go = ~counted
                    if asked is not None:
                        go |= asked.has(keys)
                    here = at[go]
                    yield from parts.add(size, keys[go], part[here], part[here + 1], langs[here])
                part[at] = keys
        yield from parts.rest()
        keys, nothing = pa.array(list(words), pa.int64()), pa.array([0] * len(words), pa.int64())
        yield pa.RecordBatch.from_arrays([keys, nothing.cast(pa.int32()), pa.array(list(words.values()), pa.int64()), nothing,
                                          nothing, keys], schema=arrow_schema(_PHRASES))
    return run


def _not_in(held):
    """The rows (key, ...) whose keys the filter does not hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(held.value)
        for batch in batches:
            yield batch.filter(pa.array(~known.has(batch.column(0).to_numpy().view(np.uint64))))
    return run


def _naming_pass(wanted, least: int, longest: int):
    """(key, lang, phrase) of the keys in ``wanted``, once a task (and some that the filter lets through)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Filter(wanted.value), set()
        for chunk, langs in _batches(batches):
            at, keys, rows = np.arange(len(chunk.words)), chunk.words, []
            for size in range(1, longest + 1):
                if size > 1:
                    go = chunk.left[at] >= size
                    at = at[go]
                    keys = chunk.longer(keys[go], at, size)
                if size < least:
                    continue
                hit = np.flatnonzero(known.has(keys))
                for key, i in zip(keys[hit].view(np.int64).tolist(), at[hit].tolist(), strict=True):
                    if key not in seen:
                        seen.add(key)
                        rows.append((key, langs[chunk.row[i]], chunk.phrase(i, size)))
            if len(seen) > HELD:
                seen.clear()
            if rows:
                key, lang, phrase = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), pa.array(lang, pa.string()), pa.array(phrase, pa.binary()).cast(pa.string())],
                    schema=arrow_schema(_NAMES))
    return run


# --- mining ------------------------------------------------------------------------

def _summed(rows: DataFrame, at_least: int) -> DataFrame:
    return rows.groupBy("key").agg(F.max("size").alias("size"), F.sum("n").alias("n")).where(F.col("n") >= at_least)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text",
                       F.xxhash64("doc_id").alias("draw")).where("text is not null")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, sample: int = SAMPLE,
         bits: int = BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What occurs ``min_count`` times, with exact counts: words (key, n), and phrases of 2 to ``longest`` words
    (key, size, n, prefix, suffix, lang_key), where prefix and suffix are the keys of their two parts; and
    (lang_key, n), the words of each language."""
    sc = docs.sparkSession.sparkContext
    texts = _texts(docs)
    drawn, texts = texts.where(F.pmod("draw", F.lit(sample)) == 0).drop("draw"), texts.drop("draw")
    lowered = max(1, int(0.6 * min_count / sample))

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.sum("n").alias("n"), *(F.first(c).alias(c) for c in ("size", "prefix", "suffix", "lang_key")))

    words = stored(_summed(drawn.mapInArrow(_sample_words, _KEYS), lowered), "sample-words")
    known = sc.broadcast(_filter_words(words, bits))
    phrases = stored(summed(drawn.mapInArrow(_sample_phrases(known, longest), _PHRASES)).where(F.col("n") >= lowered),
                     "sample-phrases")
    before = _filter_words(words.select("key").unionByName(phrases.select("key")), bits)

    now = sc.broadcast(before)
    found = stored(_summed(texts.mapInArrow(_full_pass(now, longest), _KEYS), min_count), "frequent-keys")
    longer = found.where("size > 1").select("key", "n")
    proposed = longer.join(phrases.drop("n"), "key")              # their parts are known from the sample
    others = stored(longer.join(phrases.select("key"), "key", "left_anti").select("key"), "not-proposed")
    wanted = sc.broadcast(_filter_words(others, bits))
    tables, latest = [], found
    while True:
        # The border failed at these: frequent, able to grow, and in no filter yet.
        grow = latest.where(F.col("size").between(1, longest - 1)).select("key").mapInArrow(_not_in(now), "key long")
        grow = stored(grow, "border-failures")
        if tables and grow.isEmpty():
            break
        old, before = now, before | _filter_words(grow, bits)
        now = sc.broadcast(before)
        rows = summed(texts.mapInArrow(_expansion_pass(wanted if not tables else None, old, now, longest), _PHRASES))
        latest = stored(rows.where((F.col("n") >= min_count) | (F.col("size") == 0)), "expansion")
        tables.append(latest)
    columns = ["key", "size", "n", "prefix", "suffix", "lang_key"]
    out = proposed.select(*columns)
    for t in tables:
        out = out.unionByName(t.where("size > 1").select(*columns))
    return (found.where("size = 1").select("key", "n"), stored(out.dropDuplicates(["key"]), "frequent-phrases"),
            tables[0].where("size = 0").select("lang_key", "n"))


def names(docs: DataFrame, keys: DataFrame, least: int = 1, longest: int = LONGEST, bits: int = BITS) -> DataFrame:
    """(key, lang, phrase) of ``keys`` (key), of phrases of ``least`` to ``longest`` words."""
    wanted = docs.sparkSession.sparkContext.broadcast(_filter_words(keys, bits))
    found = _texts(docs).drop("draw").mapInArrow(_naming_pass(wanted, least, longest), _NAMES).groupBy("key").agg(
        F.min(F.struct("lang", "phrase")).alias("name"), F.max(F.struct("lang", "phrase")).alias("last"))
    found = found.join(keys.select(F.col("key").alias("k")), F.col("key") == F.col("k"), "left_semi")
    one = F.when(F.col("name") == F.col("last"), F.col("name")).otherwise(F.raise_error(F.lit("two phrases share a key")))
    return found.select("key", one.alias("name")).select("key", "name.lang", "name.phrase")


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, sample: int = SAMPLE,
                     bits: int = BITS) -> DataFrame:
    """(lang, phrase, size, n): every phrase of 1 to ``longest`` words with ``min_count`` occurrences or more."""
    words, phrases, _ = mine(docs, min_count, longest, sample, bits)
    every = words.select("key", F.lit(1).alias("size"), "n").unionByName(phrases.select("key", "size", "n"))
    return every.join(names(docs, every, 1, longest, bits), "key").select("lang", "phrase", "size", "n")


def scored(words: DataFrame, phrases: DataFrame, longest: int = LONGEST, share: int = SHARE) -> DataFrame:
    """(key, lang_key, a, l, r, score) of the phrases of ``mine`` that no longer one holds."""
    # A phrase's heads are its prefix and that one's heads; its tails its suffix and that one's tails.
    level = phrases.where("size = 2").withColumns({"heads": F.array("prefix"), "tails": F.array("suffix")})
    levels_ = [level]
    for size in range(3, longest + 1):
        head = level.select(F.col("key").alias("h_key"), F.col("heads").alias("h"))
        tail = level.select(F.col("key").alias("t_key"), F.col("tails").alias("t"))
        level = (phrases.where(F.col("size") == size).join(head, F.col("prefix") == F.col("h_key"))
                 .join(tail, F.col("suffix") == F.col("t_key"))
                 .select(*phrases.columns, F.concat("h", F.array("prefix")).alias("heads"),
                         F.concat(F.array("suffix"), "t").alias("tails")))
        levels_.append(level)
    every = levels_[0]
    for t in levels_[1:]:
        every = every.unionByName(t)
    counts = words.select("key", "n").unionByName(phrases.select("key", "n"))

    def part(column: str, name: str) -> DataFrame:
        return counts.select(F.col("key").alias(column), F.col("n").alias(name))
    cut = every.select("key", "lang_key", F.col("n").alias("a"), F.posexplode(F.arrays_zip("heads", "tails")).alias("k", "parts"))
    cut = cut.select("key", "lang_key", "a", "k", F.col("parts.heads").alias("head"), F.col("parts.tails").alias("tail"))
    cut = cut.join(part("head", "l"), "head").join(part("tail", "r"), "tail")
    # Decimals: the product of a long and 2,000,000 may pass 64 bits.
    score = F.expr(f"cast(cast(a as decimal(20, 0)) * {SCORE} div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) as long)")
    best = (cut.groupBy("key").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"),
                                   F.max("a").alias("a"), F.max("lang_key").alias("lang_key"))
            .select("key", "lang_key", "a", "best.l", "best.r", "best.score"))
    around = phrases.where("size > 2").select(F.explode(F.array("prefix", "suffix")).alias("inner"), F.col("n").alias("longer"))
    around = around.groupBy("inner").agg(F.max("longer").alias("longer"))
    return (best.join(around, F.col("key") == F.col("inner"), "left")
            .where(F.expr(f"longer is null or cast(longer as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * {share}"))
            .drop("inner", "longer"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, share: int = SHARE,
                 top: int = TOP, sample: int = SAMPLE, bits: int = BITS) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a (its count), l and r (its parts' counts at the cut
    with the lowest score), n (words of the language) and score."""
    words, phrases, total = mine(docs, min_count, longest, sample, bits)
    found = scored(words, phrases, longest, share)
    best = [F.desc("score"), F.desc("a")]
    found = found.withColumn("part", F.pmod("key", F.lit(PARTS)))
    for within in (["lang_key", "part"], ["lang_key"]):                 # ranks with ties: texts decide later
        found = found.withColumn("place", F.rank().over(Window.partitionBy(*within).orderBy(*best))).where(F.col("place") <= top)
    found = stored(found.select("key", "lang_key", "a", "l", "r", "score"), "collocations")
    rows = found.join(names(docs, found, 2, longest, bits), "key").join(total, "lang_key")
    order = Window.partitionBy("lang").orderBy(*best, F.asc("phrase"))
    return (rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op13_phrases(spark, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of each language."""
    return collocations(read_table(spark, sf_dir, "documents"))
