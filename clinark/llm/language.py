"""Language of whole texts and of spans in mixed ones (op 2).

Words are runs of letters. A word's script (by code point ranges, read off the lead bytes)
narrows the candidates to languages that were learned with that script; its score for
each candidate is the sum of byte-trigram log-probabilities. Viterbi over the words with a
switching penalty labels every word, so a short foreign span is only labelled where its
words outweigh two switches. The document's language is the label with most letters, the
score that label's share.

Learning: trigram counts of at most ``PER_LANG`` documents of each language (hash-drawn,
whole texts), counted in Spark. Only text and lang are read, and lang only of the learning rows.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0; words in a
script that no learned language has count for all alike; no learned language at all makes
every text ``und``; NULL or repeated ids are scored like any row; ties go to the language
that sorts first; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinark.llm.common import arrow_schema, chunks, fold, lower_ascii, read_table, text_bytes, word_spans
from clinark.llm.samples import stratified

PER_LANG = 2000
BUCKETS = 1 << 16
SWITCH = 12.0
SMOOTH = 0.2
SCRIPT_SHARE = 0.005
CHUNK = 1 << 20
OTHER = 11

#: Scripts by UTF-8 lead byte (Latin, Greek, Cyrillic, Armenian, Hebrew, Arabic, Devanagari,
#: Thai, Kana, Han, Hangul, other); E0 and E3 are told apart by the next byte.
SCRIPT = np.zeros(256, np.uint8)
for _lead, _script in ((range(0x41, 0x5B), 1), (range(0x61, 0x7B), 1), (range(0xC2, 0xCC), 1), (range(0xCD, 0xD0), 2),
                       (range(0xD0, 0xD4), 3), (range(0xD4, 0xD6), 4), (range(0xD6, 0xD8), 5), (range(0xD8, 0xDC), 6),
                       (range(0xDC, 0xE3), OTHER), (range(0xE3, 0xE4), 9), (range(0xE4, 0xEA), 10),
                       (range(0xEA, 0xEE), 12), (range(0xEE, 0xF5), OTHER)):
    SCRIPT[list(_lead)] = _script
N_SCRIPTS = 13
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True


def letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower-cased bytes with non-letters as blanks, script of each lead byte or 0)."""
    low = lower_ascii(data).copy()
    ok = _LETTER[data].copy()
    nxt = np.append(data[1:], 0) if len(data) else data
    for lead, length, drop in (                       # symbols and punctuation beyond ASCII are no letters
            (0xC2, 2, ~np.isin(nxt, [0xAA, 0xB5, 0xBA])), (0xE2, 3, nxt < 0xB0), (0xE3, 3, nxt == 0x80),
            (0xF0, 4, nxt < 0xA0), (0xEF, 3, nxt >= 0xB8)):
        at = np.flatnonzero((data == lead) & drop)
        for j in range(length):
            ok[np.minimum(at + j, len(data) - 1)] = False
    upper = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)) + 1
    low[upper] += 0x20
    script = np.where(ok, SCRIPT[data], 0)
    e0 = np.flatnonzero(data == 0xE0)
    script[e0] = np.select([nxt[e0] // 2 == 0xA4 // 2, nxt[e0] // 2 == 0xB8 // 2], [7, 8], OTHER)
    low[~ok] = 0x20
    return low, script


def words_of(data: np.ndarray, offsets: np.ndarray):
    """Trigram bucket of every letter byte, and words: first byte, row bounds, byte counts, scripts."""
    low, script = letters(data)
    starts, ends = word_spans(low, offsets, _LETTER)
    inside = np.zeros(len(low) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]))
    size = ends - starts
    first = np.cumsum(size) - size
    before, after = low[np.maximum(at - 1, 0)].astype(np.uint32), low[np.minimum(at + 1, len(low) - 1)].astype(np.uint32)
    before[first] = 0x20
    after[first + size - 1] = 0x20
    code = (before << 16) | (low[at].astype(np.uint32) << 8) | after
    bucket = (code * np.uint32(2654435761)) >> np.uint32(16)
    return bucket, first, np.searchsorted(starts, offsets), size, script[starts]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, slot, n): trigram buckets, then scripts of words, summed per task."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        data, offsets = text_bytes(batch.column(0))
        for a, b in chunks(offsets):
            bucket, first, bounds, size, script = words_of(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            for row in range(b - a):
                x, y = bounds[row], bounds[row + 1]
                if x == y:
                    continue
                own = total.setdefault(langs[a + row], np.zeros(BUCKETS + N_SCRIPTS, np.int64))
                own += np.bincount(bucket[first[x]:first[y - 1] + size[y - 1]], minlength=len(own))
                own[BUCKETS:] += np.bincount(script[x:y], minlength=N_SCRIPTS)
    for lang, own in total.items():
        slot = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot), pa.array(own[slot])],
                                         schema=arrow_schema("lang string, slot long, n long"))


def learn(docs: DataFrame, per_lang: int = PER_LANG) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-probability by bucket and language, script by language allowed)."""
    rows = docs.where("lang is not null and text is not null")
    drawn = stratified(rows.select("doc_id", "lang"), "lang", "doc_id", per_lang).select("doc_id").distinct()
    got = (rows.join(F.broadcast(drawn), "doc_id").select("text", "lang")   # per_lang ids a language at most
           .mapInArrow(_counts, "lang string, slot long, n long")
           .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow())
    names = sorted(set(got.column("lang").to_pylist()))
    count = np.zeros((BUCKETS + N_SCRIPTS, max(len(names), 1)))
    if len(got):
        where = {n: i for i, n in enumerate(names)}
        count[got.column("slot").to_numpy(), [where[x] for x in got.column("lang").to_pylist()]] = got.column("n").to_numpy()
    trigrams, scripts = count[:BUCKETS], count[BUCKETS:]
    log_p = np.log((trigrams + SMOOTH) / (trigrams.sum(axis=0) + SMOOTH * BUCKETS))
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True
    return names, log_p.astype(np.float32), allowed


def viterbi(emission: np.ndarray, bounds: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word; rows are sequences, taken step by step together, longest first."""
    length = np.diff(bounds)
    order = np.argsort(-length, kind="stable")
    length, start = length[order], bounds[:-1][order]
    labels = emission.shape[1]
    out = np.zeros(len(emission), np.uint8)
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), side="left")
    came = np.zeros((len(emission), labels), np.uint8)
    same = np.arange(labels, dtype=np.uint8)
    value = emission[start[:active[0]]].copy() if steps else None
    last = np.zeros(len(length), np.uint8)
    for t in range(1, steps):
        n = active[t]
        if n < len(value):
            last[n:len(value)] = value[n:].argmax(axis=1)
            value = value[:n]
        top = value.argmax(axis=1)
        jump = value[np.arange(n), top][:, None] - np.float32(switch)
        stay = value >= jump
        at = start[:n] + t
        came[at] = np.where(stay, same, top[:, None])
        value = np.where(stay, value, jump) + emission[at]
    if steps:
        last[:len(value)] = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = start[:n] + t
        out[at] = last[:n]
        if t:
            last[:n] = came[at, last[:n]]
    return out


_RESULT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))])


def _label(names: list[str], log_p: np.ndarray, allowed: np.ndarray, switch: float):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets, CHUNK):
                bucket, first, bounds, size, script = words_of(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                emission = (np.add.reduceat(log_p[bucket], first, axis=0) if len(first)
                            else np.zeros((0, log_p.shape[1]), np.float32))
                emission = np.where(allowed[script], emission, np.float32(-1e6))
                path = viterbi(emission, bounds, switch)
                owner = np.repeat(np.arange(b - a), np.diff(bounds))
                mass = np.bincount(owner * log_p.shape[1] + path, weights=size, minlength=(b - a) * log_p.shape[1])
                mass = mass.reshape(b - a, -1)
                total = mass.sum(axis=1)
                best = mass.argmax(axis=1)
                known = (total > 0) & bool(names)
                edge = np.ones(len(path) + 1, bool)
                edge[1:-1] = (owner[1:] != owner[:-1]) | (path[1:] != path[:-1])
                change = np.flatnonzero(edge) if len(path) else np.zeros(0, np.int64)
                spans: list[list] = [[] for _ in range(b - a)]
                for x, y in zip(change[:-1], change[1:], strict=True):
                    if names:
                        row = owner[x]
                        spans[row].append({"start": int(x - bounds[row]), "end": int(y - bounds[row]), "lang": names[path[x]]})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.array([names[i] if k else "und" for i, k in zip(best, known, strict=True)], pa.string()),
                     pa.array(np.where(known, mass.max(axis=1) / np.maximum(total, 1), 0.0)),
                     pa.array(spans, _RESULT.field("spans").type)], schema=_RESULT)
    return label


def predict(docs: DataFrame, model, switch: float = SWITCH) -> DataFrame:
    """(doc_id, lang_pred, score, spans of words) of every row of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _label(*model, switch), "doc_id long, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>")


def keep_rows(docs: DataFrame, model, min_score: float, switch: float = SWITCH) -> DataFrame:
    """The rows of ``docs``, columns as they are, whose main language labels ``min_score`` of the letters."""
    label = _label(*model, switch)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([pa.nulls(len(batch), pa.int64()), batch.column("text")], names=["doc_id", "text"])
            ok = [(out.column("lang_pred").to_pylist(), out.column("score").to_numpy()) for out in label(iter([pair]))]
            yield batch.filter(pa.array([x != "und" and y >= min_score for ls, ys in ok for x, y in zip(ls, ys, strict=True)],
                                        pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def held_out():
    return F.coalesce(fold("doc_id", 5) == 0, F.lit(False))


def op2_language(spark, sf_dir: str) -> DataFrame:
    """Language and score of every document, learned from the documents that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    found = predict(docs, learn(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
