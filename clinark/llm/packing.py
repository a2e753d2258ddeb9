"""Packing documents into sequences of ``window`` tokens by non-negative least squares (op 12).

A document is its text's ids and the end id. Every whole window of it is a sequence of its
own; what is left, its tail of 1 to ``window`` - 1 tokens, is packed with other tails.

1. Tokens: one pass over the texts gives each document's number of tokens, the crc32 of each
   piece it can be cut into (whole windows, the tail, the powers of two that make up the tail)
   and its place among the documents of its task with that tail length. No ids are kept.
2. Plan: the histogram of tail lengths (``window`` - 1 numbers at most, whatever the corpus)
   goes to the driver. Shallow combinations that fill a window are enumerated: one or two
   lengths, each repeated, and triples. How often to use each is a non-negative least squares
   fit of the histogram by multiplicative updates; the counts are rounded so that running sums
   stay true, and no length is used more often than it occurs.
3. Residual tails are packed greedily: the longest first, in exact pairs and triples while there
   are any. What still stays is cut at its powers of two; pieces are laid out by falling size,
   so that none crosses a window's edge. The last window is cut at its own powers of two, which
   need no padding. So only tails that match nothing are cut, and nothing is padded.
4. Places: a tail's number among all of its length (running counts per task, in one table) says
   by the plan which sequence holds it.

``sequences`` builds the ids of the sequences from the pieces.

Defined cases: a NULL text is an empty one; an empty document is the end id alone; rows that
repeat a doc_id are documents of their own; a NULL doc_id stays NULL; an empty table gives no
rows; extra columns are ignored. A special token's string in a text is that token, as the
tokenizer takes it by default.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinark.llm.common import arrow_schema, read_table, stored

WINDOW = 2048
END = 1
ROUNDS = 120
#: Segments a worker remembers the ids of, besides as many from before.
REMEMBERED = 400_000
_MARKS = frozenset(".,;:!?")
#: Runs of marks a worker remembers the ids of: those of at most so many.
MARKS_KEPT = 4
SLICE = 1 << 20

#: The characters that byte-level BPE vocabularies write bytes as. Bytes that print stand for
#: themselves, the others, in order, for the characters from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: b if b in _PRINTED else 256 + sum(x not in _PRINTED for x in range(b)) for b in range(256)}

_COUNTED = ("doc_id long, text_key long, part int, n long, tail int, nth long, window_nth long, crcs binary")
_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "text_key long")


def _latin(s: str) -> bool:
    return s.isalpha() and (s.isascii() or max(s) < "\u0250")


class Tokens:
    """Texts to ids as little-endian unsigned 32-bit bytes.

    A byte-level BPE tokenizer never joins what is before a lone blank (one between two
    characters that are not white space) with the blank, so a text is cut there and each
    different segment is encoded once. A segment of a Latin word and a mark is cut further, into
    what the pre-tokenizer would cut it into. Other tokenizers get whole texts.
    """

    _CUT = re.compile(r"(?<=\S) (?=\S)")
    _LINES = re.compile(r"([^\W\d_]+)([.,;:!?])\n([^\W\d_]+)")
    #: A word and a run of marks, which are neither letters, digits nor part of a contraction.
    _MARKED = re.compile(r"([^\W\d_]+)([.,;:!?%#&*$@+=~^-]+)")
    _made: dict[str, Tokens] = {}

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.cuttable = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        # A run of marks is cut off only if no added token lies in such runs.
        added = "".join(t["content"] for t in spec.get("added_tokens") or [] if not any(map(str.isalnum, t["content"])))
        self.runs = not added
        self.known: dict[str, bytes | None] = {}        # segments, and those known before the last turnover
        self.older: dict[str, bytes | None] = {}
        self.marks: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Tokens:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _run(self, run: str) -> bytes:
        """Ids of a run of characters that the pre-tokenizer keeps together."""
        text = "\u0120" + run[1:] if run.isascii() and run[0] == " " else run.encode().decode("latin-1").translate(_BYTE_CHARS)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a blank and a word of Latin letters."""
        ids = self.known.get(word)
        if ids is None:
            ids = self.known[word] = self.older.get(word) or self._run(" " + word)
        return ids

    def _mark(self, mark: str) -> bytes:
        if len(mark) > MARKS_KEPT:
            return self._run(mark)
        if mark not in self.marks:
            self.marks[mark] = self._run(mark)
        return self.marks[mark]

    def _learn(self, segments: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, other = self.known, self.older, []
        for s in segments.difference(known):
            if s in older:
                known[s] = older[s]
            elif _latin(s):
                known[s] = self._run(" " + s)
            elif s and s[-1] in _MARKS and _latin(s[:-1]):
                known[s] = self._word(s[:-1]) + self._mark(s[-1])
            # An empty segment, or one with white space at an end, means that a blank beside it is not lone.
            elif not s or s[0].isspace() or s[-1].isspace():
                known[s] = None
            elif self.runs and (match := self._MARKED.fullmatch(s)) and _latin(match[1]):
                known[s] = self._word(match[1]) + self._mark(match[2])
            elif match := self._LINES.fullmatch(s):
                word, mark, rest = match.groups()
                if _latin(word) and _latin(rest):
                    known[s] = self._word(word) + self._mark(mark) + self._mark("\n") + self._run(rest)
                else:
                    other.append(s)
            else:
                other.append(s)
        if other:
            known.update(zip(other, self._encode([" " + s for s in other]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.cuttable:
            return self._encode(texts)
        cut = [t.split(" ") for t in texts]
        self._learn(set(chain.from_iterable(islice(c, 1, None) for c in cut)))
        first = self._encode([c[0] for c in cut])
        out = []
        for text, c, head in zip(texts, cut, first, strict=True):
            if len(c) > 1 and (not c[0] or c[0][-1].isspace()):
                out.append(self._careful(text))
                continue
            try:
                out.append(head + b"".join(map(self.known.__getitem__, c[1:])))
            except TypeError:
                out.append(self._careful(text))
        return out

    def _careful(self, text: str) -> bytes:
        c = self._CUT.split(text)
        fresh = list({s for s in c[1:]})
        ids = dict(zip(fresh, self._encode([" " + s for s in fresh]), strict=True))
        return b"".join([*self._encode(c[:1]), *map(ids.__getitem__, c[1:])])


def _slices(texts: list[str]) -> Iterator[list[str]]:
    """The texts in groups of about ``SLICE`` characters."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= SLICE:
            yield group
            group, size = [], 0
    if group:
        yield group


def powers(size: int) -> list[int]:
    """The powers of two that make up ``size``, largest first."""
    return [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]


def _piece_crcs(ids: bytes, window: int) -> bytes:
    """crc32 of every whole window, of the tail, and of the tail's powers of two."""
    view, n = memoryview(ids), len(ids) // 4
    full, tail = divmod(n, window)
    crcs = [zlib.crc32(view[4 * window * i:4 * window * (i + 1)]) for i in range(full)]
    if tail:
        at = full * window
        crcs.append(zlib.crc32(view[4 * at:]))
        for p in powers(tail):
            crcs.append(zlib.crc32(view[4 * at:4 * (at + p)]))
            at += p
    return np.array(crcs, "<u4").tobytes()


def _count(path: str, window: int, end: int):
    end_id = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = Tokens.of(path), TaskContext.get().partitionId()
        seen, windows = np.zeros(window, np.int64), 0
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            n, tail, nth, window_nth, crcs = [], [], [], [], []
            for group in _slices(texts):
                for ids in tokens.encode(group):
                    ids += end_id
                    n.append(len(ids) // 4)
                    full, rest = divmod(n[-1], window)
                    tail.append(rest)
                    nth.append(int(seen[rest]))
                    window_nth.append(windows)
                    seen[rest] += 1
                    windows += full
                    crcs.append(_piece_crcs(ids, window))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([part] * len(n), pa.int32()), pa.array(n, pa.int64()),
                 pa.array(tail, pa.int32()), pa.array(nth, pa.int64()), pa.array(window_nth, pa.int64()),
                 pa.array(crcs, pa.binary())], schema=arrow_schema(_COUNTED))
    return run


# --- plan ----------------------------------------------------------------------

def combinations(present: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, repeats), both (patterns, 3): the shallow ways to fill a window with the lengths that are
    ``present`` (a mask over 0..window-1): i x a, i x a + j x b, and a + b + c. Unused places have repeat 0."""
    sizes = np.flatnonzero(present)
    sizes = sizes[sizes > 0]
    lengths, repeats = [], []

    def add(columns, times) -> None:
        lengths.append(np.stack(np.broadcast_arrays(*columns), -1).reshape(-1, 3))
        repeats.append(np.stack(np.broadcast_arrays(*times), -1).reshape(-1, 3))

    for a in sizes.tolist():
        if window % a == 0:
            add([np.array([a]), 0, 0], [np.array([window // a]), 0, 0])
        for i in range(1, (window - 1) // a + 1):
            rest = window - i * a
            b = sizes[(sizes > a) & (sizes <= rest)]
            b = b[rest % b == 0]
            if len(b):
                add([np.full(len(b), a), b, 0], [np.full(len(b), i), rest // b, 0])
        b = sizes[sizes > a]
        c = window - a - b
        ok = c > b
        b, c = b[ok], c[ok]
        ok = present[c]
        if ok.any():
            add([np.full(int(ok.sum()), a), b[ok], c[ok]], [1, 1, np.ones(int(ok.sum()), np.int64)])
    if not lengths:
        return np.zeros((0, 3), np.int64), np.zeros((0, 3), np.int64)
    return np.concatenate(lengths), np.concatenate(repeats)


def fit(lengths: np.ndarray, repeats: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """x >= 0 that minimises |A x - histogram|^2, A's columns being the patterns: multiplicative updates,
    which keep x non-negative and never raise the error."""
    def use(x):
        return np.bincount(lengths.ravel(), (repeats * x[:, None]).ravel(), len(histogram))

    def back(v):
        return (repeats * v[lengths]).sum(1)

    goal = back(histogram.astype(float))
    x = goal / np.maximum(back(use(np.ones(len(lengths)))), 1e-12)
    for _ in range(rounds):
        x *= goal / np.maximum(back(use(x)), 1e-12)
    return x


def _rounded(lengths: np.ndarray, repeats: np.ndarray, x: np.ndarray, left: np.ndarray) -> list[tuple[int, list, list]]:
    """Whole counts whose running sums follow those of x, as far as ``left`` (changed in place) allows."""
    order = np.lexsort((lengths[:, 1], lengths[:, 0], lengths.max(1)))
    steps = np.diff(np.floor(np.cumsum(x[order]) + 0.5), prepend=0).astype(np.int64)
    out = []
    for j, n in zip(order[steps > 0].tolist(), steps[steps > 0].tolist(), strict=True):
        sizes = [(s, r) for s, r in zip(lengths[j].tolist(), repeats[j].tolist(), strict=True) if r]
        n = min(n, *(int(left[s]) // r for s, r in sizes))
        if n > 0:
            for s, r in sizes:
                left[s] -= n * r
            out.append((n, *map(list, zip(*sizes, strict=True))))
    return out


def _greedy(left: np.ndarray, window: int) -> list[tuple[int, list, list]]:
    """Exact pairs, then triples, of the lengths still ``left`` (changed in place), the longest first."""
    out = []
    for c in range(window - 1, 0, -1):
        while left[c]:
            rest = window - c
            if left[rest] and (rest != c or left[c] > 1):
                take = {c: 1, rest: 1} if rest != c else {c: 2}
            else:
                b = np.arange(1, rest // 2 + 1)
                a = rest - b
                both = np.minimum(left[b], left[a])
                both[(a == b) & (left[a] < 2)] = 0
                both[((a == c) | (b == c)) & (left[c] < 2)] = 0
                if not len(both) or not both.max():
                    break
                k = int(both.argmax())
                take = {}
                for s in (c, int(a[k]), int(b[k])):
                    take[s] = take.get(s, 0) + 1
                if any(left[s] < r for s, r in take.items()):
                    break
            n = min(int(left[s]) // r for s, r in take.items())
            for s, r in take.items():
                left[s] -= n * r
            out.append((n, list(take), list(take.values())))
    return out


class Plan:
    """Where the nth tail of each length goes. Built from the histogram alone; at most one entry for
    each pattern and length."""

    def __init__(self, histogram: np.ndarray, window: int = WINDOW) -> None:
        self.window = window
        left = histogram.astype(np.int64).copy()
        left[0] = 0
        total = left.copy()
        lengths, repeats = combinations(left > 0, window)
        used = _rounded(lengths, repeats, fit(lengths, repeats, left), left) if len(lengths) else []
        used += _greedy(left, window)
        entries, taken, sequence = [], np.zeros(window, np.int64), 0
        for n, sizes, times in used:
            offset = 0
            for s, r in zip(sizes, times, strict=True):
                entries.append((s, taken[s], r, sequence, offset))
                taken[s] += n * r
                offset += s * r
            sequence += n
        entries.sort()
        table = np.array(entries, np.int64).reshape(-1, 5)
        self.size, self.first, self.times, self.sequence, self.offset = table.T.copy()
        self.whole = taken                                  # tails of each length that stay whole
        # Cut tails: pieces of each power of two, by falling size, then by length, then by number.
        rest = total - taken
        self.cut_at, at = {}, 0
        for k in range(window.bit_length() - 1, -1, -1):
            for s in np.flatnonzero(rest):
                if s >> k & 1:
                    self.cut_at[int(s), 1 << k] = at
                    at += int(rest[s]) << k
        self.cut_sequence, self.cut_windows = sequence, at // window
        self.last = powers(at % window)                     # lengths of the last sequences
        self.sequences = sequence + self.cut_windows + len(self.last)

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whole, sequence, offset) of tails; the last two hold for whole ones only."""
        whole = rank < self.whole[size]
        sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        if whole.any():
            s, r = size[whole].astype(np.int64), rank[whole]
            at = np.searchsorted(self.size << 44 | self.first, s << 44 | r, side="right") - 1
            copy, slot = np.divmod(r - self.first[at], self.times[at])
            sequence[whole], offset[whole] = self.sequence[at] + copy, self.offset[at] + slot * s
        return whole, sequence, offset

    def place_cut(self, size: int, rank: int) -> list[tuple[int, int, int]]:
        """(length, sequence, offset) of the pieces of a tail that is cut."""
        out = []
        for p in powers(size):
            at = self.cut_at[size, p] + (rank - int(self.whole[size])) * p
            n, offset = divmod(at, self.window)
            sequence = self.cut_sequence + n
            if n == self.cut_windows:
                for part in self.last:
                    if offset < part:
                        break
                    offset -= part
                    sequence += 1
            out.append((p, sequence, offset))
        return out


def _pieces(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = plan.window
        for batch in batches:
            col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            n, tail, rank, first = (col[c].to_numpy(zero_copy_only=False) for c in ("n", "tail", "rank", "window_rank"))
            whole, sequence, offset = plan.place(tail, rank)
            row, out = [], []
            for i, crcs in enumerate(col["crcs"].to_pylist()):
                crc = np.frombuffer(crcs, "<u4").tolist()
                full = int(n[i]) // window
                at = full * window
                got = [(j * window, window, crc[j], plan.sequences + int(first[i]) + j, 0) for j in range(full)]
                if tail[i] and whole[i]:
                    got.append((at, int(tail[i]), crc[full], int(sequence[i]), int(offset[i])))
                elif tail[i]:
                    for j, (p, s, o) in enumerate(plan.place_cut(int(tail[i]), int(rank[i]))):
                        got.append((at, p, crc[full + 1 + j], s, o))
                        at += p
                row += [i] * len(got)
                out += got
            take = pa.array(row, pa.int64())
            start, length, crc, sequence, offset = (np.array(out, np.int64).reshape(-1, 5)).T
            yield pa.RecordBatch.from_arrays(
                [col["doc_id"].take(take), pa.array(start), pa.array(length), pa.array(crc), col["n"].take(take),
                 pa.array(sequence), pa.array(offset), col["text_key"].take(take)], schema=arrow_schema(_PIECE))
    return run


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and
    text_key, which tells rows with equal doc_id and different texts apart. ``window`` is a power of two."""
    if window < 2 or window & (window - 1):
        raise ValueError("window must be a power of two")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("text_key"), "text")
    counted = stored(rows.mapInArrow(_count(tokenizer, window, end), _COUNTED), "token-counts")
    # Per task and tail length, how many there are; length 0 stands for the whole windows.
    here = counted.groupBy("part", "tail").agg(F.count(F.lit(1)).alias("tails"),
                                               F.sum(F.expr(f"n div {window}")).alias("windows"))
    here = stored(here, "tail-counts")
    groups = here.where("tail > 0").select("part", "tail", F.col("tails").alias("of")).unionByName(
        here.groupBy("part").agg(F.sum("windows").alias("of")).withColumn("tail", F.lit(0)))
    before = F.sum("of").over(Window.partitionBy("tail").orderBy("part")) - F.col("of")
    starts = stored(groups.select(F.col("part").alias("p"), F.col("tail").alias("t"), before.alias("before")), "tail-starts")
    histogram = np.zeros(window, np.int64)
    for r in here.where("tail > 0").groupBy("tail").agg(F.sum("tails").alias("n")).collect():
        histogram[r["tail"]] = r["n"]
    windows = starts.where("t = 0").select(F.col("p").alias("wp"), F.col("before").alias("windows_before"))
    placed = (counted.join(starts.where("t > 0"), (F.col("part") == F.col("p")) & (F.col("tail") == F.col("t")), "left")
              .join(windows, F.col("part") == F.col("wp"), "left")
              .select("doc_id", "text_key", "n", "tail", "crcs",
                      (F.coalesce("before", F.lit(0)) + F.col("nth")).alias("rank"),
                      (F.col("windows_before") + F.col("window_nth")).alias("window_rank")))
    return placed.mapInArrow(_pieces(Plan(histogram, window)), _PIECE)


def _text_key():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def sequences(docs: DataFrame, pieces: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END,
              pad: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the ids of every sequence, padded to ``window`` unless their number is a
    power of two. Each different document is tokenized once more; a sequence is a group of one window."""
    end_id = np.array([end], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens.of(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            ids = [i + end_id for group in _slices(texts) for i in tokens.encode(group)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())],
                                             schema=arrow_schema("d long, k long, all_ids binary"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("sequence_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int64()))])
        for batch in batches:
            ids = []
            for parts in batch.column(1).to_pylist():
                got = np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int64)
                ids.append(got)
            n = [len(i) for i in ids]
            ids = [i if k & (k - 1) == 0 else np.append(i, np.full(window - k, pad, np.int64))
                   for i, k in zip(ids, n, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int64()))],
                                             schema=schema)

    one = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("text_key"), "text")
           .dropDuplicates(["doc_id", "text_key"]))
    known = one.mapInArrow(encode, "d long, k long, all_ids binary")
    cut = (pieces.join(known, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
           .select("sequence_id", F.struct("offset", F.expr(
               "substring(all_ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids")).alias("p")))
    grouped = cut.groupBy("sequence_id").agg(F.sort_array(F.collect_list("p")).alias("parts"))
    return grouped.mapInArrow(build, "sequence_id long, n_tokens long, ids array<long>")


def op12_packing(spark, sf_dir: str) -> DataFrame:
    """The pieces of every document, in sequences of 2048 tokens of the byte-level BPE vocabulary."""
    import public_tokenizers
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
