"""Exact removal of repeated byte strings by a sparse, deep-shallow sorted suffix array (op 7).

What repeats. A byte goes if a ``LENGTH``-byte string (a window) over it also starts
anywhere else. Every window has one anchor: the position of its smallest ``CORE``-byte
hash (leftmost on ties), which depends on the window's bytes alone, so equal windows have
equal anchors. Runs of windows with one anchor form a segment of at most
2 * LENGTH - CORE bytes, and only the segments' anchors (about one in 150 positions) are
suffixes of the array; a window is the pair (l bytes to the left, LENGTH - l to the right).

1. Anchors: one pass over the texts gives (core hash, segment digest, place) per anchor.
2. Anchors whose core occurs once are dropped: nothing in them repeats. Segments that
   occur twice whole repeat whole, however many copies there are (a count, combined per
   task). What is left are cores with several different segments.
3. One copy of each such segment is sorted with the others of its core, once by the bytes
   right of the anchor and once by those left of it: multikey quicksort (8 bytes a step)
   to ``SHALLOW`` bytes, then blind tries order the groups that still agree. Cutting both
   orders at common-prefix lengths LENGTH - l and l gives classes, and two segments share
   the window at l if they agree in both classes. Cores with more than ``GROUP`` segments
   are first cut into narrower bands of l with a longer core, so that only segments that
   also agree there meet; a band that is still that large is cut into single windows, which
   are equal or not, so that they are counted (combined per task) and never meet.
4. The spans found go back to all anchors of the segment and are merged per document.

Passages. ``cut_text`` takes out, besides these strings, every passage of ``words`` words
(runs of bytes other than blank and \\x09-\\x0D, compared byte for byte with what is between
them) that occurs again, however few bytes it has. The steps are the same over words: a window
is ``words`` words, its anchor the word where its smallest hash of ``CORE_WORDS`` words starts,
and the arrays sort 64-bit digests of words and of what is between them. Cores with more than
``GROUP`` segments go to single windows at once.

Defined cases: a NULL text has 0 bytes; texts shorter than ``LENGTH`` lose nothing; rows
that repeat a doc_id are documents of their own (a NULL doc_id too); an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinark.llm.common import (NOT_BLANK, arrow_schema, chunks, prefix_hash, read_table, span_hash, stored, text_bytes,
                                word_spans)

LENGTH = 400
CORE = 100
CORE_WORDS = 13
PASSAGE_WORDS = 51
SHALLOW = 48
GROUP = 4096
BAND = 50
BATCH = 8192
BLOCK = 1 << 19
_POSITION = np.uint64((1 << 24) - 1)
_WORD_POSITION = np.uint64((1 << 32) - 1)

_ANCHOR = "core long, seg long, doc_id long, key long, start long, hi int, size int"
_SEGMENT = "core long, seg long, n long, hi int, content binary"
_WINDOW = "core long, seg long, at int, until int, digest long"


def _digest(content: bytes, salt: int = 0) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8, key=salt.to_bytes(2, "big")).digest(), "big", signed=True)


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, core: int = CORE):
    """(core hash, first window, last window, anchor) of every run of windows with one anchor."""
    prefix = prefix_hash(data)
    at = np.arange(len(data) - core + 1)
    grams = span_hash(prefix, at, at + core)
    low = window_minimum((grams & ~_POSITION) | at.astype(np.uint64), length - core + 1)
    step = np.zeros(len(data) + 2, np.int32)
    rows = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(step, offsets[rows], 1)
    np.add.at(step, offsets[rows + 1] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(step[:len(low)]))
    anchor = (low[window] & _POSITION).astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    return grams[anchor[first]], window[first], window[last], anchor[first]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        for a, b in chunks(offsets, BLOCK):
            lo, hi = int(offsets[a]), int(offsets[b])
            # A text beyond the block size is taken in blocks of windows; a run cut there is two runs.
            for at in range(lo, hi, BLOCK) if b == a + 1 else (lo,):
                end = min(hi, at + BLOCK + LENGTH - 1) if b == a + 1 else hi
                if end - at < LENGTH:
                    continue
                rows = np.clip(offsets[a:b + 1], at, end) - at
                piece = data[at:end]
                core, first, last, anchor = anchors(piece, rows)
                owner = np.searchsorted(rows, first, side="right") - 1
                raw = piece.tobytes()
                seg = [_digest(raw[x:y]) for x, y in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)]
                take = pa.array(owner + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(seg, pa.int64()), batch.column(0).take(take),
                     batch.column(1).take(take), pa.array(first + at - offsets[owner + a]),
                     pa.array((anchor - first).astype(np.int32)), pa.array((last - first + LENGTH).astype(np.int32))],
                    schema=arrow_schema(_ANCHOR))


def word_anchors(data: np.ndarray, offsets: np.ndarray, words: int):
    """(core hash, first byte, end byte, words left of the anchor, windows) of every run of windows with one anchor."""
    starts, ends = word_spans(data, offsets, NOT_BLANK)
    none = np.zeros(0, np.int64)
    if len(starts) < words:
        return none.astype(np.uint64), none, none, none, none
    at = np.arange(len(starts) - CORE_WORDS + 1)
    grams = span_hash(prefix_hash(data), starts[at], ends[at + CORE_WORDS - 1])
    low = window_minimum((grams & ~_WORD_POSITION) | at.astype(np.uint64), words - CORE_WORDS + 1)
    row = np.searchsorted(offsets, starts, side="right")
    window = np.flatnonzero(row[:len(low)] == row[words - 1:])
    anchor = (low[window] & _WORD_POSITION).astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    anchor, first, last = anchor[first], window[first], window[last]
    return grams[anchor], starts[first], ends[last + words - 1], anchor - first, last - first + 1


def _word_anchor_rows(words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for a, b in chunks(offsets, BLOCK):
                piece, bounds = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                core, first, end, hi, _ = word_anchors(piece, bounds, words)
                owner = np.searchsorted(bounds, first, side="right") - 1
                raw = piece.tobytes()
                seg = [_digest(raw[x:y]) for x, y in zip(first.tolist(), end.tolist(), strict=True)]
                take = pa.array(owner + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(seg, pa.int64()), batch.column(0).take(take),
                     batch.column(1).take(take), pa.array(first - bounds[owner]), pa.array(hi.astype(np.int32)),
                     pa.array((end - first).astype(np.int32))], schema=arrow_schema(_ANCHOR))
    return rows


# -- local sorting --------------------------------------------------------------------------

def _common(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    differ = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """A compacted trie that keeps branching bytes only; one full comparison per insertion."""

    def __init__(self):
        self.root: list | int | None = None          # an inner node is [depth, {byte: child}], a leaf an index

    def insert(self, index: int, strings: list[bytes]) -> None:
        text = strings[index]
        if self.root is None:
            self.root = index
            return
        node = self.root
        while isinstance(node, list):                # blind descent: any leaf below does
            depth, children = node
            node = children.get(text[depth] if depth < len(text) else -1)
            if node is None:
                node = next(iter(children.values()))
        other = strings[node if isinstance(node, int) else node[1][0]]
        shared = _common(text, other)
        byte, its = (s[shared] if shared < len(s) else -1 for s in (text, other))
        parent, node = None, self.root
        while isinstance(node, list) and node[0] < shared:
            depth, children = node
            parent, node = (children, text[depth] if depth < len(text) else -1), children[text[depth] if depth < len(text) else -1]
        if isinstance(node, list) and node[0] == shared:
            below = node[1].get(byte)
            if below is None:
                node[1][byte] = index
            else:                                    # only equal strings end in one place
                node[1][byte] = ("same", [*(below[1] if isinstance(below, tuple) else [below]), index])
            return
        if byte == its:                              # an equal string: share the leaf
            made: object = ("same", [*(node[1] if isinstance(node, tuple) else [node]), index])
        else:
            made = [shared, {its: node, byte: index}]
        if parent is None:
            self.root = made
        else:
            parent[0][parent[1]] = made

    def order(self) -> list[int]:
        out: list[int] = []
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            elif isinstance(node, tuple):
                out += node[1]
            elif node is not None:
                out.append(node)
        return out


def deep_shallow(strings: list[bytes], groups: np.ndarray, shallow: int = SHALLOW) -> np.ndarray:
    """Order of the strings by (group, bytes): multikey quicksort, then blind tries."""
    n = len(strings)
    order = np.argsort(groups, kind="stable")
    classes = np.cumsum(np.concatenate([[0], np.diff(groups[order]) != 0])) if n else order
    for depth in range(0, shallow, 8):
        size = np.bincount(classes)
        open_at = np.flatnonzero(size[classes] > 1)
        if not len(open_at):
            return order
        own = order[open_at]
        pieces = [strings[i][depth:depth + 8] for i in own]
        key = np.frombuffer(b"".join(p.ljust(8, b"\0") for p in pieces), ">u8").astype(np.uint64)
        ends = np.array([len(p) for p in pieces])       # a string that ends sorts before a zero byte
        by = np.lexsort((ends, key, classes[open_at]))
        order[open_at] = own[by]
        start = np.ones(n, bool)
        start[1:] = classes[1:] != classes[:-1]
        k, e = key[by], ends[by]
        here = open_at[1:][(k[1:] != k[:-1]) | (e[1:] != e[:-1])]
        start[here] = True
        classes = np.cumsum(start) - 1
    bounds = np.flatnonzero(np.concatenate([[True], np.diff(classes) != 0, [True]]))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a > 1:
            own = [strings[i][shallow:] for i in order[a:b]]
            trie = BlindTrie()
            for i in range(len(own)):
                trie.insert(i, own)
            order[a:b] = order[a:b][trie.order()]
    return order


def _class_source(strings: list[bytes], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order and each member's common prefix with the one before (-1 at a new group)."""
    order = deep_shallow(strings, groups)
    shared = [-1] + [_common(strings[x], strings[y]) for x, y in zip(order[:-1].tolist(), order[1:].tolist(), strict=True)]
    shared = np.array(shared, np.int64)
    shared[1:][np.diff(groups[order]) != 0] = -1
    return order, shared


def repeated_spans(contents: list[bytes], hi: np.ndarray, groups: np.ndarray, length: int = LENGTH):
    """First and last repeated window start in each segment (-1 where none), given different segments."""
    lo = hi - (np.array([len(c) for c in contents]) - length)
    right = [c[h:] for c, h in zip(contents, hi.tolist(), strict=True)]
    left = [c[:h][::-1] for c, h in zip(contents, hi.tolist(), strict=True)]
    return _shared_windows(right, left, lo, hi, groups, lambda cut: (length - cut, cut))


def repeated_passages(tokens: list[np.ndarray], hi: np.ndarray, groups: np.ndarray, words: int):
    """The same in words: a segment's tokens are its words and, between them, what separates them."""
    lo = hi - (np.array([len(t) // 2 + 1 for t in tokens]) - words)
    right = [t[2 * h:].tobytes() for t, h in zip(tokens, hi.tolist(), strict=True)]
    left = [t[:2 * h][::-1].tobytes() for t, h in zip(tokens, hi.tolist(), strict=True)]
    return _shared_windows(right, left, lo, hi, groups, lambda cut: (8 * (2 * (words - cut) - 1), 16 * cut))


def _shared_windows(right: list[bytes], left: list[bytes], lo: np.ndarray, hi: np.ndarray, groups: np.ndarray, least_of):
    """``least_of`` gives the bytes right and left of the anchor that a window at ``cut`` has."""
    n = len(right)
    right, left = _class_source(right, groups), _class_source(left, groups)
    top, bottom = np.full(n, -1), np.full(n, -1)
    for cut in range(int(lo.min()), int(hi.max()) + 1):
        rows = np.flatnonzero((lo <= cut) & (cut <= hi))
        if len(rows) < 2:
            continue
        key = np.zeros(n, np.int64)
        for (order, shared), least in zip((right, left), least_of(cut), strict=True):
            cls = np.empty(n, np.int64)
            cls[order] = np.cumsum(shared < least)
            key = key * (n + 1) + cls
        _, which, count = np.unique(key[rows], return_inverse=True, return_counts=True)
        again = rows[count[which] > 1]
        top[again] = cut
        bottom[again] = np.where(bottom[again] < 0, cut, bottom[again])
    return np.where(top < 0, -1, hi - top), np.where(bottom < 0, -1, hi - bottom)


def _byte_spans(contents: list[bytes], hi: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, last = repeated_spans(contents, hi, groups)
    return first, last + LENGTH


def _content_words(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    return word_spans(np.frombuffer(content, np.uint8), np.array([0, len(content)]), NOT_BLANK)


def _passage_spans(words: int):
    def spans(contents: list[bytes], hi: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places, tokens = [_content_words(c) for c in contents], []
        for content, (starts, ends) in zip(contents, places, strict=True):
            edges = np.empty(2 * len(starts), np.int64)
            edges[::2], edges[1::2] = starts, ends
            tokens.append(span_hash(prefix_hash(np.frombuffer(content, np.uint8)), edges[:-1], edges[1:]))
        first, last = repeated_passages(tokens, hi, groups, words)
        end = [p[1][w + words - 1] if w >= 0 else -1 for p, w in zip(places, last.tolist(), strict=True)]
        return np.array([p[0][w] if w >= 0 else -1 for p, w in zip(places, first.tolist(), strict=True)]), np.array(end)
    return spans


def _match(spans_of):
    return lambda batches: _matched(batches, spans_of)


def _matched(batches: Iterator[pa.RecordBatch], spans_of) -> Iterator[pa.RecordBatch]:
    """Segments sorted by core in; (core, seg, first, end) of what repeats out."""
    schema = arrow_schema("core long, seg long, s int, e int")
    held: list[tuple] = []

    def done(rows):
        core, seg, n, hi, content = zip(*rows, strict=True)
        hi, copies, size = np.array(hi, np.int64), np.array(n), np.array([len(c) for c in content])
        first, end = spans_of(list(content), hi, np.unique(np.array(core), return_inverse=True)[1])
        first, end = np.where(copies > 1, 0, first), np.where(copies > 1, size, end)
        keep = np.flatnonzero(first >= 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(core)[keep]), pa.array(np.array(seg)[keep]), pa.array(first[keep].astype(np.int32)),
             pa.array(end[keep].astype(np.int32))], schema=schema)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if len(held) >= BATCH and row[0] != held[-1][0]:
                yield done(held)
                held = []
            held.append(row)
    if held:
        yield done(held)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their wanted segments in; the segments' bytes out."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        for i, wanted in enumerate(batch.column(1).to_pylist()):
            text = data[offsets[i]:offsets[i + 1]]
            rows = [w | {"content": text[w["start"]:w["start"] + w["size"]].tobytes()} for w in wanted]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema(_SEGMENT))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut segments into bands of ``BAND`` window offsets whose core is all that their windows share."""
    schema = arrow_schema("core0 long, seg0 long, at int, core long, seg long, hi int, content binary")
    for batch in batches:
        for row in batch.to_pylist():
            hi, content = row["hi"], row["content"]
            low, out = hi - (len(content) - LENGTH), []
            for band in range(low // BAND, hi // BAND + 1):
                a, b = max(low, band * BAND), min(hi, band * BAND + BAND - 1)
                part = content[hi - b:hi - a + LENGTH]
                # The widest core that every window of the band has: [-band*BAND, LENGTH - (band+1)*BAND + 1).
                x = b - band * BAND
                shared = part[x:x + LENGTH - BAND + 1]
                out.append({"core0": row["core"], "seg0": row["seg"], "at": hi - b, "core": _digest(shared, band + 1),
                            "seg": _digest(part), "hi": x, "content": part})
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def repeats(docs: DataFrame, words: int | None = None) -> DataFrame:
    """(doc_id, key, spans): the byte spans of each document that repeat; key is the text's hash.
    Strings of ``LENGTH`` bytes, or passages of ``words`` words."""
    anchor_rows, spans_of, windows, larger = _anchor_rows, _byte_spans, _windows, _split_match
    if words is not None:
        if words <= CORE_WORDS:
            raise ValueError(f"passages need more than {CORE_WORDS} words")
        anchor_rows, spans_of, windows = _word_anchor_rows(words), _passage_spans(words), _word_windows(words)
        larger = lambda content: _window_match(content, windows)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    found = stored(keyed.mapInArrow(anchor_rows, _ANCHOR), "anchors")
    cores = (found.groupBy("core").agg(F.count(F.lit(1)).alias("c"), F.min("seg").alias("x"), F.max("seg").alias("y"))
             .where("c > 1").select("core", (F.col("x") != F.col("y")).alias("mixed")))
    # Written first: the adaptive planner splits a hot key only where both sides of a join are plain shuffles.
    shared = stored(found.join(stored(cores, "cores"), "core"), "shared-anchors")
    segments = shared.where("mixed").groupBy("core", "seg").agg(
        F.count(F.lit(1)).alias("n"), *(F.first(c).alias(c) for c in ("doc_id", "key", "start", "hi", "size")))
    wanted = segments.groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("core", "seg", "n", "start", "hi", "size")).alias("wanted"))
    same = keyed["doc_id"].eqNullSafe(wanted["doc_id"]) & (keyed["key"] == wanted["key"])
    content = stored(keyed.join(wanted, same).select("text", "wanted").mapInArrow(_slices, _SEGMENT)
                     .dropDuplicates(["core", "seg"]), "segments")
    outcome = stored(_by_size(content, larger, spans_of), "repeated-segments")
    whole = shared.where(~F.col("mixed")).select("doc_id", "key", "start", (F.col("start") + F.col("size")).alias("end"))
    part = shared.where("mixed").join(outcome, ["core", "seg"]).select(
        "doc_id", "key", (F.col("start") + F.col("s")).alias("start"), (F.col("start") + F.col("e")).alias("end"))
    return whole.unionByName(part).groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


def _window_rows(core: int, seg: int, content: bytes, at: list[int], until: list[int]) -> pa.RecordBatch:
    own = [_digest(content[i:j]) for i, j in zip(at, until, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array([core] * len(own), pa.int64()), pa.array([seg] * len(own), pa.int64()), pa.array(at, pa.int32()),
         pa.array(until, pa.int32()), pa.array(own, pa.int64())], schema=arrow_schema(_WINDOW))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of every window of the segments."""
    for batch in batches:
        for core, seg, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield _window_rows(core, seg, content, list(range(len(content) - LENGTH + 1)), list(range(LENGTH, len(content) + 1)))


def _word_windows(words: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for core, seg, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                starts, ends = _content_words(content)
                yield _window_rows(core, seg, content, starts[:len(starts) - words + 1].tolist(), ends[words - 1:].tolist())
    return windows


def _window_match(content: DataFrame, windows=_windows) -> DataFrame:
    """The same for cores of any number of segments: their windows are counted."""
    rows = stored(content.select("core", "seg", "content").mapInArrow(windows, _WINDOW), "windows")
    again = rows.groupBy("core", "digest").agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    found = (rows.join(stored(again, "repeated-windows"), ["core", "digest"]).groupBy("core", "seg")
             .agg(F.min("at").alias("s"), F.max("until").alias("e")))
    copies = content.where("n > 1").select("core", "seg", F.lit(0).alias("s"), F.octet_length("content").alias("e"))
    return found.join(copies.select("core", "seg"), ["core", "seg"], "left_anti").unionByName(copies)


def _sorted_match(content: DataFrame, spans_of) -> DataFrame:
    return (content.repartition("core").sortWithinPartitions("core").select("core", "seg", "n", "hi", "content")
            .mapInArrow(_match(spans_of), "core long, seg long, s int, e int"))


def _by_size(content: DataFrame, larger, spans_of=_byte_spans) -> DataFrame:
    """Cores of up to ``GROUP`` segments sorted, those of more given to ``larger``."""
    count = content.groupBy("core").agg(F.count(F.lit(1)).alias("c"))
    large = count.where(F.col("c") > GROUP).select("core")
    outcome = _sorted_match(content.join(large, "core", "left_anti"), spans_of)
    return outcome if large.isEmpty() else outcome.unionByName(larger(content.join(large, "core")))


def _split_match(content: DataFrame) -> DataFrame:
    """The same for cores with many segments: bands with longer cores, equal bands counted first."""
    bands = stored(content.select("core", "seg", "hi", "content", "n").mapInArrow(
        _bands, "core0 long, seg0 long, at int, core long, seg long, hi int, content binary"), "bands")
    one = stored(bands.groupBy("core", "seg").agg(F.count(F.lit(1)).alias("n"), F.first("hi").alias("hi"),
                                                  F.first("content").alias("content")), "band-segments")
    found = bands.drop("hi", "content").join(_by_size(one, _window_match), ["core", "seg"])
    spans = found.groupBy("core0", "seg0").agg(
        F.min(F.col("at") + F.col("s")).cast("int").alias("s"), F.max(F.col("at") + F.col("e")).cast("int").alias("e"))
    whole = content.where("n > 1").select("core", "seg", F.lit(0).alias("s"), F.octet_length("content").alias("e"))
    return (spans.withColumnsRenamed({"core0": "core", "seg0": "seg"}).join(whole.select("core", "seg"), ["core", "seg"], "left_anti")
            .unionByName(whole))


def _cut(text: np.ndarray, spans: list[dict]) -> tuple[bytes, int, int]:
    """(kept bytes, removed bytes, maximal removed runs) for sorted spans."""
    kept, at, removed, runs = [], 0, 0, 0
    for span in spans:
        if span["start"] > at or (runs == 0):
            kept.append(text[at:span["start"]].tobytes())
            runs += 1
            at = span["start"]
        if span["end"] > at:
            removed += span["end"] - at
            at = span["end"]
    kept.append(text[at:].tobytes())
    return b"".join(kept), removed, runs


def _result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        spans = batch.column(2)
        rows = [_cut(data[offsets[i]:offsets[i + 1]], spans[i].as_py() or []) for i in range(len(batch))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([hashlib.sha256(r[0]).hexdigest() for r in rows]),
             pa.array([r[0].decode("utf-8", "ignore") for r in rows])],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def _result_with_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same, and the text without the strings and the passages (both kinds of spans together)."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for out in _result(iter([batch])):
            texts = []
            for i, (strings, every) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                texts.append(_cut(data[offsets[i]:offsets[i + 1]], every.as_py())[0].decode("utf-8", "ignore")
                             if every.is_valid else batch.column(1)[i].as_py())
            yield pa.RecordBatch.from_arrays([*out.columns[:5], pa.array(texts, pa.string())],
                                             names=[*out.schema.names[:5], "text"])


def _merged(found: DataFrame) -> DataFrame:
    """All spans of a text as one sorted list."""
    return found.groupBy("doc_id", "key").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def dedup_text(docs: DataFrame, words: int | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans, kept_sha256 and kept_text (the
    remaining bytes as text; a character cut in two is left out of it, not of the digest). With ``words``,
    instead of kept_text, ``text``: the text without the strings and without passages of that many words."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    strings = repeats(docs)
    if words is not None:
        strings = stored(strings, "string-spans")
        every = _merged(strings.unionByName(repeats(docs, words))).withColumnRenamed("spans", "every")
        strings = every.join(
            strings.select(F.col("doc_id").alias("s_id"), F.col("key").alias("s_key"), "spans"),
            F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("key") == F.col("s_key")), "left").drop("s_id", "s_key")
    spans = strings.withColumnsRenamed({"doc_id": "r_id", "key": "r_key"})
    same = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key"))
    rows = keyed.join(spans, same, "left")
    contract = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if words is not None:
        return rows.select("doc_id", "text", "spans", "every").mapInArrow(_result_with_passages, f"{contract}, text string")
    return rows.select("doc_id", "text", "spans").mapInArrow(_result, f"{contract}, kept_text string")


def cut_text(docs: DataFrame, words: int | None = None) -> DataFrame:
    """``docs`` with every repeated byte string (and passage of ``words`` words) taken out of ``text``; other
    columns stay as they are."""
    names = docs.columns
    place = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(place))
            spans, old = batch.column(len(names)), batch.column(place)
            new = [_cut(data[offsets[i]:offsets[i + 1]], spans[i].as_py())[0].decode("utf-8", "ignore")
                   if spans[i].is_valid else old[i].as_py() for i in range(len(batch))]
            columns = batch.columns[:len(names)]
            columns[place] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    found = repeats(docs)
    if words is not None:
        found = _merged(found.unionByName(repeats(docs, words)))
    mark = max(map(len, names)) * "_"                      # own columns are longer than any of the user's
    spans = found.toDF(f"{mark}id", f"{mark}key", f"{mark}spans")
    same = F.col("doc_id").eqNullSafe(F.col(f"{mark}id")) & (F.xxhash64("text") == F.col(f"{mark}key"))
    return docs.join(spans, same, "left").drop(f"{mark}id", f"{mark}key").mapInArrow(cut, docs.schema)


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Bytes and runs removed from every document, and the digest of what is left, by its strings of ``LENGTH``
    bytes; ``text`` is without these and without passages of over 50 words that repeat."""
    return dedup_text(read_table(spark, sf_dir, "documents"), PASSAGE_WORDS)
