"""Benchmark passages in training text by a distributed positional inverted index (op 10).

Index. Documents are cut into shards of bounded text; each shard stores, for every term
(64-bit word hash), the sorted positions of its tokens, with a gap between documents so
that no phrase runs over a document's end. The index is one Parquet row per shard in the
shared folder: document-partitioned, so a very frequent word is spread over all shards and
no shuffle is needed.

Search. The windows of the test items are packed into blocks of at most
``BLOCK_WINDOWS`` (a driver-side bound: about 10 MB), and each block is searched on every
shard. A window's terms are ordered by the length of their lists in the shard; the rarest
list, shifted by its offset, gives the candidate starts, and each further list (rarest
first) keeps those it confirms. A window with a term that the shard lacks costs nothing.
``slop`` = 0 gives exact phrases; a larger one accepts every term within that many
positions of its place (proximity matches).

Defined cases: NULL or wordless texts have no words and no hits; an item with fewer words
than a window is one window of its length; a wordless or NULL item has none; a NULL
item_id takes part as the empty string; repeated items count once by item_id, repeated
documents each; empty tables give no hits or no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from clinark.llm.common import chunks, read_table, row_words, stored, text_bytes

WINDOW = 10
GAP = 64
SHARD_BYTES = 2 << 20
BLOCK_WINDOWS = 100_000
#: Fixed value: word bytes are digits, lower-case letters and everything beyond ASCII.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True

_FOUND = "shard string, slot int, doc_id long, n_words long, spans array<struct<s:long,e:long>>, items array<string>"
_INDEX = "shard string, doc_ids binary, no_id binary, bounds binary, terms binary, starts binary, positions binary"


def from_spark(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return row_words(data, offsets, _WORD_OR_UPPER)


_WORD_OR_UPPER = WORD.copy()
_WORD_OR_UPPER[0x41:0x5B] = True


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, made = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids = batch.column(0)
        known = np.asarray(ids.is_valid())
        ids = ids.fill_null(0).to_numpy()
        data, offsets = text_bytes(batch.column(1))
        for a, b in chunks(offsets, SHARD_BYTES):
            words, bounds = _words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            place = np.arange(len(words)) + np.repeat(np.arange(b - a) * GAP, np.diff(bounds))
            order = np.argsort(words, kind="stable")
            terms, starts = np.unique(words[order], return_index=True)
            row = {"doc_ids": ids[a:b].astype(np.int64), "no_id": ~known[a:b], "bounds": bounds.astype(np.int64),
                   "terms": terms, "starts": np.append(starts, len(words)).astype(np.int32),
                   "positions": place[order].astype(np.uint32)}
            yield pa.RecordBatch.from_pydict(
                {"shard": [f"{part}-{made}"]} | {k: pa.array([v.tobytes()], pa.binary()) for k, v in row.items()})
            made += 1


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the postings of every token of every document; one row per shard."""
    return stored(docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_build, _INDEX), "positional-index")


def _item_windows(size: int):
    schema = pa.schema([("item_id", pa.string()), ("terms", pa.list_(pa.int64()))])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(0).to_pylist()
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                words, bounds = _words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                words = words.view(np.int64)
                for i in range(b - a):
                    own = words[bounds[i]:bounds[i + 1]]
                    found = [own[j:j + size] for j in range(max(1, len(own) - size + 1))] if len(own) else []
                    if found:
                        yield pa.RecordBatch.from_pydict({"item_id": [items[a + i]] * len(found), "terms": found},
                                                         schema=schema)
    return windows


def window_blocks(items: DataFrame, size: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The items' distinct windows in blocks of bounded size: (item ids, lengths, padded terms)."""
    rows = (items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
            .mapInArrow(_item_windows(size), "item_id string, terms array<long>").distinct())
    rows = stored(rows, "test-windows")
    blocks = max(1, -(-rows.count() // BLOCK_WINDOWS))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)))
    for block in range(blocks):
        got = rows.where(F.col("block") == block).select("item_id", "terms").toArrow()
        terms = [np.array(t, np.int64) for t in got.column("terms").to_pylist()]
        padded = np.zeros((len(terms), size), np.uint64)
        for i, t in enumerate(terms):
            padded[i, :len(t)] = t.view(np.uint64)
        yield np.array(got.column("item_id").to_pylist(), object), np.array([len(t) for t in terms], np.int64), padded


def match(windows: np.ndarray, lengths: np.ndarray, terms: np.ndarray, starts: np.ndarray, positions: np.ndarray,
          slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(window, start position) of every occurrence in one shard, by rarest-first list intersection."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(terms) or not len(windows):
        return none
    size = windows.shape[1]
    used = np.arange(size) < lengths[:, None]
    at = np.minimum(np.searchsorted(terms, windows), len(terms) - 1)
    count = np.where(terms[at] == windows, np.diff(starts)[at], 0)
    count = np.where(used, count, np.iinfo(np.int32).max)
    live = np.flatnonzero(count.min(axis=1) > 0)
    if not len(live):
        return none
    at, count, lengths = at[live], count[live], lengths[live]
    order = np.argsort(count, axis=1, kind="stable")
    # One sorted key per posting (term, position) of the terms asked for.
    needed = np.unique(at[used[live]])
    sizes = np.diff(starts)[needed]
    slot = np.repeat(np.arange(len(needed)), sizes)
    inner = np.arange(len(slot)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keys = (slot << 33) + positions[starts[needed][slot] + inner] + GAP
    slots = np.searchsorted(needed, at)
    first = order[:, 0]
    n = count[np.arange(len(live)), first]
    window = np.repeat(np.arange(len(live)), n)
    inner = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
    begin = positions[starts[at[window, first[window]]] + inner].astype(np.int64) - first[window]
    for turn in range(1, size):
        some = turn < lengths[window]
        if not some.any():
            break
        term = order[window, turn]
        wanted = (slots[window, term] << 33) + begin + term + GAP
        near = np.minimum(np.searchsorted(keys, wanted - slop), len(keys) - 1)
        ok = ~some | ((keys[near] >= wanted - slop) & (keys[near] <= wanted + slop))
        window, begin = window[ok], begin[ok]
    return live[window], begin


def _search(item_ids: np.ndarray, lengths: np.ndarray, windows: np.ndarray, slop: int):
    """Search one block of windows in every shard: merged hit spans and items of each document."""
    schema = from_spark(_FOUND)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = {c: batch.column(c)[at].as_buffer() for c in batch.schema.names if c != "shard"}
                ids, bounds = np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["bounds"], np.int64)
                starts = np.frombuffer(row["starts"], np.int32).astype(np.int64)
                terms, positions = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["positions"], np.uint32)
                docs, words = len(ids), np.diff(bounds)
                doc_start = bounds[:-1] + np.arange(docs) * GAP
                window, begin = match(windows, lengths, terms, starts, positions, slop)
                owner = np.searchsorted(doc_start + words + GAP // 2, begin, side="right")
                end = np.minimum(begin + lengths[window], (doc_start + words)[owner])
                begin = np.maximum(begin, doc_start[owner])
                step = np.zeros(int(bounds[-1]) + docs * GAP + 1, np.int32)
                np.add.at(step, begin, 1)
                np.add.at(step, end, -1)
                edge = np.diff(np.cumsum(step) > 0, prepend=False).nonzero()[0].reshape(-1, 2)
                items: list[set] = [set() for _ in range(docs)]
                spans: list[list] = [[] for _ in range(docs)]
                for d, i in set(zip(owner.tolist(), item_ids[window], strict=True)):
                    items[d].add(i)
                for d, (x, y) in zip(np.searchsorted(doc_start, edge[:, 0], side="right") - 1, edge, strict=True):
                    spans[d].append({"s": int(x - doc_start[d]), "e": int(y - doc_start[d])})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("shard")[at].as_py()] * docs), pa.array(np.arange(docs, dtype=np.int32)),
                     pa.array(ids, mask=np.frombuffer(row["no_id"], bool)), pa.array(words),
                     pa.array(spans, schema.field("spans").type), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                    schema=schema)
    return search


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside a found window), the hit spans and the items found."""
    index = build_index(docs)
    parts = [index.mapInArrow(_search(*block, slop), _FOUND) for block in window_blocks(items, size)]
    found = parts[0]
    if len(parts) > 1:                     # a document's rows, one per block of windows, come together
        every = reduce(DataFrame.unionByName, parts)
        found = every.groupBy("shard", "slot").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hit = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["end"]))).alias("n"),
                                F.greatest(acc["end"], x["e"]).alias("end")),
        lambda acc: acc["n"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), "spans", "items")


def op10_contamination(spark, sf_dir: str) -> DataFrame:
    """Words of every document that lie in an occurrence of a benchmark window, and the items."""
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
