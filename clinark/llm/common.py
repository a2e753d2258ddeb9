"""Byte-level helpers shared by the operators: Arrow text access, word hashing, scratch tables.

Everything here works on one Arrow batch inside a Spark task. Texts are taken as UTF-8
bytes; a NULL text is an empty one. ``chunks`` cuts a batch into groups of rows of
bounded size so that the 8-byte arrays built from each byte stay small (one row larger
than the bound is a group of its own: a text is never cut).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinark.session import run_dir

CHUNK_BYTES = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.default_rng(0x5EED).integers(1, 1 << 63, 256, dtype=np.uint64)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet in the cluster's shared folder and read it back.

    This cuts the lineage on storage that outlives executors; the caller owns the folder.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark, purpose)}/{purpose}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: str, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod`` (the contract's folds)."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(mod))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, row offsets) of a string column; NULL rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    offsets = offsets.astype(np.int64) if len(offsets) else np.zeros(1, np.int64)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) holding at most ``limit`` bytes, or a single larger row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


class Powers:
    """Powers of the hash multiplier and of its inverse, grown when a longer text comes."""

    up = np.zeros(0, np.uint64)
    down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK_BYTES + (1 << 16))
            for name, base in (("up", _MULT), ("down", _INV)):
                power = np.full(size, base, np.uint64)
                power[0] = 1
                setattr(cls, name, np.cumprod(power, dtype=np.uint64))
        return cls.up, cls.down


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; ``span_hash`` gives the hash of any span from it."""
    up, _ = Powers.of(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = Powers.of(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of word bytes; runs end at row boundaries."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = is_word[data]
    step = np.diff(inside)
    starts, ends = step[:-1] > 0, step[1:] < 0
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    both = inside[edges] & inside[edges + 1] > 0          # a run that crosses rows
    starts[edges[both]] = True
    ends[edges[both] - 1] = True
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Words of the near-duplicate and mixing contracts are runs of bytes
#: other than blank and \x09-\x0D.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False


def row_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Lower-cased word hashes of a chunk, and each row's word offsets."""
    data = lower_ascii(data)
    starts, ends = word_spans(data, offsets, is_word)
    hashes = span_hash(prefix_hash(data), starts, ends)
    return hashes, np.searchsorted(starts, offsets)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(),
          "binary": pa.binary(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
          "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of "name type, name type, ..." (usable in tasks, where no session exists)."""
    return pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in ddl.split(", "))])
