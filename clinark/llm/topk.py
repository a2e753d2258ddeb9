"""Exact top-k inner products by term-at-a-time accumulation (op 4).

Vectors become integer weights; a dimension is a term, and a candidate block stores for
each term its postings (positions and weights of non-zero components). A query row walks
its non-zero terms and scatters ``query weight * posting weight`` into a dense score array
of the block; a partition selection keeps the best k, and the blocks' lists are merged.

Distribution: candidates are packed into blocks of ``CANDIDATE_BLOCK`` rows, queries into
blocks of ``QUERY_BLOCK`` rows. The query blocks are copied once per stripe and joined to
the candidate blocks of that stripe, so a task holds two blocks at a time whatever the
tables' sizes. A task merges the lists of the blocks it has seen before it sends them on.

Defined cases: a vector that is NULL or has a NULL or non-finite component takes no part;
vectors of other lengths score over the shared dimensions (missing ones are 0); rows that
repeat vec_id and vector count once; a row never matches its own vec_id; ties go to the
smaller vec_id; fewer than k candidates give fewer rows; empty tables give none. Weights
must fit in 31 bits and scores in 63 bits (|x| < 2**20 at 64 dimensions is far inside).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinark.llm.common import read_table

SCALE = 1024
K = 10
CANDIDATE_BLOCK = 2048
QUERY_BLOCK = 256
STRIPES = 64
MERGE_QUERIES = 1 << 14
#: A term whose postings cover this share of a block is added as one dense row.
DENSE = 0.5


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, w): floor(scale * x) of every usable vector, once per repeated row."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    bad = F.exists(F.col("x"), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
            .where(F.col("x").isNotNull() & F.col("vec_id").isNotNull()).where(~bad)
            .select("vec_id", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("w"))
            .distinct())


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` rows: ids, and the weights term by term."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        vectors: list[list[int]] = []

        def block():
            width = max(map(len, vectors))
            terms = np.zeros((width, len(ids)), np.int64)
            for i, v in enumerate(vectors):
                terms[:len(v), i] = v
            return pa.RecordBatch.from_pydict({"ids": [np.array(ids, np.int64).tobytes()], "terms": [terms.tobytes()]},
                                              schema=pa.schema([("ids", pa.binary()), ("terms", pa.binary())]))

        for batch in batches:
            for vec_id, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(vec_id)
                vectors.append(w)
                if len(ids) == size:
                    yield block()
                    ids, vectors = [], []
        if ids:
            yield block()

    return rows.mapInArrow(pack, "ids binary, terms binary")


def _block(ids: bytes, terms: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(terms, np.int64).reshape(-1, len(i))


def postings(terms: np.ndarray) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """Per term: (positions, weights); positions None means one weight for every row."""
    out = []
    for row in terms:
        at = np.flatnonzero(row)
        out.append((None, row) if len(at) > DENSE * len(row) else (at, row[at]))
    return out


def accumulate(query: np.ndarray, lists: list, size: int) -> np.ndarray:
    """Dense scores of one sparse query row over a block."""
    scores = np.zeros(size, np.int64)
    for term in np.flatnonzero(query[:len(lists)]):
        at, weight = lists[term]
        if at is None:
            scores += query[term] * weight
        else:
            scores[at] += query[term] * weight
    return scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score down, id up): selection, then a sort of the few kept."""
    if len(scores) > k:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= bound)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for frames of (vec_id, w)."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def flush():
            ids = np.repeat(np.array(list(found), np.int64), [len(v[0]) for v in found.values()])
            rows = [np.concatenate([v[j] for v in found.values()]) for j in (0, 1)]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(rows[0]), pa.array(rows[1])], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q_terms = _block(row["q_ids"], row["q_terms"])
                c_ids, c_terms = _block(row["ids"], row["terms"])
                lists = postings(c_terms)
                for i, query in zip(q_ids.tolist(), q_terms.T, strict=True):
                    scores = accumulate(query, lists, len(c_ids))
                    other = np.flatnonzero(c_ids == i)
                    ids = c_ids
                    if len(other):
                        scores, ids = np.delete(scores, other), np.delete(c_ids, other)
                    if i in found:
                        ids, scores = np.concatenate([found[i][0], ids]), np.concatenate([found[i][1], scores])
                    keep = best(scores, ids, k)
                    found[i] = ids[keep], scores[keep]
                if len(found) >= MERGE_QUERIES:
                    yield flush()
        if found:
            yield flush()

    q = (_packed(queries.dropDuplicates(["vec_id"]), QUERY_BLOCK).withColumnsRenamed({"ids": "q_ids", "terms": "q_terms"})
         .withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(STRIPES - 1)))))
    c = _packed(candidates, CANDIDATE_BLOCK).withColumn("stripe", F.pmod(F.xxhash64("ids"), F.lit(STRIPES)).cast("int"))
    lists = q.join(c, "stripe").select("q_ids", "q_terms", "ids", "terms").mapInArrow(
        score, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_topk(spark, sf_dir: str) -> DataFrame:
    """Queries: rows with vec_id divisible by 100; candidates: every other row."""
    rows = quantised(read_table(spark, sf_dir, "embeddings"))
    return top_k(rows.where("vec_id % 100 = 0"), rows)
