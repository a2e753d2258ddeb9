"""Quality classifier: a byte-level convolutional network in numpy (op 6).

A filter looks at ``WIDTH`` bytes and has one learned weight per place and byte value, so
the convolution over one-hot bytes is a sum of table rows; it is taken every ``STRIDE``
bytes of the whole text. Overlapping chunks of ``CHUNK`` bytes, one each ``CHUNK_STEP``, are
max-pooled per filter; the chunks' mean and maximum enter a logistic output, so every
byte of a document of any length takes part.

Learning: Adam on a bounded, hash-drawn sample (``PER_CLASS`` documents a class), on their whole
texts by the same forward pass as scoring, gradients by hand: max-pooling sends them to one
place per filter and chunk. The sample is written to the shared folder; an epoch is one task
that streams it in a hashed order, minibatch by minibatch, so neither it nor the driver holds more
texts than that. The classes' true shares correct the balanced sample.

Defined cases: NULL and empty texts are one chunk of zero bytes; without labels of both
classes every score is the learned class share; NULL or repeated ids are scored like any
row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinark.llm.common import arrow_schema, chunks, fold, read_table, stored, text_bytes
from clinark.llm.samples import labelled

WIDTH, STRIDE, FILTERS = 8, 4, 16
CHUNK, CHUNK_STEP = 512, 384
PER_CLASS = 2500
EPOCHS, MINIBATCH, RATE = 10, 32, 0.01
THRESHOLD = 0.7
SEED = 6


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows laid out on multiples of the stride with zero bytes after each, and their places count."""
    size = np.diff(offsets)
    places = np.maximum(-(-size // STRIDE), 1)
    room = (places + WIDTH // STRIDE) * STRIDE
    begin = np.concatenate([[0], np.cumsum(room)])
    out = np.zeros(begin[-1] + WIDTH, np.uint8)
    out[np.arange(len(data)) + np.repeat(begin[:-1] - offsets[:-1], size)] = data
    return out, np.stack([begin[:-1] // STRIDE, places])


def responses(raw: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Filter sums at every place: (places, filters)."""
    places = (len(raw) - WIDTH) // STRIDE
    out = np.zeros((places, tables.shape[2]), np.float32)
    for j in range(WIDTH):
        out += tables[j][raw[j:j + places * STRIDE:STRIDE]]
    return out


def chunk_ranges(first: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end place of every overlapping chunk, and the chunks' row bounds."""
    step, width = CHUNK_STEP // STRIDE, CHUNK // STRIDE
    n = np.maximum(-(-(places - width) // step), 0) + 1
    bounds = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(n)), n)
    start = first[row] + (np.arange(bounds[-1]) - bounds[row]) * step
    return start, np.minimum(start + width, (first + places)[row]), bounds


def convolved(data: np.ndarray, offsets: np.ndarray, tables: np.ndarray):
    """Padded bytes, filter sums at every place, and the chunks' start, end and row bounds."""
    raw, (first, places) = padded(data, offsets)
    return raw, responses(raw, tables), *chunk_ranges(first, places)


def pooled(data: np.ndarray, offsets: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Max-pooled chunk vectors of a batch of rows, and the rows' bounds in them."""
    _, found, start, end, bounds = convolved(data, offsets, tables)
    found = np.concatenate([found, np.zeros((1, found.shape[1]), np.float32)])
    return np.maximum.reduceat(found, np.stack([start, end], axis=1).ravel(), axis=0)[::2], bounds


def document_vectors(pools: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    active = np.tanh(pools)
    mean = np.add.reduceat(active, bounds[:-1], axis=0) / np.diff(bounds)[:, None]
    return np.concatenate([mean, np.maximum.reduceat(active, bounds[:-1], axis=0)], axis=1)


def gradients(model: dict, data: np.ndarray, offsets: np.ndarray, y: np.ndarray) -> tuple[dict, float]:
    """The gradient of the mean log loss of some rows, and that loss."""
    raw, found, start, end, bounds = convolved(data, offsets, model["tables"])
    top = np.stack([found[a:b].argmax(axis=0) + a for a, b in zip(start.tolist(), end.tolist(), strict=True)])
    filters = np.arange(found.shape[1])
    pools = found[top, filters]
    n = np.diff(bounds)
    vector, active = document_vectors(pools, bounds), np.tanh(pools)
    z = vector @ model["out"] + model["bias"]
    error = ((1 / (1 + np.exp(-z)) - y) / len(y)).astype(found.dtype)
    row = np.repeat(np.arange(len(y)), n)
    mean, peak = model["out"][:len(filters)], model["out"][len(filters):]
    back = error[row, None] * mean / n[row, None]
    # The maximum's gradient goes to the first chunk that reaches it.
    first = np.full((len(y), len(filters)), len(row))
    np.minimum.at(first, row, np.where(active == vector[row, len(filters):], np.arange(len(row))[:, None], len(row)))
    back[first, filters] += error[:, None] * peak
    back *= 1 - active ** 2
    table = np.zeros_like(model["tables"])
    for j in range(WIDTH):
        np.add.at(table[j], (raw[top * STRIDE + j], filters[None, :]), back)
    loss = float(np.mean(np.logaddexp(0, z) - y * z))
    return {"tables": table, "out": vector.T @ error, "bias": error.sum(keepdims=True)}, loss


def fresh_model(seed: int = SEED) -> dict:
    rng = np.random.default_rng(seed)
    return {"tables": rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32),
            "out": rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32), "bias": np.zeros(1, np.float32)}


class Adam:
    """A model and its moments, moved by gradients."""

    def __init__(self, model: dict) -> None:
        self.model, self.turn = model, 0
        self.first = {k: np.zeros_like(v) for k, v in model.items()}
        self.second = {k: np.zeros_like(v) for k, v in model.items()}

    def step(self, grad: dict) -> None:
        self.turn += 1
        for k, decay in (("tables", 1e-5), ("out", 1e-4), ("bias", 0.0)):
            g = grad[k] + np.float32(decay) * self.model[k]
            self.first[k] = 0.9 * self.first[k] + 0.1 * g
            self.second[k] = 0.99 * self.second[k] + 0.01 * g ** 2
            step = self.first[k] / (1 - 0.9 ** self.turn) / (np.sqrt(self.second[k] / (1 - 0.99 ** self.turn)) + 1e-6)
            self.model[k] = self.model[k] - (RATE * step).astype(np.float32)


def _epoch(state: Adam):
    """(state): the state after one pass over the rows (y, text) in their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(0).to_numpy().astype(np.float32)
            data, offsets = text_bytes(batch.column(1))
            for a in range(0, len(batch), MINIBATCH):
                b = min(a + MINIBATCH, len(batch))
                grad, _ = gradients(state.model, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], y[a:b])
                state.step(grad)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], schema=arrow_schema("state binary"))
    return run


def learn(docs: DataFrame, labels: DataFrame, learn_rows, per_class: int = PER_CLASS, epochs: int = EPOCHS) -> dict:
    """A model from the learning rows; ``shift`` moves the balanced sample's log-odds to the true shares."""
    drawn, share = labelled(docs, labels, "quality", learn_rows, per_class)
    rows = stored(drawn.select(F.col("y").cast("long").alias("y"), "text", "doc_id"), "quality-sample")
    count = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = float(np.log(share[1] / share[0]))
    if not (count.get(0) and count.get(1)):
        return {"tables": np.zeros((WIDTH, 256, FILTERS), np.float32), "out": np.zeros(2 * FILTERS, np.float32),
                "bias": np.zeros(1, np.float32), "shift": prior}
    state = Adam(fresh_model())
    for turn in range(epochs):
        order = rows.coalesce(1).sortWithinPartitions(F.xxhash64(F.lit(SEED + turn), "doc_id", "text"), "doc_id")
        state = pickle.loads(bytes(order.select("y", "text").mapInArrow(_epoch(state), "state binary").first()["state"]))
    return state.model | {"shift": prior - float(np.log(count[1] / count[0]))}


def _score(model: dict):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                pools, bounds = pooled(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], model["tables"])
                z = document_vectors(pools, bounds) @ model["out"] + model["bias"] + model["shift"]
                p = 1 / (1 + np.exp(-z.astype(np.float64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(p)],
                                                 schema=arrow_schema("doc_id long, score double"))
    return score


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score(model), "doc_id long, score double")


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    found = score(docs, learn(docs, read_table(spark, sf_dir, "labels"), ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
