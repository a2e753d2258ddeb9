"""Masked pseudo-likelihood of documents by a bidirectional window network in numpy (op 9).

Every token is masked in turn and predicted from the tokens on both sides; a document's
score is the sum of the conditional log-probabilities. A token's probability has two
factors: its class given the window, from the network (embeddings of ``SIDE`` tokens on
each side, a tanh layer, a softmax over ``CLASSES``), and the token given its class, from
counts over all documents. The most frequent tokens are classes of their own, the others
share the rest by hash; tokens are words by a 64-bit hash, and only the classes are fixed.

Corpus statistics: token counts of every document, summed in Spark to a table with a row
for each token, however many there are. A class without a token of its own keeps a mass of
``SMOOTH`` for a token never counted. The driver holds the ``OWN`` tokens and the classes'
masses. Texts are split into words twice: for the counts, and once the classes are known to
write each row's classes (a byte a token), which training and scoring read. Training: every
task runs minibatch descent over its share of the documents, all of them, from the same
weights; the weights are averaged by token counts in Spark (local descent with model
averaging, ``ROUNDS`` times), so what is gathered grows with the input and what reaches the
driver is one set of weights.

Scoring: with its classes a row holds its distinct tokens and their counts, as places in the
list of distinct tokens of a group of rows (``GROUP`` bytes of text). The groups' lists are
joined to the table; then a group's rows get their class log-probabilities and add up.

Defined cases: NULL or wordless texts have no tokens, likelihood 0 and a NULL mean; a
one-token text is predicted from padding; NULL or repeated ids are scored like any row; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinark.llm.common import NOT_BLANK, arrow_schema, chunks, read_table, row_words, stored, text_bytes

CLASSES, OWN = 128, 96
SIDE, WIDTH, HIDDEN = 2, 12, 32
ROUNDS, MINIBATCH, RATE = 2, 256, 0.2
SEED = 9
SMOOTH = 0.5
COUNTED = 1 << 20
CACHED = 1 << 17        # bytes whose 8-byte arrays stay in a core's cache
GROUP = 16 << 20
RANGE = 60              # exp of +-RANGE and sums of CLASSES of them are float32 numbers


def buckets_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens (64-bit word hashes) of a chunk of texts and the rows' bounds in them."""
    tokens, bounds, n = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
    for a, b in chunks(offsets, CACHED):
        hashes, ends = row_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], NOT_BLANK)
        tokens.append(hashes)
        bounds.append(ends[1:] + n)
        n += len(hashes)
    return np.concatenate(tokens).view(np.int64), np.concatenate(bounds)


def _rows(batch: pa.RecordBatch, column: int):
    data, offsets = text_bytes(batch.column(column))
    for a, b in chunks(offsets):
        yield a, b, *buckets_of(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token counts, added up while they are at most ``COUNTED`` tokens."""
    schema = arrow_schema("token long, n long")
    parts, held, waiting = [], 0, 0
    for batch in batches:
        for _, _, tokens, _ in _rows(batch, 0):
            parts.append(np.unique(tokens, return_counts=True))
            waiting += len(parts[-1][0])
            if waiting > held:                            # merged when the new lists outgrow the merged one
                parts = [_merged(parts)]
                held, waiting = len(parts[0][0]), 0
            if held > COUNTED:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], schema=schema)
                parts, held = [], 0
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(parts)], schema=schema)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    tokens, which = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
    n = np.bincount(which, weights=np.concatenate([n for _, n in parts]), minlength=len(tokens))
    return tokens, n.astype(np.int64)


class Classes:
    """Classes by token: the most frequent tokens have one each, the others share the rest by hash."""

    def __init__(self, own: np.ndarray):
        self.rank = np.argsort(own)
        self.own = own[self.rank]
        self.may_own = np.zeros(1 << 16, bool)            # by a token's highest 16 bits
        self.may_own[own.view(np.uint64) >> np.uint64(48)] = True

    def __getitem__(self, tokens: np.ndarray) -> np.ndarray:
        bits = tokens.view(np.uint64)
        out = ((bits >> np.uint64(40)).astype(np.uint32) % np.uint32(CLASSES - OWN) + np.uint32(OWN)).astype(np.uint8)
        if len(self.own):
            some = np.flatnonzero(self.may_own[(bits >> np.uint64(48)).view(np.int64)])
            at = np.minimum(np.searchsorted(self.own, tokens[some]), len(self.own) - 1)
            known = self.own[at] == tokens[some]
            out[some[known]] = self.rank[at[known]]
        return out


def shared_class(token: str):
    """The class of a token that has none of its own, as ``Classes`` gives it."""
    return F.lit(OWN) + (F.shiftrightunsigned(token, 40) % (CLASSES - OWN)).cast("int")


class InClass:
    """Log-probability of tokens given their class: a table (token, n) in Spark, and each class's mass."""

    def __init__(self, table: DataFrame, cls: Classes, mass: np.ndarray):
        self.table, self.cls, self.mass = table, cls, mass

    def joined(self, rows: DataFrame) -> DataFrame:
        """``rows`` (token, ...) of tokens without a class of their own, with log_p."""
        mass = F.get(F.array(*(F.lit(float(x)) for x in self.mass[OWN:])), shared_class("token") - OWN)
        return rows.join(self.table.hint("shuffle_hash"), "token", "left").withColumn(
            "log_p", F.log((F.coalesce("n", F.lit(0)) + F.lit(SMOOTH)) / mass)).drop("n")

    def __getitem__(self, tokens: np.ndarray) -> np.ndarray:
        """The log-probabilities of a few tokens, on the driver."""
        own = np.unique(tokens[self.cls[tokens] >= OWN])
        rows = self.table.sparkSession.createDataFrame([(int(t),) for t in own], "token long")
        found = {r["token"]: r["log_p"] for r in self.joined(rows).collect()}
        return np.array([found.get(t, 0.0) for t in tokens.tolist()])


def class_tables(counts: DataFrame) -> tuple[Classes, InClass]:
    """(classes, log-probability given the class) from the counts (token, n) of all tokens."""
    top = counts.orderBy(F.desc("n"), "token").limit(OWN).toArrow().column("token").to_numpy()
    others = counts.where(~F.col("token").isin(top.tolist())) if len(top) else counts
    got = others.groupBy(shared_class("token").alias("c")).agg(
        F.sum(F.col("n") + F.lit(SMOOTH)).alias("mass")).toArrow()
    mass = np.full(CLASSES, SMOOTH)
    mass[got.column("c").to_numpy()] += got.column("mass").to_numpy()
    cls = Classes(top)
    return cls, InClass(others, cls, mass)


def new_weights(seed: int = SEED) -> dict[str, np.ndarray]:
    """Random weights; the last row of ``out`` is the classes' bias."""
    rng = np.random.default_rng(seed)
    shapes = {"embed": (CLASSES + 1, WIDTH), "hidden": (2 * SIDE * WIDTH, HIDDEN), "hidden_bias": (HIDDEN,),
              "out": (HIDDEN, CLASSES), "out_bias": (1, CLASSES)}
    scale = {"embed": 0.3, "hidden": 0.15, "out": 0.15}
    new = {k: (rng.normal(0, scale[k], s) if k in scale else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
    return new | {"out": np.concatenate([new["out"], new.pop("out_bias")])}


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights.values()])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, w in new_weights().items():
        out[k] = values[at:at + w.size].reshape(w.shape).astype(np.float32)
        at += w.size
    return out


def windows(classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Classes of the ``SIDE`` tokens before and after each token; padding beyond the row."""
    rows = len(bounds) - 1
    at = np.arange(len(classes)) + np.repeat(SIDE * np.arange(1, rows + 1), np.diff(bounds))
    padded = np.full(len(classes) + SIDE * (rows + 1), CLASSES, np.uint8)
    padded[at] = classes
    out = np.empty((len(classes), 2 * SIDE), np.uint8)
    for j, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        out[:, j] = padded[at + step]
    return out


class Room:
    """The arrays of a minibatch, made once: a step then allocates next to nothing."""

    def __init__(self, size: int = MINIBATCH):
        def floats(*shape):
            return np.empty(shape, np.float32)
        self.x, self.h, self.z = floats(size, 2 * SIDE, WIDTH), floats(size, HIDDEN + 1), floats(size, CLASSES)
        self.slope, self.back, self.into = floats(size, HIDDEN + 1), floats(size, HIDDEN), floats(size, 2 * SIDE * WIDTH)
        self.out, self.out_t = floats(HIDDEN + 1, CLASSES), floats(CLASSES, HIDDEN)
        self.pair = np.empty((size, 2 * SIDE, WIDTH // 2), np.int64)
        self.start = np.arange(size) * CLASSES
        self.ones = np.ones(max(size, CLASSES), np.float32)


#: Places of a class's embedding in the table seen as pairs of floats.
_PAIRS = np.arange((CLASSES + 1) * WIDTH // 2).reshape(CLASSES + 1, WIDTH // 2)


def _by_halves(a: np.ndarray, b: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``a @ b`` in two products small enough for the BLAS kernel that need not repack them."""
    half = len(a) // 2
    np.matmul(a[:half], b, out=out[:half])
    np.matmul(a[half:], b, out=out[half:])
    return out


def forward(weights: dict, around: np.ndarray, room: Room) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embeddings, hidden layer with a 1 for the bias, scores of the classes but for a summand a row), in ``room``."""
    n = len(around)
    x = np.take(weights["embed"], around, axis=0, out=room.x[:n], mode="clip").reshape(n, -1)
    h = room.h[:n]
    inner = np.matmul(x, weights["hidden"], out=h[:, :HIDDEN])
    inner += weights["hidden_bias"]
    h[:, HIDDEN] = 0
    np.tanh(h, out=h)
    h[:, HIDDEN] = 1
    z = _by_halves(h, weights["out"], room.z[:n])
    if z.max() > RANGE or z.min() < -RANGE:
        z -= z.max(axis=1, keepdims=True)
    return x, h, z


def descend(weights: dict, around: np.ndarray, target: np.ndarray, rate: float, room: Room | None = None) -> None:
    """One minibatch step, in place."""
    n, room = len(target), room or Room(len(target))
    around = around.astype(np.intp)
    x, h, p = forward(weights, around, room)
    np.exp(p, out=p)
    total = p @ room.ones[:CLASSES]
    p.reshape(-1)[room.start[:n] + target] -= total
    share = (np.float32(rate / n) / total)[:, None]       # what p lacks of the gradient; h and slope are smaller
    slope = np.multiply(h, h, out=room.slope[:n])
    np.subtract(1, slope, out=slope)
    slope *= share
    room.out_t[:] = weights["out"][:HIDDEN].T
    back = _by_halves(p, room.out_t, room.back[:n])
    back *= slope[:, :HIDDEN]
    into = np.matmul(back, weights["hidden"].T, out=room.into[:n])
    h *= share
    weights["out"] -= _by_halves(h.T, p, room.out)
    weights["hidden"] -= x.T @ back
    weights["hidden_bias"] -= room.ones[:n] @ back
    # Pairs of floats are subtracted as complex numbers: half as many steps.
    pair = np.take(_PAIRS, around, axis=0, out=room.pair[:n], mode="clip")
    np.subtract.at(weights["embed"].reshape(-1).view(np.complex64), pair.reshape(-1), into.reshape(-1).view(np.complex64))


def class_log_probs(weights: dict, around: np.ndarray, target: np.ndarray) -> np.ndarray:
    out, room = np.empty(len(target)), Room()
    for a in range(0, len(target), MINIBATCH):
        own = target[a:a + MINIBATCH]
        _, _, z = forward(weights, around[a:a + MINIBATCH].astype(np.intp), room)
        picked = z.reshape(-1)[room.start[:len(own)] + own]
        np.exp(z, out=z)
        out[a:a + MINIBATCH] = picked - np.log(z @ room.ones[:CLASSES])
    return out


_ROWS = ("group long, chunk long, doc_id long, classes binary, places binary, counts binary, tokens array<long>")
_SCORES = "doc_id long, n_tokens long, log_likelihood double, mean_log_prob double"


def _blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of ``values`` by row: Spark moves them without a look at each value."""
    at = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(values)])


def _class_rows(cls: Classes):
    """Each row's classes, and its distinct tokens in the classes that are shared, with their counts.

    The tokens are places (int) in the sorted list of its group's, which the group's first row
    holds; groups and chunks bear the number of their first row.
    """
    def of_chunk(tokens: np.ndarray, bounds: np.ndarray):
        classes = cls[tokens]
        shared = classes >= OWN
        token, ends = tokens[shared], np.concatenate([[0], np.cumsum(shared)])[bounds]
        for a, b in zip(ends[:-1], ends[1:]):
            token[a:b].sort()
        new = np.zeros(len(token) + 1, bool)
        new[1:-1] = token[1:] != token[:-1]
        new[ends] = True                                  # where a row begins, and the end
        first = np.flatnonzero(new)
        return (classes, np.diff(bounds), token[first[:-1]], np.diff(first).astype(np.int32),
                np.diff(np.searchsorted(first, ends)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(0).to_numpy()
            data, offsets = text_bytes(batch.column(2))
            for a, b in chunks(offsets, GROUP):
                parts, at, chunk = [], offsets[a:b + 1], np.empty(b - a, np.int64)
                for i, j in chunks(at):
                    parts.append(of_chunk(*buckets_of(data[at[i]:at[j]], at[i:j + 1] - at[i])))
                    chunk[i:j] = number[a + i]
                classes, n_tokens, token, count, distinct = (np.concatenate(x) for x in zip(*parts))
                own, place = np.unique(token, return_inverse=True)
                bounds = np.concatenate([[0], np.cumsum(distinct)])
                first = np.full(b - a + 1, len(own), np.int32)
                first[0] = 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b - a, number[a])), pa.array(chunk), batch.column(1).slice(a, b - a),
                     _blobs(classes, np.concatenate([[0], np.cumsum(n_tokens)])), _blobs(place.astype(np.int32), bounds),
                     _blobs(count, bounds), pa.ListArray.from_arrays(pa.array(first), pa.array(own))],
                    schema=arrow_schema(_ROWS))
    return rows


def class_rows(docs: DataFrame, cls: Classes) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) as ``_class_rows`` gives them, written: their numbers stay."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(_class_rows(cls), _ROWS), "token-rows")


def _train(weights: dict, turn: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, room = {k: w.copy() for k, w in weights.items()}, 0, Room()
        rng = np.random.default_rng(SEED + turn)
        for batch in batches:
            classes, bounds = text_bytes(batch.column(1))
            edges = np.flatnonzero(np.diff(batch.column(0).to_numpy(), prepend=-1, append=-1))
            for a, b in zip(edges[:-1], edges[1:]):
                target = classes[bounds[a]:bounds[b]]
                order = rng.permutation(len(target))
                around, target = windows(target, bounds[a:b + 1] - bounds[a])[order], target[order]
                for i in range(0, len(order), MINIBATCH):
                    descend(own, around[i:i + MINIBATCH], target[i:i + MINIBATCH], RATE / (1 + turn), room)
                seen += len(target)
        if seen:
            values = flat(own).astype(np.float64) * seen
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values))), pa.array(values), pa.array(np.full(len(values), seen, np.int64))],
                schema=arrow_schema("slot long, w double, n long"))
    return train


def count_tokens(docs: DataFrame) -> tuple[Classes, InClass]:
    """(class of each token, log-probability of the token given its class)."""
    return class_tables(stored(docs.select("text").mapInArrow(_counts, "token long, n long")
                               .groupBy("token").agg(F.sum("n").alias("n")), "token-counts"))


def train(rows: DataFrame, rounds: int = ROUNDS) -> dict:
    """The network's weights, learned from all of ``class_rows``."""
    classes, weights = rows.select("chunk", "classes"), new_weights()
    for turn in range(rounds):
        mean = (classes.mapInArrow(_train(weights, turn), "slot long, w double, n long")
                .groupBy("slot").agg((F.sum("w") / F.sum("n")).alias("w")).toArrow())
        if len(mean):
            values = np.zeros(flat(weights).size)
            values[mean.column("slot").to_numpy()] = mean.column("w").to_numpy()
            weights = unflat(values)
    return weights


def learn(docs: DataFrame, rounds: int = ROUNDS) -> tuple[dict, Classes, InClass]:
    """(weights, class of each token, log-probability of the token given its class)."""
    cls, log_p = count_tokens(docs)
    return train(class_rows(docs.select(F.lit(0).alias("doc_id"), "text"), cls), rounds), cls, log_p


def _score(weights: dict):
    def score(rows: pa.Table, found: pa.Table) -> pa.Table:
        """Scores of a group's rows, with the log-probabilities of its tokens given their classes."""
        rows = rows.combine_chunks()
        classes, ends = text_bytes(rows.column("classes").chunk(0))
        total, n = np.zeros(len(rows)), np.diff(ends)
        for a, b in chunks(ends, COUNTED):
            target, bounds = classes[ends[a]:ends[b]], ends[a:b + 1] - ends[a]
            each = class_log_probs(weights, windows(target, bounds), target)
            total[a:b] = np.diff(np.concatenate([[0.0], np.cumsum(each)])[bounds])
        log_p = np.zeros(len(found))
        log_p[found.column("place").to_numpy()] = found.column("log_p").to_numpy()
        (places, at), (counts, _) = (text_bytes(rows.column(c).chunk(0)) for c in ("places", "counts"))
        row = np.repeat(np.arange(len(rows)), np.diff(at) // 4)
        total += np.bincount(row, weights=log_p[places.view(np.int32)] * counts.view(np.int32), minlength=len(rows))
        return pa.Table.from_arrays([rows.column("doc_id"), pa.array(n), pa.array(total),
                                     pa.array(total / np.maximum(n, 1), mask=n == 0)], schema=arrow_schema(_SCORES))
    return score


def score_rows(rows: DataFrame, weights: dict, log_p: InClass) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_prob) of every row of ``class_rows``."""
    tokens = rows.where(F.size("tokens") > 0).select("group", F.posexplode("tokens").alias("place", "token"))
    found = log_p.joined(tokens).select(F.col("group").alias("of"), "place", "log_p")
    return (rows.select("group", "doc_id", "classes", "places", "counts").groupBy("group")
            .cogroup(found.groupBy("of")).applyInArrow(_score(weights), _SCORES))


def pseudo_likelihood(docs: DataFrame, model) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_prob) of every row of ``docs`` (doc_id, text)."""
    weights, cls, log_p = model
    return score_rows(class_rows(docs, cls), weights, log_p)


def op9_lm_score(spark, sf_dir: str) -> DataFrame:
    """Masked pseudo-log-likelihood of every document under a network learned from the corpus."""
    docs = read_table(spark, sf_dir, "documents")
    cls, log_p = count_tokens(docs)
    rows = class_rows(docs, cls)
    return score_rows(rows, train(rows), log_p)
