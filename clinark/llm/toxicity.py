"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier (op 3).

Voters. Each says toxic (1), clean (-1) or nothing (0) of a whole text: a seed lexicon of
insults; mined lexicons, the tokens (words and letter 4-grams) whose document counts
in the learning rows lean to one class, dealt by hash into several voters a class; and
patterns (shouting, insulting address, repeated marks, a token that repeats).

Label model. EM over the votes of the sample estimates for both classes what each voter
says how often (its accuracy and coverage); the known label of a learning row is one more
noisy voter. Correlations are estimated from the votes' residuals given the class, and a
voter's log-odds are divided by its correlation mass, so that voters that repeat each other
do not count twice. The posterior labels train a logistic classifier on the tokens and votes.

Learning uses at most ``PER_CLASS`` documents a class (hash-drawn, whole texts); token counts
are made in Spark and the ``VOCABULARY`` most telling ones kept. Labels come from the learning
rows only; lang, source and doc_id enter nothing.

Defined cases: NULL and empty texts have no tokens and only the bias scores them; without
labels of both classes every score is the learned class share; NULL or repeated ids are
scored like any row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinark.llm.common import arrow_schema, fold, read_table, stored
from clinark.llm.samples import labelled

#: The seed lexicon.
INSULTS = ("idiot", "moron", "stupid", "loser", "clown", "scum", "trash", "pathetic", "worthless", "disgusting",
           "dumb", "imbecile", "filth", "vermin", "garbage")
PER_CLASS = 2500
VOCABULARY = 4000
MIN_DOCS = 4
GROUPS = 6
LEAN = 1.5
EM_ROUNDS = 25
LABEL_TRUST = 0.97
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")
_ADDRESS = re.compile(r"\b(?:you|du|tu|vous|usted)\b.{0,20}\b(?:are|bist|es|êtes|eres)\b", re.S)


def tokens(text: str | None) -> set[str]:
    """Distinct lower-case words, and the letter 4-grams inside them (marked, to stay apart from words)."""
    words = set(_WORD.findall((text or "").lower()))
    return words.union("-" + w[i:i + 4] for w in words for i in range(len(w) - 3))


def patterns(text: str | None, found: set[str]) -> list[int]:
    """Votes of the seed lexicon and of the pattern voters."""
    text = text or ""
    upper = sum(map(str.isupper, text))
    low = text.lower()
    return [1 if not found.isdisjoint(INSULTS) else 0,
            1 if upper * 2 > len(text) else 0,
            1 if _ADDRESS.search(low) else 0,
            1 if "!!!" in text or "???" in text else 0,
            -1 if 0 < len(found) * 20 < len(text.split()) else 0]


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = sorted(tokens(text))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([y] * len(own), pa.int64())],
                                             schema=arrow_schema("token string, y long"))


class Voters:
    """The vocabulary and the voters made of it."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.place = {token: i for i, (token, _) in enumerate(vocabulary)}
        self.group = {}
        for token, lean in vocabulary:
            if abs(lean) >= LEAN:
                side = 0 if lean > 0 else GROUPS
                self.group[token] = side + zlib.crc32(token.encode()) % GROUPS

    def look(self, text: str | None) -> tuple[list[int], list[int]]:
        """(vocabulary places, votes) of a whole text."""
        found = tokens(text)
        known = self.place.keys() & found
        votes = [0] * (2 * GROUPS)
        for token in known:
            g = self.group.get(token)
            if g is not None:
                votes[g] = 1 if g < GROUPS else -1
        return sorted(self.place[t] for t in known), votes + patterns(text, found)


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = EM_ROUNDS):
    """Posterior of label 1 for each row, the voters' say given the class, their correlations."""
    known = np.where(labels == 1, LABEL_TRUST, 1 - LABEL_TRUST)
    q = known.copy()
    weight = np.ones(votes.shape[1])
    say = corr = None
    for _ in range(rounds):
        share = np.stack([1 - q, q])                                       # class x row
        say = np.stack([(share @ (votes == v) + 0.5) / (share.sum(axis=1)[:, None] + 1.5) for v in (-1, 0, 1)])
        odds = np.log(say[:, 1]) - np.log(say[:, 0])                       # vote x voter
        mean = (share @ votes) / share.sum(axis=1)[:, None]
        residual = votes - (1 - q)[:, None] * mean[0] - q[:, None] * mean[1]
        spread = residual.std(axis=0) + 1e-9
        corr = (residual / spread).T @ (residual / spread) / len(votes)
        weight = 1 / (1 + np.abs(corr - np.diag(np.diag(corr))).sum(axis=1))
        z = np.log(known) - np.log(1 - known)
        z = z + sum(weight[j] * odds[votes[:, j] + 1, j] for j in range(votes.shape[1]))
        q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return q, say, corr


def fit_linear(features: np.ndarray, target: np.ndarray, ridge: float = 0.0003, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels (Nesterov steps; the bias is not shrunk)."""
    x = np.concatenate([features, np.ones((len(features), 1), np.float32)], axis=1)
    shrink = np.full(x.shape[1], ridge, np.float32)
    shrink[-1] = 0
    # A bound of the Gram matrix's largest eigenvalue by power iteration sets the step.
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v) + 1e-9
    rate = 1 / (0.25 * np.linalg.norm(x @ v) ** 2 / len(x) * 1.1 + ridge)
    w = ahead = np.zeros(x.shape[1], np.float32)
    for step in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - rate * (x.T @ (p - target).astype(np.float32) / len(x) + shrink * ahead)
        ahead = new + (step / (step + 3)) * (new - w)
        w = new
    return w[:-1].astype(np.float64), float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, learn_rows, per_class: int = PER_CLASS) -> dict:
    drawn, share = labelled(docs, labels, "toxic", learn_rows, per_class)
    rows = stored(drawn.select("doc_id", F.col("y").cast("long").alias("y"), "text"), "toxicity-sample")
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = float(np.log(share[1] / share[0]))
    if len(sizes) < 2:
        return {"voters": Voters([]), "weights": np.zeros(2 * GROUPS + 5), "bias": prior}
    n0, n1 = sizes[0], sizes[1]
    one, zero = F.col("one") + 0.5, F.col("docs") - F.col("one") + 0.5
    lean = F.log(one / (n1 + 1)) - F.log(zero / (n0 + 1))
    counted = (rows.select("y", "text").mapInArrow(_token_rows, "token string, y long").groupBy("token")
               .agg(F.sum("y").alias("one"), F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= MIN_DOCS)
               .select("token", lean.alias("lean"), "docs")
               .orderBy(F.desc(F.abs("lean") * F.sqrt("docs")), "token").limit(VOCABULARY))
    voters = Voters(sorted((r["token"], r["lean"]) for r in counted.collect()))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [voters.look(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([s[0] for s in seen], pa.list_(pa.int64())),
                 pa.array([s[1] for s in seen], pa.list_(pa.int64()))],
                schema=arrow_schema("doc_id long, y long, places array<long>, votes array<long>"))

    got = rows.mapInArrow(look, "doc_id long, y long, places array<long>, votes array<long>").toArrow().sort_by("doc_id")
    y, votes = got.column("y").to_numpy(), np.array(got.column("votes").to_pylist(), np.int64)
    features = np.zeros((len(y), len(voters.place) + votes.shape[1]), np.float32)
    for i, at in enumerate(got.column("places").to_pylist()):
        features[i, at] = 1
    features[:, len(voters.place):] = votes
    posterior, _, _ = label_model(votes, y)
    weights, bias = fit_linear(features, posterior)
    return {"voters": voters, "weights": weights, "bias": bias + prior - float(np.log(n1 / n0))}


def _score(model: dict):
    voters, weights, bias = model["voters"], model["weights"], model["bias"]
    words = len(voters.place)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = []
            for text in batch.column(1):
                places, votes = voters.look(text.as_py())
                z.append(bias + weights[places].sum() + weights[words:] @ votes)
            p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())],
                                             schema=arrow_schema("doc_id long, score double"))
    return score


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score(model), "doc_id long, score double")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labels outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    found = score(docs, learn(docs, read_table(spark, sf_dir, "labels"), ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
