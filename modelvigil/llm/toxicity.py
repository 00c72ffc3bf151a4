"""Toxicity: a linear classifier learnt from confirmed toxic and unlabelled texts with the non-negative risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelvigil.llm.common import held_out, map_columns, smallest_hashes, table
from modelvigil.llm.ngrams import word_features

#: Words, and beginnings of words of these lengths, hashed to ``2**BITS`` features.
PREFIXES, BITS = (4, 5), 20
#: Confirmed toxic and unlabelled documents that the classifier is fitted on.
POSITIVES, UNLABELLED = 4_000, 8_000
#: Features kept, and toxic documents that must have one.
FEATURES, SUPPORT = 4_096, 5
#: Class prior if the labels cannot tell it.
PRIOR = 0.1
ROUNDS, RATE, DECAY = 800, 0.05, 1e-5
TOXIC = 0.7


@dataclass
class Model:
    weights: np.ndarray  # over all slots
    bias: float

    def score(self, text: str | None) -> float:
        total = float(self.weights[word_features(text or "", PREFIXES, BITS)].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Rows:
    """Documents as sets of features; products with a weight vector, and weighted sums of rows."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.ends = np.cumsum([len(r) for r in rows])
        self.owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.slots = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
        self.n, self.width = len(rows), width

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights[self.slots], self.n)

    def gradient(self, by_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.slots, by_row[self.owner], self.width)


def risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, bool, np.ndarray, np.ndarray]:
    """Non-negative risk of the scores under the sigmoid loss, whether its negative part is below zero, and the
    gradients by score. Where the negative part is below zero, the step goes against it instead."""
    p, u = sigmoid(positive), sigmoid(unlabelled)
    as_positive, as_negative = float((1 - p).mean()), float(p.mean())
    negative = float(u.mean()) - prior * as_negative
    slope_p, slope_u = p * (1 - p) / len(p), u * (1 - u) / len(u)
    if negative < 0:
        return prior * as_positive, True, prior * slope_p, -slope_u
    return prior * as_positive + negative, False, -2 * prior * slope_p, slope_u


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Adam steps on the non-negative risk over the features that tell the two samples apart best."""
    size = 1 << BITS
    weights = np.zeros(size, dtype=np.float32)
    if not positive or not unlabelled:
        return Model(weights, -30.0)
    with_p = np.bincount(np.concatenate(positive), minlength=size)
    with_u = np.bincount(np.concatenate(unlabelled), minlength=size)
    rate_p, rate_u = with_p / len(positive), with_u / len(unlabelled)
    spread = np.sqrt(rate_p * (1 - rate_p) / len(positive) + rate_u * (1 - rate_u) / len(unlabelled)) + 1e-9
    telling = np.where(with_p >= min(SUPPORT, len(positive)), np.abs(rate_p - rate_u) / spread, 0.0)
    kept = np.sort(np.argsort(-telling, kind="stable")[:FEATURES])
    kept = kept[telling[kept] > 2]
    number = np.full(size, -1)
    number[kept] = np.arange(len(kept))
    p, u = (
        Rows([found[found >= 0] for found in (number[row] for row in rows)], len(kept)) for rows in (positive, unlabelled)
    )
    w, bias = np.zeros(len(kept)), -2.0
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for turn in range(1, ROUNDS + 1):
        _, _, by_p, by_u = risk(p.scores(w) + bias, u.scores(w) + bias, prior)
        gradient = np.append(p.gradient(by_p) + u.gradient(by_u) + DECAY * w, by_p.sum() + by_u.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        step = RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    weights[kept] = w
    return Model(weights, float(bias))


def learn(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
    prior: float | None = None,
) -> Model:
    """Model from documents that are not held out: those confirmed toxic, and any others as unlabelled.

    The samples are the ids with the smallest hashes, each with the smallest of its texts; only their features come to
    the driver.
    Without ``prior`` the share of toxic ones among all learnable labels is taken, or ``PRIOR`` if they are of one kind.
    Labels with a null id or a null ``toxic`` say nothing; an id with several labels is toxic if one says so.
    """
    marked = labels.where(~held_out() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marked = marked.agg(F.max("toxic").alias("toxic"))
    n, toxic = marked.agg(F.count(F.lit(1)), F.sum(F.col("toxic").cast("long"))).first()
    if prior is None:
        prior = toxic / n if n and 0 < toxic < n else PRIOR
    known = docs.where(~held_out() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    one = smallest_hashes(marked.where(F.col("toxic") == 1).select("doc_id"), positives).select("doc_id", F.lit(1).alias("kind"))
    other = smallest_hashes(known.select("doc_id"), unlabelled).select("doc_id", F.lit(0).alias("kind"))
    # Both samples are bounded by the parameters above.
    chosen = F.broadcast(one.union(other))

    def features(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            yield {
                "doc_id": batch["doc_id"], "kind": batch["kind"],
                "slots": [word_features(text, PREFIXES, BITS).astype("<i4").tobytes() for text in batch["text"]],
            }

    once = known.join(chosen, "doc_id").groupBy("doc_id", "kind").agg(F.min("text").alias("text"))
    sample = map_columns(
        once, ["doc_id", "kind", "text"], "doc_id long, kind int, slots binary", features,
        pa.schema([("doc_id", pa.int64()), ("kind", pa.int32()), ("slots", pa.binary())]),
    ).collect()
    sample.sort(key=lambda r: (r.doc_id, r.kind, r.slots))
    rows = [[np.frombuffer(r.slots, dtype="<i4") for r in sample if r.kind == kind] for kind in (1, 0)]
    return fit(*rows, prior)


def scored(docs: DataFrame, model: Model, toxic: float = TOXIC) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` of every whole text.

    A null text counts as empty. Repeated rows and null ids (held out) come as they are. Other columns are not read.
    """
    out = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()),
    ])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            scores = [model.score(text) for text in batch["text"]]
            yield {
                "doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": scores,
                "predicted": [int(s >= toxic) for s in scores],
            }

    columns = [F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text")]
    return map_columns(docs, columns, "doc_id long, held_out boolean, score double, predicted int", work, out)


def op5_toxicity(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return scored(docs, learn(docs, table(spark, folder, "labels")))
