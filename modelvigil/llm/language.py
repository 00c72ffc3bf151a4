"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelvigil.llm.common import held_out, map_batches, map_columns, smallest_hashes, table
from modelvigil.llm.ngrams import char_ngrams
from modelvigil.session import materialise

#: Character n-grams up to this length, hashed to ``2**BITS`` features.
LONGEST, BITS = 3, 14
#: Labelled documents of each language that the weights are fitted on; document frequencies come from all of them.
PER_LANGUAGE = 500
#: Follow-the-regularised-leader: learning rate, its smoothing, and the elastic net; least steps, and rows of a step.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
STEPS, STEP = 500, 32
#: Every so many-th sample row is kept for the temperature.
CALIBRATION = 5
UNDETERMINED = "und"
#: Documents whose language is less certain are rejected by :func:`identified`.
LEAST_SCORE = 0.3


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, counts: np.ndarray) -> np.ndarray:
        used = np.flatnonzero(counts)
        values = tf_idf(counts[used], self.idf[used])
        return self.weights[:, used] @ values + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        odds = softmax(self.logits(char_ngrams(text, LONGEST, BITS)) / self.temperature)
        best = int(odds.argmax())
        return self.languages[best], min(1.0, float(odds[best]))


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Logarithmic term frequencies times inverse document frequencies, scaled to length one."""
    values = np.log1p(counts) * idf
    return values / max(float(np.sqrt(values @ values)), 1e-12)


def softmax(logits: np.ndarray) -> np.ndarray:
    odds = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return odds / odds.sum(axis=-1, keepdims=True)


@dataclass
class Sample:
    """Rows kept by the features they have; only the rows of one step are ever made dense."""

    slots: list[np.ndarray]
    values: list[np.ndarray]
    width: int = 1 << BITS

    def __len__(self) -> int:
        return len(self.slots)

    def dense(self, some: np.ndarray) -> np.ndarray:
        out = np.zeros((len(some), self.width), dtype=np.float32)
        for row, i in zip(out, some.tolist()):
            row[self.slots[i]] = self.values[i]
        return out

    def take(self, some: np.ndarray) -> Sample:
        return Sample([self.slots[i] for i in some], [self.values[i] for i in some], self.width)

    def logits(self, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        every = np.arange(len(self))
        return np.concatenate([self.dense(every[a : a + STEP]) @ weights.T + bias for a in range(0, len(self), STEP)])


def fit(rows: Sample, labels: np.ndarray, classes: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by FTRL-proximal steps with an elastic net (no penalty on biases)."""
    width = rows.width + 1
    z, n = np.zeros((classes, width)), np.zeros((classes, width))
    l1, l2 = np.full(width, L1), np.full(width, L2)
    l1[-1] = l2[-1] = 0.0

    def weights() -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + l2))

    order = np.random.default_rng(seed)
    for _ in range(-(-STEPS * STEP // len(rows))):
        turn = order.permutation(len(rows))
        for at in range(0, len(turn), STEP):
            some = turn[at : at + STEP]
            x = np.concatenate([rows.dense(some), np.ones((len(some), 1), dtype=np.float32)], axis=1)
            w = weights()
            wrong = softmax(x @ w.T)
            wrong[np.arange(len(some)), labels[some]] -= 1
            gradient = wrong.T @ x / len(some)
            sigma = (np.sqrt(n + gradient**2) - np.sqrt(n)) / ALPHA
            z += gradient - sigma * w
            n += gradient**2
    w = weights()
    return w[:, :-1], w[:, -1]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least negative log likelihood, by a grid that is refined twice.

    The targets give each class the share of one row more, so that separable rows do not ask for certainty.
    """
    spare = 1 / (len(labels) + logits.shape[1])
    low, high, best = np.log(0.02), np.log(20.0), 1.0
    for _ in range(3):
        grid = np.linspace(low, high, 25)
        losses = []
        for t in np.exp(grid):
            odds = np.log(np.maximum(softmax(logits / t), 1e-12))
            right = odds[np.arange(len(labels)), labels].mean()
            losses.append(-(1 - logits.shape[1] * spare) * right - spare * odds.sum(axis=1).mean())
        at = int(np.argmin(losses))
        best = float(np.exp(grid[at]))
        low, high = grid[max(at - 1, 0)], grid[min(at + 1, len(grid) - 1)]
    return best


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Model from the documents with a label that are not held out.

    Document frequencies are counted over every such document, ``2**BITS`` sums that are combined before they leave
    a task. The weights are fitted on at most ``per_language`` documents a language, those with the smallest hash of
    their id; only their feature counts come to the driver. Rows that repeat an id and a language are one there, with
    the smallest of their texts.
    """
    known = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")

    def frequencies(batches: Iterator[dict]) -> Iterator[dict]:
        total, n = np.zeros(1 << BITS, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                total += char_ngrams(text, LONGEST, BITS) > 0
                n += 1
        used = np.flatnonzero(total)
        if n:
            yield {"slot": [-1, *used.tolist()], "docs": [n, *total[used].tolist()]}

    sums = map_columns(
        known, ["text"], "slot int, docs long", frequencies, pa.schema([("slot", pa.int32()), ("docs", pa.int64())])
    )
    found = {r.slot: r.docs for r in sums.groupBy("slot").agg(F.sum("docs").alias("docs")).collect()}
    frequency = np.zeros(1 << BITS)
    for slot, n in found.items():
        if slot >= 0:
            frequency[slot] = n
    idf = np.log((1 + found.get(-1, 0)) / (1 + frequency)) + 1

    chosen = materialise(smallest_hashes(known.select("doc_id", "lang"), per_language, by="lang").select("doc_id", "lang"))

    def counts(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            pairs = [char_ngrams(text, LONGEST, BITS) for text in batch["text"]]
            yield {
                "doc_id": batch["doc_id"], "lang": batch["lang"],
                "slots": [np.flatnonzero(c).astype("<i4").tobytes() for c in pairs],
                "counts": [c[c > 0].astype("<i4").tobytes() for c in pairs],
            }

    out = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("slots", pa.binary()), ("counts", pa.binary())])
    once = known.join(chosen, ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    sample = map_columns(
        once, ["doc_id", "lang", "text"],
        "doc_id long, lang string, slots binary, counts binary", counts, out,
    ).collect()
    sample.sort(key=lambda r: (r.doc_id, r.lang, r.slots, r.counts))
    languages = sorted({r.lang for r in sample})
    if not languages:
        return Model([], idf, np.zeros((0, 1 << BITS)), np.zeros(0), 1.0)
    slots = [np.frombuffer(r.slots, dtype="<i4") for r in sample]
    values = [tf_idf(np.frombuffer(r.counts, dtype="<i4"), idf[used]).astype(np.float32) for r, used in zip(sample, slots)]
    rows = Sample(slots, values)
    labels = np.array([languages.index(r.lang) for r in sample])
    apart = np.arange(len(sample)) % CALIBRATION == CALIBRATION - 1
    weights, bias = fit(rows.take(np.flatnonzero(~apart)), labels[~apart], len(languages))
    model = Model(languages, idf.astype(np.float32), weights.astype(np.float32), bias, 1.0)
    if apart.any():
        model.temperature = temperature(rows.take(np.flatnonzero(apart)).logits(weights, bias), labels[apart])
    return model


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every whole text.

    A null text, one without a letter, or any text if nothing was learnt, is ``und`` with score zero. Repeated rows
    and null ids (held out) come as they are. Other columns are not read.
    """
    out = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()),
    ])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found = [model.predict(text) for text in batch["text"]]
            yield {
                "doc_id": batch["doc_id"], "held_out": batch["held_out"],
                "lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
            }

    columns = [F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text")]
    return map_columns(docs, columns, "doc_id long, held_out boolean, lang_pred string, score double", work, out)


def identified(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is determined with at least this score.

    If nothing could be learnt, no language can be determined, and all texts with a letter stay. Null and empty
    texts, and texts without a letter, go. Repeated rows are judged alike; a null id changes nothing. No rows give
    no rows. Columns of any name and type are kept as they are.
    """
    model = learn(docs)

    def stays(text: str | None) -> bool:
        if not model.languages:
            return any(map(str.isalpha, text or ""))
        lang, score = model.predict(text)
        return lang != UNDETERMINED and score >= least

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([stays(text) for text in batch.column("text").to_pylist()], pa.bool_()))

    return map_batches(docs, work)


def op6_language(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return with_language(docs, learn(docs))
