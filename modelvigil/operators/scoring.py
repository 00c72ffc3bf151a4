"""Batch scoring with a pluggable scorer and a pluggable preprocessing step."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelvigil.functions.probability import with_softmax_choice
from modelvigil.functions.text import identity

Rule = Callable[[Column], Column]
BatchScorer = Callable[[pd.Series], pd.DataFrame]

_LOADED: dict[str, tuple[str, BatchScorer]] = {}


def load_once(name: str, version: str, load: Callable[[], BatchScorer]) -> BatchScorer:
    """The scorer of this Python worker, loaded anew when another ``version`` is asked for under its name.

    A top-level function travels by reference, so its cache stays with the worker process from task to task. One
    scorer is kept for each name.
    """
    if name not in _LOADED or _LOADED[name][0] != version:
        _LOADED[name] = (version, load())
    return _LOADED[name][1]


def score_with_rule(df: DataFrame, rule: Rule, text: str = "text", preprocess: Rule = identity) -> DataFrame:
    """Score with a Column expression returning struct(predicted, confidence)."""
    return df.withColumn("_scored", rule(preprocess(F.col(text)))).select(
        *df.columns, F.col("_scored.predicted").alias("predicted"), F.col("_scored.confidence").alias("confidence")
    )


def score_with_model(df: DataFrame, model: PipelineModel, text: str = "text", preprocess: Rule = identity) -> DataFrame:
    """Score with a fitted Spark ML model; its label indexer must be the first stage."""
    ready = df.withColumn("_original", F.col(text)).withColumn(text, preprocess(F.col(text)))
    scored = model.transform(ready)
    names = F.array(*[F.lit(v) for v in model.stages[0].labels])
    confidence = F.array_max(vector_to_array(F.col("probability")))
    kept = [F.col("_original").alias(text) if c == text else F.col(c) for c in df.columns]
    return scored.select(
        *kept, F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted"), confidence.alias("confidence")
    )


def score_in_batches(
    df: DataFrame, load: Callable[[], BatchScorer], name: str, version: str, text: str = "text",
    preprocess: Rule = identity,
) -> DataFrame:
    """Score Arrow batches with a Python model loaded once per worker process and version.

    ``load`` returns a function from a text series to a frame with predicted, confidence and latency_ms. Only the
    prepared text of the rows of ``df`` goes to Python, and only the scores come back, so filter before.
    """

    @F.pandas_udf("predicted string, confidence double, latency_ms double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = load_once(name, version, load)
        for batch in batches:
            yield scorer(batch)[["predicted", "confidence", "latency_ms"]].reset_index(drop=True)

    return df.withColumn("_scored", scores(preprocess(F.col(text)))).select(
        *df.columns, *[F.col(f"_scored.{c}").alias(c) for c in ("predicted", "confidence", "latency_ms")]
    )


def softmax_confidence(df: DataFrame, scores: str, positions: Sequence[int], labels: Sequence[str]) -> DataFrame:
    """Label and confidence from a score vector; see :func:`with_softmax_choice`."""
    return with_softmax_choice(df, scores, positions, labels)
