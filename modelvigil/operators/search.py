"""Hyper-parameter search tables: grid, early stopping, leaderboard, coverage and verification."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelvigil.operators.timeseries import key_window
from modelvigil.presets import CLASSIFIER_AXES, MIN_DELTA, PATIENCE, SEARCH_AXES


def grid_array(axes: dict[str, Sequence]) -> Column:
    """Every combination of the axes as an array of structs, numbered, the first axis changing slowest."""
    return F.array(*[
        F.struct(F.lit(i).alias("trial_idx"), *[F.lit(v).alias(name) for name, v in zip(axes, cell)])
        for i, cell in enumerate(itertools.product(*axes.values()))
    ])


def grid(spark: SparkSession, axes: dict[str, Sequence] | None = None) -> DataFrame:
    """The search grid as a table."""
    return spark.range(1).select(F.inline(grid_array(axes or SEARCH_AXES)))


def patience_stop(
    trials: DataFrame, by: Sequence[str] = ("search_id",), metric: str = "val_accuracy",
    patience: int = PATIENCE, min_delta: float = MIN_DELTA,
) -> DataFrame:
    """Replay early stopping in trial order: whether each trial ran, improved, and the best so far.

    Whether a trial improves depends on the best accepted before it, which no window frame expresses,
    so the trials of a search are folded in order. One search has one trial per grid cell, so the folded
    array is as small as the grid, whatever data the trials were measured on.
    """
    step = F.struct(F.col("trial_idx").alias("trial_idx"), F.col(metric).alias("value"))
    searches = trials.groupBy(*by).agg(F.array_sort(F.collect_list(step)).alias("_steps"))
    start = F.struct(
        F.lit(-1.0).alias("best"),
        F.lit(0).alias("stalls"),
        F.array().cast(
            f"array<struct<trial_idx:int,{metric}:double,executed:boolean,improved:boolean,best_so_far:double,stalls:int>>"
        ).alias("log"),
    )

    def fold(state, trial):
        runs = state["stalls"] < patience
        better = runs & F.coalesce(trial["value"] > state["best"] + F.lit(min_delta), F.lit(False))
        best = F.when(better, trial["value"]).otherwise(state["best"])
        stalls = F.when(better, F.lit(0)).when(runs, state["stalls"] + 1).otherwise(state["stalls"])
        entry = F.struct(
            trial["trial_idx"].cast("int").alias("trial_idx"),
            trial["value"].alias(metric),
            runs.alias("executed"),
            better.alias("improved"),
            best.alias("best_so_far"),
            stalls.alias("stalls"),
        )
        return F.struct(
            best.alias("best"), stalls.alias("stalls"), F.concat(state["log"], F.array(entry)).alias("log")
        )

    return searches.select(*by, F.inline(F.aggregate("_steps", start, fold, lambda s: s["log"])))


def leaderboard(trials: DataFrame, by: Sequence[str] = ("search_id",), metric: str = "val_accuracy") -> DataFrame:
    """Trials by metric, best first; equal ones keep trial order."""
    order = key_window(by).orderBy(F.desc(metric), "trial_idx")
    return trials.withColumn("place", F.row_number().over(order))


def untried(planned: DataFrame, run: DataFrame, keys: Sequence[str] = ("search_id", "trial_idx")) -> DataFrame:
    """Planned cells that never ran."""
    return planned.join(run.select(*keys), list(keys), "left_anti")


def verify_winner(
    trials: DataFrame, holdout: DataFrame, by: Sequence[str] = ("search_id",),
    metric: str = "val_accuracy", holdout_metric: str = "test_accuracy",
) -> DataFrame:
    """The winner of each search, its held-out accuracy, and how much of its score did not hold up."""
    winners = leaderboard(trials, by, metric).where(F.col("place") == 1).select(*by, "trial_idx", metric)
    return winners.join(holdout.select(*by, "trial_idx", holdout_metric), [*by, "trial_idx"], "left").withColumn(
        "gap", F.col(metric) - F.col(holdout_metric)
    )


def ablation(results: DataFrame, axis: str) -> DataFrame:
    """Accuracy by one axis of the grid, pooled over its trials by row counts.

    Trials that also tell how many of their examples agree over repeated runs (``n_agree`` of ``n_examples``, as
    self-consistency counts them) get their pooled consistency as well.
    """
    measures = [
        F.count(F.lit(1)).alias("n_trials"),
        F.try_divide(F.sum("n_correct").cast("double"), F.sum("n")).alias("accuracy"),
        F.max("accuracy").alias("best_accuracy"),
    ]
    if {"n_agree", "n_examples"} <= set(results.columns):
        measures.append(F.try_divide(F.sum("n_agree").cast("double"), F.sum("n_examples")).alias("self_consistency"))
    return results.groupBy(axis).agg(*measures)


def search_classifier(
    train: DataFrame, val: DataFrame, axes: dict[str, Sequence] | None = None, patience: int = PATIENCE,
    min_delta: float = MIN_DELTA, text: str = "text", label: str = "label", **fixed,
) -> tuple[PipelineModel | None, DataFrame]:
    """Fit the cells of a grid in order, score each on the validation rows, and stop after ``patience`` cells without
    an improvement of more than ``min_delta``.

    Every fit and every score is a distributed job over all rows; the loop only walks the grid. Returns the model of
    the best cell and the leaderboard of the cells that ran, best first: ``trial_idx``, one column per axis,
    ``val_accuracy``, ``place``. Without a validation row accuracies are null and no model wins.
    """
    axes = axes or CLASSIFIER_AXES
    best, winner, stalls, ran = -1.0, None, 0, []
    for number, cell in enumerate(itertools.product(*axes.values())):
        if stalls >= patience:
            break
        model = train_classifier(train, text, label, **dict(zip(axes, cell)), **fixed)
        names = F.array(*[F.lit(v) for v in model.stages[0].labels])
        said = F.get(names, F.col("prediction").cast("int"))
        accuracy = model.transform(val).agg(F.avg(F.coalesce(said == F.col(label), F.lit(False)).cast("int"))).first()[0]
        ran.append((number, *cell, accuracy))
        if accuracy is not None and accuracy > best + min_delta:
            best, winner, stalls = accuracy, model, 0
        else:
            stalls += 1
    names = ["trial_idx", *axes, "val_accuracy"]
    kinds = ["int", *[{int: "int", float: "double"}.get(type(values[0]), "string") for values in axes.values()], "double"]
    trials = train.sparkSession.createDataFrame(ran, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    return winner, leaderboard(trials, by=())


def train_classifier(
    train: DataFrame, text: str = "text", label: str = "label", n_features: int = 1 << 16,
    algorithm: str = "naive_bayes", pattern: str = r"\W+", **params,
) -> PipelineModel:
    """Fit a bag-of-words classifier. Each parameter set is one cell of the search grid."""
    learner = {"naive_bayes": NaiveBayes, "logistic_regression": LogisticRegression}[algorithm]
    stages = [
        StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="keep"),
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=pattern),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=n_features),
        IDF(inputCol="_tf", outputCol="_features"),
        learner(featuresCol="_features", labelCol="_label", **params),
    ]
    return Pipeline(stages=stages).fit(train)
