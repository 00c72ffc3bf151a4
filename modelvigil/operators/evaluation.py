"""Classifier evaluation over a table of predictions with label, predicted and correct columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelvigil.operators.ranking import first_per_group, index_percentiles
from modelvigil.operators.timeseries import key_window


def with_correct(df: DataFrame, predicted: str = "predicted", label: str = "label") -> DataFrame:
    """1 where the prediction equals the label, else 0; never null."""
    same = F.coalesce(F.col(predicted) == F.col(label), F.lit(False))
    return df.withColumn("correct", same.cast("int"))


def accuracy_summary(df: DataFrame, by: Sequence[str] = (), invalid: str = "INVALID") -> DataFrame:
    """Rows, hits and accuracy; also invalid rate, mean tokens and mean confidence where present."""
    extra: list[Column] = []
    if "output_tokens" in df.columns:
        extra.append(F.avg("output_tokens").alias("avg_output_tokens"))
    if "confidence" in df.columns:
        extra.append(F.avg("confidence").alias("avg_confidence"))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("correct").cast("bigint")).alias("n_correct"),
        F.avg("correct").alias("accuracy"),
        F.avg((F.col("predicted") == invalid).cast("int")).alias("invalid_rate"),
        *extra,
    )


def per_category(df: DataFrame, vocabulary: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Accuracy per label of the vocabulary; a label without rows has 0.0."""
    counted = df.groupBy(*by).agg(*[
        c
        for i, v in enumerate(vocabulary)
        for c in (
            F.count_if(F.col("label") == v).alias(f"_n{i}"),
            F.count_if((F.col("label") == v) & (F.col("correct") == 1)).alias(f"_k{i}"),
        )
    ])
    entries = F.array(*[
        F.struct(
            F.lit(v).alias("label"),
            F.col(f"_n{i}").alias("n"),
            F.col(f"_k{i}").alias("n_correct"),
            F.coalesce(F.try_divide(F.col(f"_k{i}").cast("double"), F.col(f"_n{i}")), F.lit(0.0)).alias("accuracy"),
        )
        for i, v in enumerate(vocabulary)
    ])
    return counted.select(*by, F.inline(entries))


def confusion(df: DataFrame, by: Sequence[str] = (), row_key: str | None = None) -> DataFrame:
    """Rows per (label, predicted); with ``row_key`` also the first row of each cell."""
    first = [F.min(row_key).alias("first_key")] if row_key else []
    return df.groupBy(*by, "label", "predicted").agg(F.count(F.lit(1)).alias("n"), *first)


def top_confusions(df: DataFrame, k: int = 5, by: Sequence[str] = (), row_key: str = "ex_id") -> DataFrame:
    """The ``k`` most frequent wrong cells per key; equal counts go by first appearance."""
    cells = confusion(df.where(F.col("label") != F.col("predicted")), by, row_key)
    return first_per_group(cells, k, [F.desc("n"), F.col("first_key")], by).drop("first_key")


def latency_percentiles(
    df: DataFrame, latency: str = "latency_s", shares: Sequence[float] = (0.5, 0.95), by: Sequence[str] = (),
    row_key: str = "ex_id",
) -> DataFrame:
    """Latency at the given shares by sorted index, without interpolation; one column per share."""
    long = index_percentiles(df, latency, shares, by, row_key)
    return long.groupBy(*by).agg(*[
        F.max(F.when(F.col("share") == float(p), F.col("value"))).alias(f"p{round(p * 100):d}") for p in shares
    ])


def self_consistency(
    runs: DataFrame, by: Sequence[str] = (), row_key: str = "ex_id", predicted: str = "predicted",
    first_n: int | None = None,
) -> DataFrame:
    """Share of examples whose repeated predictions all agree; optionally of the first ones only."""
    per_example = runs.groupBy(*by, row_key).agg(
        F.min(predicted).alias("_least"),
        F.max(predicted).alias("_most"),
        F.count(predicted).alias("_given"),
        F.count(F.lit(1)).alias("_runs"),
    )
    if first_n is not None:
        per_example = first_per_group(per_example, first_n, row_key, by)
    same = F.when(F.col("_given") == F.col("_runs"), F.col("_least") == F.col("_most")).otherwise(F.col("_given") == 0)
    return per_example.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_examples"),
        F.count_if(same).alias("n_agree"),
        F.avg(same.cast("int")).alias("self_consistency"),
    )


def compare_models(
    df: DataFrame, base: str, tuned: str, runs: DataFrame | None = None, model: str = "model",
    latency: str = "latency_s", row_key: str = "ex_id", vocabulary: Sequence[str] = (),
) -> DataFrame:
    """Metric table of two models judged by the same code: base, tuned and their difference.

    With a ``vocabulary`` the accuracy of each of its labels is a metric of its own, ``accuracy:label``.
    """
    pair = df.where(F.col(model).isin(base, tuned))
    summary = accuracy_summary(pair, [model])
    names = ["accuracy", "invalid_rate"] + (["avg_output_tokens"] if "avg_output_tokens" in summary.columns else [])

    def as_rows(wide: DataFrame, metrics: Sequence[str]) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
        return wide.select(model, F.inline(cells))

    rows = as_rows(summary, names).unionByName(
        as_rows(latency_percentiles(pair, latency, (0.5, 0.95), [model], row_key), ["p50", "p95"])
    )
    if vocabulary:
        labels = per_category(pair, vocabulary, [model])
        rows = rows.unionByName(
            labels.select(model, F.concat(F.lit("accuracy:"), F.col("label")).alias("metric"), F.col("accuracy").alias("value"))
        )
    if runs is not None:
        stable = self_consistency(runs.where(F.col(model).isin(base, tuned)), [model], row_key)
        rows = rows.unionByName(as_rows(stable, ["self_consistency"]))
    table = rows.groupBy("metric").agg(
        F.max(F.when(F.col(model) == base, F.col("value"))).alias("base"),
        F.max(F.when(F.col(model) == tuned, F.col("value"))).alias("tuned"),
    )
    return table.withColumn("delta", F.col("tuned") - F.col("base"))


def error_groups(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Errors per (label, predicted) with their share of all errors of the key."""
    cells = df.where(F.col("correct") == 0).groupBy(*by, "label", "predicted").agg(F.count(F.lit(1)).alias("n"))
    return cells.withColumn("share", F.col("n") / F.sum("n").over(key_window(by)))


def worst_errors(df: DataFrame, n: int = 10, by: Sequence[str] = (), row_key: str = "ex_id") -> DataFrame:
    """The most confident errors of each key."""
    return first_per_group(df.where(F.col("correct") == 0), n, [F.desc("confidence"), F.col(row_key)], by, row_key)


def prediction_counts(df: DataFrame, predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, predicted).agg(F.count(F.lit(1)).alias("n")).orderBy(*by, F.desc("n"), predicted)


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Equal-width, right-closed bins between the extremes; empty bins stay.

    The lowest bin opens a thousandth of the range below the minimum so that it holds it. A constant
    column is binned over a thousandth of its value to either side.
    """
    x = F.col(value)
    seen = df.agg(F.min(x).cast("double").alias("lo"), F.max(x).cast("double").alias("hi"))
    pad = F.when(F.col("lo") == 0, F.lit(0.001)).otherwise(F.abs("lo") * 0.001)
    constant = F.col("lo") == F.col("hi")
    span = seen.select(
        F.struct(
            F.when(constant, F.col("lo") - pad).otherwise(F.col("lo")).alias("lo"),
            F.when(constant, F.col("hi") + pad).otherwise(F.col("hi")).alias("hi"),
            constant.alias("constant"),
        ).alias("span")
    )
    ranged = df.where(x.isNotNull()).select(x.cast("double").alias("_x")).withColumn("_span", span.scalar())
    step = (F.col("_span.hi") - F.col("_span.lo")) / F.lit(float(bins))

    def edge(i: int) -> Column:
        return F.col("_span.hi") if i == bins else F.col("_span.lo") + step * F.lit(float(i))

    bin_of = F.lit(1)
    for i in range(1, bins):
        bin_of = bin_of + (F.col("_x") > edge(i)).cast("int")
    counts = ranged.select("_span", bin_of.alias("_bin")).groupBy().agg(
        F.first("_span").alias("_span"), *[F.count_if(F.col("_bin") == i).alias(f"_n{i}") for i in range(1, bins + 1)]
    )
    slack = F.when(F.col("_span.constant"), F.lit(0.0)).otherwise((F.col("_span.hi") - F.col("_span.lo")) * 0.001)
    return counts.where(F.col("_span").isNotNull()).select(
        F.inline(F.array(*[
            F.struct(
                F.lit(i).alias("bin"),
                (edge(i - 1) - slack if i == 1 else edge(i - 1)).alias("lower"),
                edge(i).alias("upper"),
                F.col(f"_n{i}").alias("n"),
            )
            for i in range(1, bins + 1)
        ]))
    )


def daily_telemetry(df: DataFrame, day: str = "day", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, day).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("correct").alias("accuracy"),
        F.avg("confidence").alias("avg_confidence"),
        F.avg("latency_ms").alias("avg_latency_ms"),
    )
