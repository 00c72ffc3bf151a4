"""Training/serving skew: one scorer, several preprocessing paths, one scan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelvigil.functions.text import truncate
from modelvigil.operators.evaluation import with_correct
from modelvigil.presets import SERVING_MAX_CHARS, SKEW_GAP_ALERT


def score_paths(
    df: DataFrame, rule: Callable[[Column], Column], lengths: Sequence[int] = (SERVING_MAX_CHARS,),
    text: str = "text", label: str = "label", row_key: str = "ex_id",
) -> DataFrame:
    """Score each row offline (whole text) and once per serving length.

    Every path becomes a row before the rule runs, so the rule is compiled once whatever the number of
    lengths; generated code that grows with them would soon be too long for the JIT.
    """
    paths = [("offline", None, F.col(text))] + [("serving", n, truncate(F.col(text), n)) for n in lengths]
    views = F.array(*[
        F.struct(F.lit(path).alias("path"), F.lit(n).cast("int").alias("max_chars"), seen.alias("_seen"))
        for path, n, seen in paths
    ])
    rows = df.select(row_key, F.col(label).alias("label"), F.inline(views))
    scored = rows.select(row_key, "label", "path", "max_chars", rule(F.col("_seen")).alias("_scored"))
    return with_correct(
        scored.select(
            row_key, "label", "path", "max_chars",
            F.col("_scored.predicted").alias("predicted"), F.col("_scored.confidence").alias("confidence"),
        )
    )


def skew_sweep(
    scored: DataFrame, lengths: Sequence[int], alert: float = SKEW_GAP_ALERT, by: Sequence[str] = ()
) -> DataFrame:
    """Offline and serving accuracy and mean confidence, the gap of the accuracies and whether it is worth a flag,
    per serving length."""
    offline = F.col("path") == "offline"
    at = {n: (F.col("path") == "serving") & (F.col("max_chars") == n) for n in lengths}
    accuracies = scored.groupBy(*by).agg(
        F.avg(F.when(offline, F.col("correct"))).alias("_offline"),
        F.avg(F.when(offline, F.col("confidence"))).alias("_confidence"),
        *[F.avg(F.when(own, F.col("correct"))).alias(f"_s{n}") for n, own in at.items()],
        *[F.avg(F.when(own, F.col("confidence"))).alias(f"_c{n}") for n, own in at.items()],
    )
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("max_chars"), F.col("_offline").alias("offline_accuracy"), F.col(f"_s{n}").alias("serving_accuracy"),
            F.col("_confidence").alias("offline_confidence"), F.col(f"_c{n}").alias("serving_confidence"),
        )
        for n in lengths
    ])
    swept = accuracies.select(*by, F.inline(rows))
    gap = F.col("offline_accuracy") - F.col("serving_accuracy")
    return swept.withColumn("gap", gap).withColumn("flagged", F.col("gap") > alert)


def skew_gap(scored: DataFrame, max_chars: int = SERVING_MAX_CHARS, alert: float = SKEW_GAP_ALERT, by: Sequence[str] = ()) -> DataFrame:
    return skew_sweep(scored, [max_chars], alert, by)


def skew_by_category(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per serving length and label: accuracies, and confidence of the wrong rows against all rows.

    Confidently wrong rows are the skew that a confidence threshold would not catch.
    """
    grouped = scored.groupBy(*by, "label", "max_chars").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("correct").alias("serving_accuracy"),
        F.avg(F.when(F.col("correct") == 0, F.col("confidence"))).alias("confidence_wrong"),
        F.avg("confidence").alias("confidence_all"),
    )
    # A label has one row per path here, so the window is as small as the list of lengths.
    offline = F.max(F.when(F.col("max_chars").isNull(), F.col("serving_accuracy"))).over(Window.partitionBy(*by, "label"))
    serving = grouped.withColumn("offline_accuracy", offline).where(F.col("max_chars").isNotNull())
    return serving.select(
        *by, "label", "max_chars", "n", "offline_accuracy", "serving_accuracy",
        (F.col("offline_accuracy") - F.col("serving_accuracy")).alias("gap"),
        "confidence_wrong", "confidence_all",
    )
