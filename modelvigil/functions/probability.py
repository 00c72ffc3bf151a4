"""Class scores to a label and a confidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def softmax_mass(scores: Column, top: Column) -> Column:
    """Sum of exp(score - top); ``top`` should be a computed column, it is read once per element."""
    return F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - top))


def with_softmax_choice(df: DataFrame, scores: str, positions: Sequence[int], labels: Sequence[str]) -> DataFrame:
    """Add predicted and confidence from a full score vector.

    The softmax runs over every score; only ``positions`` (zero-based) may win, and the winner keeps its
    share of the full mass. The first of equal scores wins. The steps are separate columns so that the
    maximum is found once per row and not once per element.
    """
    allowed = F.array(*[F.element_at(F.col(scores), p + 1).cast("double") for p in positions])
    names = F.array(*[F.lit(v) for v in labels])
    maxima = df.withColumns({"_allowed": allowed, "_top": F.array_max(scores).cast("double")})
    summed = maxima.withColumns({"_best": F.array_max("_allowed"), "_mass": softmax_mass(F.col(scores), F.col("_top"))})
    return summed.select(
        *df.columns,
        F.element_at(names, F.array_position("_allowed", F.col("_best")).cast("int")).alias("predicted"),
        (F.exp(F.col("_best") - F.col("_top")) / F.col("_mass")).alias("confidence"),
    )
