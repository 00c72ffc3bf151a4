"""Approximate order statistics from mergeable sketches: one pass over raw rows, then only daily sketches are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelvigil.presets import ROLLING_DAYS

#: Size parameter of a sketch: some 2 kB for each 200.
SIZE = 400


def rank_error(size: int = SIZE) -> float:
    """Share of the rows by which the rank of one sketched quantile may be off, with 99 % confidence."""
    return 2.296 / size**0.9021


def daily_sketches(df: DataFrame, value: str, day: str = "day", by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """One sketch of ``value`` for each key and day. Partial sketches are merged on the way, so a hot day is none.

    Null values are left out, and NaN, which has no rank. Store this table: any window is merged from it.
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col(day).isNotNull())
    return rows.groupBy(*by, F.col(day).cast("int").alias("day")).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("sketch")
    )


def rolling_quantiles(
    sketches: DataFrame, shares: Sequence[float] = (0.5, 0.95), by: Sequence[str] = (), window: int = ROLLING_DAYS,
) -> DataFrame:
    """``n_in_window`` and quantiles ``p50``, ... of each trailing window that ends on a day with rows.

    A day's sketch goes to the windows it is in, some kilobytes each; no raw row is read again.
    """
    spread = sketches.withColumn("_ends", F.explode(F.sequence(F.col("day"), F.col("day") + window - 1)))
    merged = spread.groupBy(*by, F.col("_ends").alias("day")).agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.max("day").alias("_last")
    )
    kept = merged.where(F.col("_last") == F.col("day"))
    return kept.select(
        *by, "day", F.kll_sketch_get_n_double("sketch").alias("n_in_window"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"p{round(p * 100):d}") for p in shares],
    )
