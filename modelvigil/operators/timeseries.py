"""Daily partial counts, gap-free day series and trailing windows over them.

Raw rows are reduced to one row per key and day first. Everything after that is as small as the
calendar, whatever the traffic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelvigil.presets import ROLLING_DAYS

#: Days between two observed days of a key above which a date is taken for a mistake.
LONGEST_GAP = 3_660


def key_window(by: Sequence[str]):
    """Window per key. Without keys the one partition holds a day series, never raw rows."""
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def daily_sums(df: DataFrame, sums: dict[str, Column], day: str = "day", by: Sequence[str] = ()) -> DataFrame:
    """One row per key and day with the named partial aggregates."""
    return df.groupBy(*by, F.col(day).cast("int").alias("day")).agg(*[c.alias(n) for n, c in sums.items()])


def rows_outside(df: DataFrame, days: tuple[int, int], day: str = "day", by: Sequence[str] = ()) -> DataFrame:
    """Number of rows per key and day outside an explicit day range, or without a day."""
    inside = F.coalesce(F.col(day).between(*days), F.lit(False))
    return df.where(~inside).groupBy(*by, day).agg(F.count(F.lit(1)).alias("n"))


def fill_days(
    daily: DataFrame, measures: Sequence[str], by: Sequence[str] = (), first_day: int | None = None,
    last_day: int | None = None, days: tuple[int, int] | None = None,
) -> DataFrame:
    """Add the missing days of each key with zero measures, from ``first_day`` or the first day seen to ``last_day``
    or the last day seen of any key, so that a key that falls silent keeps its place in the series.

    Every row emits itself and the gap up to the next observed day, so no calendar table is joined. ``days`` is the
    range that counts; :func:`rows_outside` reports the rest. A gap of over ``LONGEST_GAP`` days, as a stray date
    makes, fails the job.
    """
    if days is not None:
        daily = daily.where(F.col("day").between(*days))
    end = F.lit(last_day) if last_day is not None else daily.agg(F.max("day").alias("day")).select("day").scalar()
    ordered = key_window(by).orderBy("day")
    until = F.coalesce(F.lead("day").over(ordered) - 1, F.greatest(F.col("day"), end))
    since = F.col("day")
    if first_day is not None:
        is_first = F.lag("day").over(ordered).isNull()
        since = F.when(is_first, F.least(F.col("day"), F.lit(first_day))).otherwise(F.col("day"))
    spread = daily.withColumn("_until", until).withColumn("_since", since)
    stray = F.raise_error(F.concat(F.lit("gap of days next to day "), F.col("day").cast("string"), F.lit("; give a range of days")))
    spread = spread.withColumn(
        "_until", F.when(F.col("_until") - F.col("_since") > LONGEST_GAP, stray).otherwise(F.col("_until"))
    )
    spread = spread.withColumn("_day", F.explode(F.sequence("_since", "_until")))
    observed = F.col("_day") == F.col("day")
    return spread.select(
        *by,
        F.col("_day").alias("day"),
        *[F.when(observed, F.col(m)).otherwise(F.lit(0)).cast("bigint").alias(m) for m in measures],
    )


def rolling_sums(daily: DataFrame, measures: Sequence[str], by: Sequence[str] = (), window: int = ROLLING_DAYS) -> DataFrame:
    """Sums over the trailing ``window`` days, each measure under its own name."""
    trailing = key_window(by).orderBy("day").rangeBetween(-(window - 1), 0)
    return daily.select(*by, "day", *[F.sum(m).over(trailing).alias(m) for m in measures])


def rolling_over_days(
    daily: DataFrame, measures: Sequence[str], by: Sequence[str] = (), window: int = ROLLING_DAYS,
    warmup: int | None = None, days: tuple[int, int] | None = None,
) -> DataFrame:
    """Trailing sums for every integer day from ``warmup`` to the last day of all keys, within ``days`` if given."""
    warmup = window if warmup is None else warmup
    dense = fill_days(daily, measures, by, first_day=warmup, days=days)
    return rolling_sums(dense, measures, by, window).where(F.col("day") >= warmup)


def rolling_counts(
    df: DataFrame, sums: dict[str, Column], day: str = "day", by: Sequence[str] = (), window: int = ROLLING_DAYS,
    warmup: int | None = None, days: tuple[int, int] | None = None,
) -> DataFrame:
    """The same straight from raw rows."""
    return rolling_over_days(daily_sums(df, sums, day, by), list(sums), by, window, warmup, days)


def as_of_delay(value: Column, by: Sequence[str], delay: int) -> Column:
    """The value of exactly ``delay`` days before; null where that day is not in the series."""
    exact = key_window(by).orderBy("day").rangeBetween(-delay, -delay)
    return F.max(value).over(exact)
