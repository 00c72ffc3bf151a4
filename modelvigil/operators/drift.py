"""Label-distribution drift and label-delayed accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelvigil.functions.divergence import kl, psi, psi_band
from modelvigil.operators.timeseries import as_of_delay, daily_sums, key_window, rolling_counts, rolling_over_days
from modelvigil.presets import CLIP_EPSILON, LABEL_DELAY_DAYS, NOISE_BAND_STDS, PSI_ALERT, ROLLING_DAYS


def _label_counts(label: str, vocabulary: Sequence[str]) -> dict[str, Column]:
    counts = {f"_c{i}": F.count_if(F.col(label) == v) for i, v in enumerate(vocabulary)}
    return {"n_in_window": F.count(label), **counts}


def _shares(vocabulary: Sequence[str], total: str) -> Column:
    """Share of every label of the vocabulary; an empty window gives zeros."""
    return F.array(*[
        F.coalesce(F.try_divide(F.col(f"_c{i}").cast("double"), F.col(total)), F.lit(0.0))
        for i in range(len(vocabulary))
    ])


def label_vector(df: DataFrame, label: str, vocabulary: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Label shares as one array in vocabulary order, per key. Rows outside it count in the total."""
    counted = df.groupBy(*by).agg(*[c.alias(n) for n, c in _label_counts(label, vocabulary).items()])
    return counted.select(*by, _shares(vocabulary, "n_in_window").alias("baseline"))


def label_distribution(df: DataFrame, label: str, vocabulary: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count and share of every label of the vocabulary, absent ones with zero."""
    counted = df.groupBy(*by).agg(*[c.alias(n) for n, c in _label_counts(label, vocabulary).items()])
    shares = _shares(vocabulary, "n_in_window")
    entries = F.array(*[
        F.struct(F.lit(v).alias("label"), F.col(f"_c{i}").alias("n"), F.get(shares, F.lit(i)).alias("p"))
        for i, v in enumerate(vocabulary)
    ])
    return counted.select(*by, F.inline(entries))


def rolling_distribution(
    df: DataFrame, label: str, vocabulary: Sequence[str], day: str = "day", by: Sequence[str] = (),
    window: int = ROLLING_DAYS, warmup: int | None = None, days: tuple[int, int] | None = None,
) -> DataFrame:
    """Label shares over the trailing window, one row per key, day and label."""
    rolled = rolling_counts(df, _label_counts(label, vocabulary), day, by, window, warmup, days)
    shares = _shares(vocabulary, "n_in_window")
    entries = F.array(*[
        F.struct(F.lit(v).alias("label"), F.col(f"_c{i}").alias("n"), F.get(shares, F.lit(i)).alias("p"))
        for i, v in enumerate(vocabulary)
    ])
    return rolled.select(*by, "day", "n_in_window", F.inline(entries))


def _with_baseline(df: DataFrame, baseline: DataFrame | Sequence[float], by: Sequence[str]) -> DataFrame:
    if not isinstance(baseline, DataFrame):
        return df.withColumn("baseline", F.array(*[F.lit(float(p)) for p in baseline]))
    keys = [k for k in by if k in baseline.columns]
    if keys:
        return df.join(baseline, keys, "left")
    return df.withColumn("baseline", baseline.select("baseline").scalar())


def _accuracy_sums(correct: str) -> dict[str, Column]:
    return {"_correct": F.coalesce(F.sum(F.col(correct).cast("bigint")), F.lit(0)), "_scored": F.count(correct)}


_ACCURACY = ("_correct", "_scored")


def _accuracy() -> Column:
    return F.try_divide(F.col("_correct").cast("double"), F.col("_scored"))


def daily_outcomes(
    df: DataFrame, vocabulary: Sequence[str], predicted: str = "predicted", correct: str = "correct",
    day: str = "day", by: Sequence[str] = (),
) -> DataFrame:
    """Label counts and hits per key and day: all that the series, the noise band and the alerts need.

    Store this table, or let one call compute it, when several of them are wanted from one scan.
    """
    return daily_sums(df, {**_label_counts(predicted, vocabulary), **_accuracy_sums(correct)}, day, by)


def drift_series(
    df: DataFrame,
    baseline: DataFrame | Sequence[float],
    vocabulary: Sequence[str],
    predicted: str = "predicted",
    correct: str = "correct",
    day: str = "day",
    by: Sequence[str] = (),
    window: int = ROLLING_DAYS,
    warmup: int | None = None,
    delay: int = LABEL_DELAY_DAYS,
    epsilon: float = CLIP_EPSILON,
) -> DataFrame:
    """PSI and KL of recent predictions against the baseline, and the accuracy known on that day.

    Predictions are known at once; correctness only ``delay`` days later. ``baseline`` is a vector in
    vocabulary order, or the result of :func:`label_vector`.
    """
    daily = daily_outcomes(df, vocabulary, predicted, correct, day, by)
    return drift_of_days(daily, baseline, vocabulary, by, window, warmup, delay, epsilon)


def drift_of_days(
    daily: DataFrame,
    baseline: DataFrame | Sequence[float],
    vocabulary: Sequence[str],
    by: Sequence[str] = (),
    window: int = ROLLING_DAYS,
    warmup: int | None = None,
    delay: int = LABEL_DELAY_DAYS,
    epsilon: float = CLIP_EPSILON,
) -> DataFrame:
    """:func:`drift_series` from the table of :func:`daily_outcomes`."""
    measures = ["n_in_window", *[f"_c{i}" for i in range(len(vocabulary))], *_ACCURACY]
    rolled = rolling_over_days(daily, measures, by, window, warmup)
    rolled = rolled.withColumn("accuracy_as_known", as_of_delay(_accuracy(), by, delay))
    rolled = _with_baseline(rolled.withColumn("current", _shares(vocabulary, "n_in_window")), baseline, by)
    measured = rolled.select(
        *by,
        "day",
        "n_in_window",
        psi(F.col("baseline"), F.col("current"), epsilon).alias("psi"),
        kl(F.col("baseline"), F.col("current"), epsilon).alias("kl"),
        "accuracy_as_known",
    )
    return measured.select(*by, "day", "n_in_window", "psi", "kl", psi_band(F.col("psi")).alias("psi_band"), "accuracy_as_known")


def rolling_accuracy(
    df: DataFrame, correct: str = "correct", day: str = "day", by: Sequence[str] = (),
    window: int = ROLLING_DAYS, warmup: int | None = None, days: tuple[int, int] | None = None,
) -> DataFrame:
    """Row-weighted accuracy over the trailing window; null when nothing was scored."""
    rolled = rolling_counts(df, _accuracy_sums(correct), day, by, window, warmup, days)
    return rolled.select(*by, "day", F.col("_scored").alias("n_scored"), _accuracy().alias("accuracy"))


def label_delayed(series: DataFrame, value: str = "accuracy", by: Sequence[str] = (), delay: int = LABEL_DELAY_DAYS) -> DataFrame:
    """Report on each day the value of ``delay`` days before."""
    return series.select(*by, "day", as_of_delay(F.col(value), by, delay).alias(f"{value}_as_known"))


def noise_band(
    df: DataFrame, correct: str = "correct", day: str = "day", by: Sequence[str] = (),
    n_days: int = ROLLING_DAYS, stds: float = NOISE_BAND_STDS,
) -> DataFrame:
    """Pooled accuracy of the first observed days and the alert threshold below it."""
    return noise_band_of_days(daily_sums(df, _accuracy_sums(correct), day, by), by, n_days, stds)


def noise_band_of_days(
    daily: DataFrame, by: Sequence[str] = (), n_days: int = ROLLING_DAYS, stds: float = NOISE_BAND_STDS
) -> DataFrame:
    """:func:`noise_band` from the table of :func:`daily_outcomes`."""
    early = daily.withColumn("_nth", F.dense_rank().over(key_window(by).orderBy("day"))).where(F.col("_nth") <= n_days)
    band = early.groupBy(*by).agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.try_divide(F.sum("_correct").cast("double"), F.sum("_scored")).alias("baseline_accuracy"),
        F.stddev_samp(_accuracy()).alias("daily_std"),
    )
    return band.withColumn("threshold", F.col("baseline_accuracy") - F.lit(float(stds)) * F.col("daily_std"))


def first_crossing(
    series: DataFrame, metric: str, above: float | Column | None = None, below: float | Column | None = None,
    by: Sequence[str] = (), name: str = "first_day",
) -> DataFrame:
    """First day a metric strictly crosses a threshold, null if it never does."""
    crossed = F.col(metric) > above if above is not None else F.col(metric) < below
    return series.groupBy(*by).agg(F.min(F.when(crossed, F.col("day"))).alias(name))


def first_alerts(series: DataFrame, band: DataFrame, by: Sequence[str] = (), psi_alert: float = PSI_ALERT) -> DataFrame:
    """First PSI alert, first accuracy alert, and which of them led by how many days."""
    if by:
        banded = series.join(band.select(*by, "threshold"), list(by), "left")
    else:
        banded = series.withColumn("threshold", band.select("threshold").scalar())
    alerts = banded.groupBy(*by).agg(
        F.min(F.when(F.col("psi") > psi_alert, F.col("day"))).alias("first_psi_day"),
        F.min(F.when(F.col("accuracy_as_known") < F.col("threshold"), F.col("day"))).alias("first_accuracy_day"),
    )
    lead = F.col("first_accuracy_day") - F.col("first_psi_day")
    return alerts.withColumn("lead_days", lead).withColumn(
        "led_by",
        F.when(lead > 0, F.lit("psi")).when(lead < 0, F.lit("accuracy")).when(lead == 0, F.lit("same_day")),
    )
