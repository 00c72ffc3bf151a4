"""Daily threshold crossings to prioritised incidents. Inputs are day series, not traffic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelvigil.operators.quality import long_rates
from modelvigil.operators.timeseries import key_window
from modelvigil.presets import (
    ISSUE_RATE_ALERT, NOISE_BAND_STDS, PRIORITY_LADDER, PSI_ALERT, RATE_ALERTS, ROLLING_DAYS,
)

DRIFT, SKEW, QUALITY = "data_drift", "serving_skew", "data_quality"
INCIDENT_COLUMNS = [
    "source_stage", "alert_type", "start_day", "end_day", "peak_value", "impact_confirmed",
    "impact_description", "blocking",
]


def _island(keys: Sequence[str]) -> Column:
    return F.col("day") - F.row_number().over(key_window(keys).orderBy("day"))


def incident_spans(alert_days: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Runs of consecutive days as (start_day, end_day); repeated days count once."""
    days = alert_days.select(*keys, "day").distinct()
    return (
        days.withColumn("_island", _island(keys))
        .groupBy(*keys, "_island")
        .agg(F.min("day").alias("start_day"), F.max("day").alias("end_day"), F.count(F.lit(1)).alias("n_days"))
        .drop("_island")
    )


def _percent(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%.1f%%", value * 100))


def with_impact_threshold(
    series: DataFrame, by: Sequence[str] = (), n_values: int = ROLLING_DAYS, stds: float = NOISE_BAND_STDS
) -> DataFrame:
    """Add the threshold that the first known values of the smoothed accuracy series give.

    Smoothed values vary less than raw days, so this lies closer to the mean than ``noise_band``.
    """
    known_so_far = F.count("accuracy_as_known").over(key_window(by).orderBy("day"))
    early = F.when(known_so_far <= n_values, F.col("accuracy_as_known"))
    whole = key_window(by)
    marked = series.withColumn("_early", early)
    threshold = F.avg("_early").over(whole) - F.lit(float(stds)) * F.stddev_samp("_early").over(whole)
    return marked.withColumn("impact_threshold", threshold).drop("_early")


def drift_incidents(
    series: DataFrame, psi_alert: float = PSI_ALERT, by: Sequence[str] = (), stds: float = NOISE_BAND_STDS
) -> DataFrame:
    """Spans of significant PSI; confirmed when known accuracy fell below the impact band meanwhile."""
    banded = with_impact_threshold(series, by, stds=stds)
    alerts = banded.where(F.col("psi") > psi_alert).withColumn("_island", _island(by))
    spans = alerts.groupBy(*by, "_island").agg(
        F.min("day").alias("start_day"),
        F.max("day").alias("end_day"),
        F.max("psi").alias("peak_value"),
        F.min("accuracy_as_known").alias("_lowest"),
        F.first("impact_threshold").alias("impact_threshold"),
    )
    confirmed = F.coalesce(F.col("_lowest") < F.col("impact_threshold"), F.lit(False))
    lowest = F.coalesce(_percent(F.col("_lowest")), F.lit("unknown"))
    limit = F.coalesce(_percent(F.col("impact_threshold")), F.lit("unknown"))
    described = F.when(
        confirmed, F.concat(F.lit("known accuracy fell to "), lowest, F.lit(", below its noise band at "), limit)
    ).otherwise(
        F.concat(F.lit("distribution moved but lowest known accuracy was "), lowest, F.lit(" against "), limit)
    )
    return spans.select(
        *by,
        F.lit(DRIFT).alias("source_stage"),
        F.lit("psi_shift").alias("alert_type"),
        "start_day",
        "end_day",
        "peak_value",
        confirmed.alias("impact_confirmed"),
        described.alias("impact_description"),
        F.lit(False).alias("blocking"),
    )


def skew_incidents(gaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One standing finding per measured gap; a measured gap is its own confirmation."""
    described = F.concat(
        F.lit("offline accuracy "), _percent(F.col("offline_accuracy")),
        F.lit(", serving accuracy "), _percent(F.col("serving_accuracy")),
    )
    return gaps.select(
        *by,
        F.lit(SKEW).alias("source_stage"),
        F.lit("offline_serving_gap").alias("alert_type"),
        F.lit(0).alias("start_day"),
        F.lit(0).alias("end_day"),
        F.col("gap").alias("peak_value"),
        F.lit(True).alias("impact_confirmed"),
        described.alias("impact_description"),
        F.lit(False).alias("blocking"),
    )


def quality_incidents(
    series: DataFrame, threshold: float = ISSUE_RATE_ALERT, by: Sequence[str] = (),
    rates: dict[str, tuple[str, bool]] = RATE_ALERTS,
) -> DataFrame:
    """Spans in which an issue rate stays over the threshold, per rate.

    ``rates`` names the rate columns with their alert type, and whether that issue keeps rows from the model.
    """
    keys = [*by, "metric"]
    alerts = long_rates(series, list(rates), by).where(F.col("value") > threshold)
    spans = alerts.withColumn("_island", _island(keys)).groupBy(*keys, "_island").agg(
        F.min("day").alias("start_day"), F.max("day").alias("end_day"), F.max("value").alias("peak_value")
    )
    types = F.create_map(*[F.lit(x) for m, (t, _) in rates.items() for x in (m, t)])
    blocking = F.col("metric").isin(*[m for m, (_, b) in rates.items() if b])
    effect = F.when(blocking, F.lit(" of rows never reached the model")).otherwise(
        F.lit(" of rows were scored with a bad metadata field")
    )
    return spans.select(
        *by,
        F.lit(QUALITY).alias("source_stage"),
        types[F.col("metric")].alias("alert_type"),
        "start_day",
        "end_day",
        "peak_value",
        F.lit(True).alias("impact_confirmed"),
        F.concat(F.lit("up to "), _percent(F.col("peak_value")), effect).alias("impact_description"),
        blocking.alias("blocking"),
    )


def score_priority(incidents: DataFrame, ladder: dict[str, float] = PRIORITY_LADDER) -> DataFrame:
    """Priority P1 to P4 and the reason. Unconfirmed impact never outranks confirmed impact."""
    step = ladder.__getitem__
    days = F.col("end_day") - F.col("start_day") + 1
    peak, stage = F.col("peak_value"), F.col("source_stage")
    blocking = (
        F.when((peak > step("blocking_high")) | (days > step("blocking_long")), "P1")
        .when(peak > step("blocking_low"), "P2").otherwise("P3")
    )
    metadata = (
        F.when((peak > step("metadata_high")) | (days > step("metadata_long")), "P2")
        .when(peak > step("metadata_low"), "P3").otherwise("P4")
    )
    priority = (
        F.when(~F.col("impact_confirmed"), F.lit("P4"))
        .when(stage == SKEW, F.when(peak < step("skew_high"), "P2").otherwise("P1"))
        .when(stage == QUALITY, F.when(F.col("blocking"), blocking).otherwise(metadata))
        .otherwise(F.when((days > step("drift_long")) | (peak > step("drift_high")), "P1").otherwise("P2"))
    )
    span = F.concat(days.cast("string"), F.lit(" day(s)"))
    reasoning = (
        F.when(~F.col("impact_confirmed"), F.lit("no confirmed impact: keep on record, page nobody"))
        .when(stage == SKEW, F.concat(F.lit("standing gap of "), _percent(peak), F.lit(" until preprocessing agrees")))
        .when(
            stage == QUALITY,
            F.concat(
                F.when(F.col("blocking"), F.lit("blocking")).otherwise(F.lit("not blocking")),
                F.lit(", peak "), _percent(peak), F.lit(" over "), span,
            ),
        )
        .otherwise(F.concat(F.lit("accuracy impact, peak psi "), F.format_string("%.2f", peak), F.lit(" over "), span))
    )
    return incidents.withColumn("priority", priority).withColumn("reasoning", reasoning)


def alert_digest(
    *incidents: DataFrame, by: Sequence[str] = (), rates: dict[str, tuple[str, bool]] = RATE_ALERTS,
    ladder: dict[str, float] = PRIORITY_LADDER,
) -> DataFrame:
    """All incidents with their priority and their place in the digest; quality alerts in the order of ``rates``."""
    merged = incidents[0]
    for more in incidents[1:]:
        merged = merged.unionByName(more)
    scored = score_priority(merged, ladder)
    stages = F.array(F.lit(DRIFT), F.lit(SKEW), F.lit(QUALITY))
    kinds = F.array(*[F.lit(t) for t, _ in rates.values()])
    order = key_window(by).orderBy(
        "priority",
        F.array_position(stages, F.col("source_stage")),
        F.array_position(kinds, F.col("alert_type")),
        "start_day",
    )
    return scored.withColumn("digest_rank", F.row_number().over(order))


def digest_summary(digest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Incidents, confirmed ones, page-worthy ones, and the daily crossings they stand for."""
    days = F.col("end_day") - F.col("start_day") + 1
    return digest.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_incidents"),
        F.count_if(F.col("impact_confirmed")).alias("n_confirmed"),
        F.count_if(F.col("priority").isin("P1", "P2")).alias("n_page_worthy"),
        F.sum(days.cast("bigint")).alias("n_daily_signals"),
    )


