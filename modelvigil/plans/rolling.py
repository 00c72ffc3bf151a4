"""Registered queries of the drift monitors, with the SQL that must agree with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelvigil.operators import drift, evaluation, incidents
from modelvigil.plans.sql import DAYS, DRIFT_SERIES, NOISE_BAND, PRED_LOG, PSI_ROWS, with_
from modelvigil.session import materialise, scratch_path
from modelvigil.sources import files, views
from modelvigil.sources.views import EVENT_TYPES


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def drift_frame(spark, folder, by=()):
    baseline = drift.label_vector(views.baseline_log(spark, folder), "label", EVENT_TYPES, by)
    return drift.drift_series(views.pred_log(spark, folder), baseline, EVENT_TYPES, by=by)


def scan_scenario(spark, folder):
    log = views.pred_log(spark, folder).where(F.col("scenario") == "drift")
    return log.select("event_id", "day", "label", "predicted", "correct", F.round("confidence", 6).alias("confidence"))


def append_round_trip(spark, folder):
    """Telemetry written in two batches a day, one of them twice and first with other days, counted as read back."""
    log = views.pred_log(spark, folder).withColumn("sim_date", F.to_date("ts")).withColumn("text", F.lit(None).cast("string"))
    path = scratch_path(spark, "telemetry")
    # The first attempt at the even batch had days that the second no longer has.
    early = log.where((F.abs(F.col("event_id")) % 2 == 0)).withColumn("sim_date", F.date_sub("sim_date", 60))
    files.append_predictions(early, path, "even")
    for batch_id, half in (("odd", 1), ("even", 0)):
        files.append_predictions(log.where(F.abs(F.col("event_id")) % 2 == half), path, batch_id)
    back = files.read_predictions(spark, path)
    return rounded(
        back.groupBy("scenario", "day").agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_events"), F.sum("correct").alias("n_correct"),
            F.avg("confidence").alias("avg_confidence"),
        ), "avg_confidence",
    )


def label_distribution(spark, folder):
    return rounded(drift.label_distribution(views.baseline_log(spark, folder), "label", EVENT_TYPES), "p")


def rolling_distribution(spark, folder):
    return rounded(drift.rolling_distribution(views.pred_log(spark, folder), "predicted", EVENT_TYPES), "p")


def rolling_psi(spark, folder):
    return rounded(drift_frame(spark, folder).select("day", "n_in_window", "psi", "kl"), "psi", "kl")


def rolling_accuracy(spark, folder):
    return rounded(drift.rolling_accuracy(views.pred_log(spark, folder)), "accuracy")


def label_delayed_accuracy(spark, folder):
    series = drift.rolling_accuracy(views.pred_log(spark, folder))
    return rounded(drift.label_delayed(series), "accuracy_as_known")


def drift_series(spark, folder):
    return rounded(drift_frame(spark, folder), "psi", "kl", "accuracy_as_known")


def drift_series_by_segment(spark, folder):
    return rounded(drift_frame(spark, folder, ["segment"]), "psi", "kl", "accuracy_as_known")


def noise_band(spark, folder):
    band = drift.noise_band(views.pred_log(spark, folder))
    return rounded(band, "baseline_accuracy", "daily_std", "threshold")


def _alerts(spark, folder, by=()):
    """Series and noise band from one scan: both read the stored daily table."""
    daily = materialise(drift.daily_outcomes(views.pred_log(spark, folder), EVENT_TYPES, by=by))
    baseline = drift.label_vector(views.baseline_log(spark, folder), "label", EVENT_TYPES, by)
    series = drift.drift_of_days(daily, baseline, EVENT_TYPES, by)
    return drift.first_alerts(series, drift.noise_band_of_days(daily, by), by)


def first_alerts(spark, folder):
    return _alerts(spark, folder).select("first_psi_day", "first_accuracy_day")


def lead_time(spark, folder):
    return _alerts(spark, folder).select("lead_days", "led_by")


def lead_time_by_segment(spark, folder):
    return _alerts(spark, folder, ["segment"])


def daily_telemetry(spark, folder):
    daily = evaluation.daily_telemetry(views.pred_log(spark, folder), by=["scenario"])
    return rounded(daily, "accuracy", "avg_confidence", "avg_latency_ms")


def prediction_counts(spark, folder):
    return evaluation.prediction_counts(views.pred_log(spark, folder))


def confidence_histogram(spark, folder):
    return rounded(evaluation.histogram(views.pred_log(spark, folder), "confidence"), "lower", "upper")


def incident_spans(spark, folder):
    """Spans of days whose own accuracy lies under the noise band."""
    daily = materialise(drift.daily_outcomes(views.pred_log(spark, folder), EVENT_TYPES))
    band = drift.noise_band_of_days(daily)
    accuracy = F.try_divide(F.col("_correct").cast("double"), F.col("_scored"))
    return incidents.incident_spans(daily.where(accuracy < band.select("threshold").scalar()))


def drift_incidents(spark, folder):
    found = incidents.drift_incidents(drift_frame(spark, folder))
    return rounded(found.select("start_day", "end_day", "peak_value", "impact_confirmed"), "peak_value")


QUERIES = {
    q.__name__: q
    for q in (
        scan_scenario, append_round_trip, label_distribution, rolling_distribution, rolling_psi, rolling_accuracy,
        label_delayed_accuracy, drift_series, drift_series_by_segment, noise_band, first_alerts, lead_time,
        lead_time_by_segment, daily_telemetry, prediction_counts, confidence_histogram, incident_spans,
        drift_incidents,
    )
}

ORACLES = {
    "scan_scenario": with_(PRED_LOG) + """
        SELECT event_id, day, label, predicted, correct, round(confidence, 6) AS confidence
        FROM pred_log WHERE scenario = 'drift'""",
    "append_round_trip": with_(PRED_LOG) + """
        SELECT scenario, day, count(*) AS n, count(DISTINCT event_id) AS n_events,
               CAST(sum(correct) AS BIGINT) AS n_correct, round(avg(confidence), 6) AS avg_confidence
        FROM pred_log GROUP BY scenario, day""",
    "label_distribution": with_(PRED_LOG) + """
        SELECT v.label, count(p.event_id) AS n,
               round(count(p.event_id) / CAST((SELECT count(*) FROM pred_log WHERE day < 7) AS DOUBLE), 6) AS p
        FROM vocabulary v LEFT JOIN (SELECT * FROM pred_log WHERE day < 7) p ON p.label = v.label
        GROUP BY v.label""",
    "rolling_distribution": with_(PRED_LOG, DAYS) + """
        SELECT d.day, v.label,
               (SELECT count(*) FROM pred_log p WHERE p.day > d.day - 7 AND p.day <= d.day) AS n_in_window,
               (SELECT count(*) FROM pred_log p
                WHERE p.day > d.day - 7 AND p.day <= d.day AND p.predicted = v.label) AS n,
               round(coalesce((SELECT avg(CAST(p.predicted = v.label AS INT)) FROM pred_log p
                WHERE p.day > d.day - 7 AND p.day <= d.day), 0), 6) AS p
        FROM days d CROSS JOIN vocabulary v""",
    "rolling_psi": with_(PRED_LOG, DAYS, PSI_ROWS) + """
        SELECT day, n_in_window, round(psi, 6) AS psi, round(kl, 6) AS kl FROM psi_rows WHERE segment = 'all'""",
    "rolling_accuracy": with_(PRED_LOG, DAYS) + """
        SELECT d.day, count(p.correct) AS n_scored, round(avg(p.correct), 6) AS accuracy
        FROM days d LEFT JOIN pred_log p ON p.day > d.day - 7 AND p.day <= d.day GROUP BY d.day""",
    "label_delayed_accuracy": with_(PRED_LOG, DAYS) + """
        SELECT d.day, CASE WHEN d.day - 5 >= 7 THEN round(avg(p.correct), 6) END AS accuracy_as_known
        FROM days d LEFT JOIN pred_log p ON p.day > d.day - 12 AND p.day <= d.day - 5 GROUP BY d.day""",
    "drift_series": with_(PRED_LOG, DAYS, PSI_ROWS, DRIFT_SERIES) + """
        SELECT day, n_in_window, round(psi, 6) AS psi, round(kl, 6) AS kl, psi_band,
               round(accuracy_as_known, 6) AS accuracy_as_known
        FROM drift_series WHERE segment = 'all'""",
    "drift_series_by_segment": with_(PRED_LOG, DAYS, PSI_ROWS, DRIFT_SERIES) + """
        SELECT segment, day, n_in_window, round(psi, 6) AS psi, round(kl, 6) AS kl, psi_band,
               round(accuracy_as_known, 6) AS accuracy_as_known
        FROM drift_series WHERE segment <> 'all'""",
    "noise_band": with_(PRED_LOG, NOISE_BAND) + """
        SELECT first_day, last_day, round(baseline_accuracy, 6) AS baseline_accuracy,
               round(daily_std, 6) AS daily_std, round(threshold, 6) AS threshold
        FROM noise_band WHERE segment = 'all'""",
    "first_alerts": with_(PRED_LOG, DAYS, PSI_ROWS, DRIFT_SERIES, NOISE_BAND) + """
        SELECT min(CASE WHEN psi > 0.25 THEN day END) AS first_psi_day,
               min(CASE WHEN accuracy_as_known < threshold THEN day END) AS first_accuracy_day
        FROM drift_series JOIN noise_band USING (segment) WHERE segment = 'all'""",
    "lead_time": with_(PRED_LOG, DAYS, PSI_ROWS, DRIFT_SERIES, NOISE_BAND) + """,
        firsts AS (SELECT min(CASE WHEN accuracy_as_known < threshold THEN day END)
                        - min(CASE WHEN psi > 0.25 THEN day END) AS lead_days
                   FROM drift_series JOIN noise_band USING (segment) WHERE segment = 'all')
        SELECT lead_days, CASE WHEN lead_days > 0 THEN 'psi' WHEN lead_days < 0 THEN 'accuracy'
                               WHEN lead_days = 0 THEN 'same_day' END AS led_by FROM firsts""",
    "lead_time_by_segment": with_(PRED_LOG, DAYS, PSI_ROWS, DRIFT_SERIES, NOISE_BAND) + """,
        firsts AS (SELECT segment, min(CASE WHEN psi > 0.25 THEN day END) AS first_psi_day,
                          min(CASE WHEN accuracy_as_known < threshold THEN day END) AS first_accuracy_day
                   FROM drift_series JOIN noise_band USING (segment) WHERE segment <> 'all' GROUP BY segment)
        SELECT *, first_accuracy_day - first_psi_day AS lead_days,
               CASE WHEN first_accuracy_day > first_psi_day THEN 'psi'
                    WHEN first_accuracy_day < first_psi_day THEN 'accuracy'
                    WHEN first_accuracy_day = first_psi_day THEN 'same_day' END AS led_by FROM firsts""",
    "daily_telemetry": with_(PRED_LOG) + """
        SELECT scenario, day, count(*) AS n, round(avg(correct), 6) AS accuracy,
               round(avg(confidence), 6) AS avg_confidence, round(avg(latency_ms), 6) AS avg_latency_ms
        FROM pred_log GROUP BY scenario, day""",
    "prediction_counts": with_(PRED_LOG) + "SELECT predicted, count(*) AS n FROM pred_log GROUP BY predicted",
    "confidence_histogram": with_(PRED_LOG) + """,
        span AS (SELECT min(confidence) AS lo, max(confidence) AS hi FROM pred_log),
        bins AS (SELECT CAST(i AS INT) AS bin, lo, hi, lo + (hi - lo) / 10 * CAST(i - 1 AS DOUBLE) AS a,
                        CASE WHEN i = 10 THEN hi ELSE lo + (hi - lo) / 10 * CAST(i AS DOUBLE) END AS b
                 FROM range(1, 11) r(i), span)
        SELECT bin, round(CASE WHEN bin = 1 THEN a - (hi - lo) * CAST(0.001 AS DOUBLE) ELSE a END, 6) AS lower,
               round(b, 6) AS upper,
               (SELECT count(*) FROM pred_log
                WHERE (confidence > a OR bin = 1) AND (confidence <= b OR bin = 10)) AS n
        FROM bins""",
    "incident_spans": with_(PRED_LOG, NOISE_BAND) + """,
        low AS (SELECT day FROM pred_log GROUP BY day
                HAVING avg(correct) < (SELECT threshold FROM noise_band WHERE segment = 'all')),
        starts AS (SELECT day FROM low l WHERE NOT EXISTS (SELECT 1 FROM low p WHERE p.day = l.day - 1)),
        ends AS (SELECT day FROM low l WHERE NOT EXISTS (SELECT 1 FROM low p WHERE p.day = l.day + 1))
        SELECT s.day AS start_day, (SELECT min(e.day) FROM ends e WHERE e.day >= s.day) AS end_day,
               CAST((SELECT min(e.day) FROM ends e WHERE e.day >= s.day) - s.day + 1 AS BIGINT) AS n_days
        FROM starts s""",
    "drift_incidents": with_(PRED_LOG, DAYS, PSI_ROWS, DRIFT_SERIES) + """,
        series AS (SELECT * FROM drift_series WHERE segment = 'all'),
        early AS (SELECT accuracy_as_known AS a FROM series WHERE accuracy_as_known IS NOT NULL ORDER BY day LIMIT 7),
        band AS (SELECT avg(a) - 2 * stddev_samp(a) AS threshold FROM early),
        alerts AS (SELECT * FROM series WHERE psi > 0.25),
        starts AS (SELECT day FROM alerts l WHERE NOT EXISTS (SELECT 1 FROM alerts p WHERE p.day = l.day - 1)),
        spans AS (SELECT s.day AS start_day,
                         (SELECT min(e.day) FROM alerts e WHERE e.day >= s.day
                          AND NOT EXISTS (SELECT 1 FROM alerts p WHERE p.day = e.day + 1)) AS end_day
                  FROM starts s)
        SELECT start_day, end_day,
               (SELECT round(max(psi), 6) FROM alerts WHERE day BETWEEN start_day AND end_day) AS peak_value,
               coalesce((SELECT min(accuracy_as_known) FROM alerts WHERE day BETWEEN start_day AND end_day)
                        < (SELECT threshold FROM band), FALSE) AS impact_confirmed
        FROM spans""",
}
