"""Registered queries of record validation and the data-quality monitor."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelvigil.functions.checks import check_reference
from modelvigil.operators import incidents, quality, skew
from modelvigil.plans.rolling import drift_frame, rounded
from modelvigil.plans.sql import (
    DAYS, DRIFT_SERIES, INGEST_LOG, PRED_LOG, PSI_ROWS, QUALITY_SERIES, SEGMENT_QUALITY, SKEW_EVAL, with_,
)
from modelvigil.sources import views

RATES = ("null_text_rate", "sentinel_rate", "enum_rate", "blocked_rate", "accuracy_unblocked")


def dq_validate(spark, folder):
    return views.checked_tickets(spark, folder).select(
        "event_id", "day", "blocked", "issue_types",
        F.size("issues").alias("n_issues"),
        F.array_join(F.transform("issues", lambda i: F.coalesce(i["value"], F.lit("NULL"))), ",").alias("bad_values"),
    )


def dq_validate_reference(spark, folder):
    """The checks of the log with its sources taken from a table: those that the first three weeks have."""
    tickets = views.raw_tickets(spark, folder)
    known = tickets.where(F.col("day") < 21).select(F.col("source_system").alias("name"))
    held = quality.with_reference(tickets, "source_system", known, "name", "_known")
    checks = [*views.ticket_checks()[:2], check_reference("source_system", "_known")]
    return quality.validate_records(held, checks).select(
        "event_id", "day", "blocked", "issue_types", F.size("issues").alias("n_issues")
    )


def dq_route(spark, folder):
    log = quality.score_unblocked(
        views.checked_tickets(spark, folder), lambda df: df.withColumns(views.ticket_outcomes())
    )
    return log.select(
        "event_id", "day", "blocked", "issue_types", "predicted", F.round("confidence", 6).alias("confidence"), "correct"
    )


def daily_ingestion(spark, folder):
    return quality.daily_ingestion(views.ingest_log(spark, folder))


def quality_frame(spark, folder):
    return quality.rolling_issue_rates(views.ingest_log(spark, folder))


def rolling_dq(spark, folder):
    return rounded(quality_frame(spark, folder), *RATES)


def rolling_dq_by_segment(spark, folder):
    series = quality.rolling_issue_rates(views.ingest_log(spark, folder), by=["segment"])
    return rounded(series, *RATES)


def dq_first_alerts(spark, folder):
    return quality.first_rate_alerts(quality_frame(spark, folder))


def dq_attribution(spark, folder):
    ends = quality.attribution(quality_frame(spark, folder))
    return rounded(ends, *ends.columns)


def data_gate(spark, folder):
    return quality.gate_problems(views.gate_rows(spark, folder), ("0", "1")).select("ex_id", "problem")


def dq_incidents(spark, folder):
    found = incidents.quality_incidents(quality_frame(spark, folder))
    return rounded(found.select("alert_type", "start_day", "end_day", "peak_value", "blocking"), "peak_value")


def skew_frame(spark, folder, lengths=(60,)):
    scored = skew.score_paths(views.labelled_docs(spark, folder), views.language_rule, lengths)
    return skew.skew_sweep(scored, lengths)


def skew_incidents(spark, folder):
    found = incidents.skew_incidents(skew_frame(spark, folder))
    return rounded(
        found.select("source_stage", "alert_type", "start_day", "end_day", "peak_value", "impact_confirmed"), "peak_value"
    )


def digest_frame(spark, folder):
    return incidents.alert_digest(
        incidents.drift_incidents(drift_frame(spark, folder)),
        incidents.skew_incidents(skew_frame(spark, folder)),
        incidents.quality_incidents(quality_frame(spark, folder)),
    )


def alert_digest(spark, folder):
    digest = digest_frame(spark, folder)
    kept = ["digest_rank", "priority", "source_stage", "alert_type", "start_day", "end_day", "peak_value", "impact_confirmed"]
    return rounded(digest.select(*kept), "peak_value")


def digest_summary(spark, folder):
    return incidents.digest_summary(digest_frame(spark, folder))


QUERIES = {
    q.__name__: q
    for q in (
        dq_validate, dq_validate_reference, dq_route, daily_ingestion, rolling_dq, rolling_dq_by_segment, dq_first_alerts, dq_attribution, data_gate,
        dq_incidents, skew_incidents, alert_digest, digest_summary,
    )
}

_LONG = """
long_rates AS (
    SELECT day, 'null_or_empty_text' AS alert_type, null_text_rate AS v, TRUE AS blocking FROM quality_series
    UNION ALL SELECT day, 'silent_default_priority', sentinel_rate, FALSE FROM quality_series
    UNION ALL SELECT day, 'schema_violation_source_system', enum_rate, FALSE FROM quality_series),
over AS (SELECT * FROM long_rates WHERE v > 0.05),
dq_starts AS (
    SELECT * FROM over o WHERE NOT EXISTS (
        SELECT 1 FROM over p WHERE p.alert_type = o.alert_type AND p.day = o.day - 1)),
dq_ends AS (
    SELECT * FROM over o WHERE NOT EXISTS (
        SELECT 1 FROM over p WHERE p.alert_type = o.alert_type AND p.day = o.day + 1)),
dq_spans AS (
    SELECT s.alert_type, s.blocking, s.day AS start_day, min(e.day) AS end_day
    FROM dq_starts s JOIN dq_ends e ON e.alert_type = s.alert_type AND e.day >= s.day GROUP BY ALL),
dq_incidents AS (
    SELECT s.alert_type, s.start_day, s.end_day, max(o.v) AS peak_value, s.blocking
    FROM dq_spans s JOIN over o ON o.alert_type = s.alert_type AND o.day BETWEEN s.start_day AND s.end_day
    GROUP BY ALL)
"""

_DIGEST = """
series AS (SELECT * FROM drift_series WHERE segment = 'all'),
early AS (SELECT accuracy_as_known AS a FROM series WHERE accuracy_as_known IS NOT NULL ORDER BY day LIMIT 7),
band AS (SELECT avg(a) - 2 * stddev_samp(a) AS threshold FROM early),
drift_over AS (SELECT *, day - row_number() OVER (ORDER BY day) AS g FROM series WHERE psi > 0.25),
found AS (
    SELECT 'data_drift' AS source_stage, 'psi_shift' AS alert_type, min(day) AS start_day, max(day) AS end_day,
           max(psi) AS peak_value,
           coalesce(min(accuracy_as_known) < (SELECT threshold FROM band), FALSE) AS impact_confirmed, 0 AS kind,
           CASE WHEN max(day) - min(day) + 1 > 14 OR max(psi) > 0.4 THEN 'P1' ELSE 'P2' END AS p
    FROM drift_over GROUP BY g
    UNION ALL
    SELECT 'serving_skew', 'offline_serving_gap', 0, 0, gap, TRUE, 1, CASE WHEN gap < 0.15 THEN 'P2' ELSE 'P1' END
    FROM skew_gaps WHERE max_chars = 60
    UNION ALL
    SELECT 'data_quality', alert_type, start_day, end_day, peak_value, TRUE,
           CASE alert_type WHEN 'null_or_empty_text' THEN 2 WHEN 'silent_default_priority' THEN 3 ELSE 4 END,
           CASE WHEN blocking AND (peak_value > 0.10 OR end_day - start_day + 1 > 14) THEN 'P1'
                WHEN blocking AND peak_value > 0.03 THEN 'P2' WHEN blocking THEN 'P3'
                WHEN peak_value > 0.25 OR end_day - start_day + 1 > 21 THEN 'P2'
                WHEN peak_value > 0.10 THEN 'P3' ELSE 'P4' END
    FROM dq_incidents),
digest AS (
    SELECT *, CASE WHEN impact_confirmed THEN p ELSE 'P4' END AS priority FROM found)
"""

_ALL = (PRED_LOG, DAYS, PSI_ROWS, DRIFT_SERIES, INGEST_LOG, QUALITY_SERIES, _LONG, SKEW_EVAL, _DIGEST)

ORACLES = {
    "dq_validate": with_(INGEST_LOG) + """
        SELECT event_id, day, blocked, issue_types,
               CAST(CASE WHEN issue_types = '' THEN 0 ELSE len(string_split(issue_types, ',')) END AS INT) AS n_issues,
               concat_ws(',', CASE WHEN bad_text THEN coalesce(ticket_text, 'NULL') END,
                         CASE WHEN bad_priority THEN priority END,
                         CASE WHEN bad_source THEN source_system END) AS bad_values
        FROM ingest_log""",
    "dq_validate_reference": with_(INGEST_LOG) + """,
        checked AS (
            SELECT event_id, day, CAST(bad_text AS INT) AS blocked,
                   concat_ws(',', CASE WHEN bad_text THEN 'null_or_empty_text' END,
                             CASE WHEN bad_priority THEN 'silent_default_priority' END,
                             CASE WHEN source_system IS NOT NULL
                                       AND source_system NOT IN (SELECT source_system FROM raw_tickets WHERE day < 21)
                                  THEN 'unknown_reference_value' END) AS issue_types
            FROM flagged)
        SELECT *, CAST(CASE WHEN issue_types = '' THEN 0 ELSE len(string_split(issue_types, ',')) END AS INT) AS n_issues
        FROM checked""",
    "dq_route": with_(INGEST_LOG) + """
        SELECT event_id, day, blocked, issue_types, predicted, round(confidence, 6) AS confidence, correct
        FROM ingest_log""",
    "daily_ingestion": with_(INGEST_LOG) + """
        SELECT day, count(*) AS n, count(*) FILTER (issue_types <> '') AS n_with_issue,
               CAST(sum(blocked) AS BIGINT) AS n_blocked FROM ingest_log GROUP BY day""",
    "rolling_dq": with_(INGEST_LOG, QUALITY_SERIES) + """
        SELECT day, round(null_text_rate, 6) AS null_text_rate, round(sentinel_rate, 6) AS sentinel_rate,
               round(enum_rate, 6) AS enum_rate, round(blocked_rate, 6) AS blocked_rate,
               round(accuracy_unblocked, 6) AS accuracy_unblocked FROM quality_series""",
    "rolling_dq_by_segment": with_(INGEST_LOG, QUALITY_SERIES, SEGMENT_QUALITY) + """
        SELECT segment, day, round(null_text_rate, 6) AS null_text_rate, round(sentinel_rate, 6) AS sentinel_rate,
               round(enum_rate, 6) AS enum_rate, round(blocked_rate, 6) AS blocked_rate,
               round(accuracy_unblocked, 6) AS accuracy_unblocked
        FROM segment_quality""",
    "dq_first_alerts": with_(INGEST_LOG, QUALITY_SERIES) + """
        SELECT 'null_text_rate' AS metric, min(CASE WHEN null_text_rate > 0.05 THEN day END) AS first_day
        FROM quality_series
        UNION ALL SELECT 'sentinel_rate', min(CASE WHEN sentinel_rate > 0.05 THEN day END) FROM quality_series
        UNION ALL SELECT 'enum_rate', min(CASE WHEN enum_rate > 0.05 THEN day END) FROM quality_series""",
    "dq_attribution": with_(INGEST_LOG, QUALITY_SERIES) + """,
        a AS (SELECT * FROM quality_series ORDER BY day LIMIT 1),
        z AS (SELECT * FROM quality_series ORDER BY day DESC LIMIT 1)
        SELECT round(a.accuracy_unblocked, 6) AS accuracy_first, round(z.accuracy_unblocked, 6) AS accuracy_last,
               round(a.blocked_rate, 6) AS blocked_first, round(z.blocked_rate, 6) AS blocked_last,
               round(z.accuracy_unblocked - a.accuracy_unblocked, 6) AS accuracy_change,
               round(z.blocked_rate - a.blocked_rate, 6) AS blocked_change FROM a, z""",
    "data_gate": r"""
        WITH rows AS (
            SELECT doc_id, text, CAST(quality AS VARCHAR) AS label FROM documents LEFT JOIN labels USING (doc_id))
        SELECT doc_id AS ex_id, 'short_text' AS problem FROM rows
        WHERE text IS NULL OR length(regexp_replace(text, '^[\s\x{1c}-\x{1f}\x{85}\p{Z}]+|[\s\x{1c}-\x{1f}\x{85}\p{Z}]+$', '', 'g')) < 5
        UNION ALL
        SELECT doc_id, 'invalid_label' FROM rows WHERE label IS NULL OR label NOT IN ('0', '1')""",
    "dq_incidents": with_(INGEST_LOG, QUALITY_SERIES, _LONG) + """
        SELECT alert_type, start_day, end_day, round(peak_value, 6) AS peak_value, blocking FROM dq_incidents""",
    "skew_incidents": with_(SKEW_EVAL) + """
        SELECT 'serving_skew' AS source_stage, 'offline_serving_gap' AS alert_type, CAST(0 AS INT) AS start_day,
               CAST(0 AS INT) AS end_day, round(gap, 6) AS peak_value, TRUE AS impact_confirmed
        FROM skew_gaps WHERE max_chars = 60""",
    "alert_digest": with_(*_ALL) + """
        SELECT CAST(row_number() OVER (ORDER BY priority, kind, start_day) AS INT) AS digest_rank, priority,
               source_stage, alert_type, CAST(start_day AS INT) AS start_day, CAST(end_day AS INT) AS end_day,
               round(peak_value, 6) AS peak_value, impact_confirmed FROM digest""",
    "digest_summary": with_(*_ALL) + """
        SELECT count(*) AS n_incidents, count(*) FILTER (impact_confirmed) AS n_confirmed,
               count(*) FILTER (priority IN ('P1', 'P2')) AS n_page_worthy,
               CAST(sum(end_day - start_day + 1) AS BIGINT) AS n_daily_signals FROM digest""",
}
