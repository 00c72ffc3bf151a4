"""SQL fragments shared by the comparison queries; written apart from the Spark form on purpose."""

from __future__ import annotations


def with_(*fragments: str) -> str:
    return "WITH " + ",\n".join(f.strip() for f in fragments)


PRED_LOG = """
vocabulary AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS label),
keyed AS (
    SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
           CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS day
    FROM events),
said AS (
    SELECT *, CASE WHEN k < (CASE WHEN day >= 15 THEN 30 ELSE 5 END) THEN 'error' ELSE event_type END AS predicted
    FROM keyed),
pred_log AS (
    SELECT event_id, ts, day, event_type AS label, predicted, CAST(predicted = event_type AS INT) AS correct,
           (100 - k) / CAST(100 AS DOUBLE) AS confidence, value AS latency_ms,
           CASE WHEN user_id % 2 = 0 THEN 'drift' ELSE 'baseline' END AS scenario,
           concat('seg', user_id % 4) AS segment
    FROM said),
both_levels AS (
    SELECT * FROM pred_log UNION ALL SELECT * REPLACE ('all' AS segment) FROM pred_log)
"""

DAYS = """
days AS (SELECT CAST(d AS INT) AS day FROM range(7, (SELECT max(day) + 1 FROM pred_log)) r(d)),
segment_days AS (
    SELECT segment, CAST(unnest(range(7, (SELECT max(day) + 1 FROM both_levels))) AS INT) AS day
    FROM (SELECT DISTINCT segment FROM both_levels))
"""

PSI_ROWS = """
base AS (
    SELECT segment, label, count(*) AS n, sum(count(*)) OVER (PARTITION BY segment) AS total
    FROM both_levels WHERE day < 7 GROUP BY segment, label),
day_counts AS (SELECT segment, day, predicted, count(*) AS n FROM both_levels GROUP BY ALL),
window_counts AS (
    SELECT d.segment, d.day, c.predicted, sum(c.n) AS n
    FROM segment_days d LEFT JOIN day_counts c ON c.segment = d.segment AND c.day > d.day - 7 AND c.day <= d.day
    GROUP BY ALL),
window_totals AS (SELECT segment, day, coalesce(sum(n), 0) AS total FROM window_counts GROUP BY ALL),
clipped AS (
    SELECT t.segment, t.day, t.total,
           greatest(coalesce(b.n / CAST(b.total AS DOUBLE), 0), 1e-4) AS b,
           greatest(coalesce(w.n / CAST(nullif(t.total, 0) AS DOUBLE), 0), 1e-4) AS c
    FROM window_totals t CROSS JOIN vocabulary v
    LEFT JOIN base b ON b.segment = t.segment AND b.label = v.label
    LEFT JOIN window_counts w ON w.segment = t.segment AND w.day = t.day AND w.predicted = v.label),
psi_rows AS (
    SELECT segment, day, CAST(max(total) AS BIGINT) AS n_in_window, sum((c - b) * ln(c / b)) AS psi,
           sum(c * ln(c / b)) / sum(c) - ln(sum(c) / sum(b)) AS kl
    FROM clipped GROUP BY segment, day)
"""

DRIFT_SERIES = """
day_hits AS (SELECT segment, day, sum(correct) AS k, count(correct) AS n FROM both_levels GROUP BY ALL),
drift_series AS (
    SELECT p.*,
           CASE WHEN psi > 0.25 THEN 'significant' WHEN psi >= 0.10 THEN 'moderate' ELSE 'none' END AS psi_band,
           CASE WHEN p.day - 5 >= 7 THEN
               (SELECT sum(h.k) / CAST(sum(h.n) AS DOUBLE) FROM day_hits h
                WHERE h.segment = p.segment AND h.day > p.day - 12 AND h.day <= p.day - 5) END AS accuracy_as_known
    FROM psi_rows p)
"""

NOISE_BAND = """
day_accuracy AS (
    SELECT segment, day, sum(correct) AS k, count(correct) AS n, avg(correct) AS a,
           row_number() OVER (PARTITION BY segment ORDER BY day) AS nth
    FROM both_levels GROUP BY segment, day),
noise_band AS (
    SELECT segment, min(day) AS first_day, max(day) AS last_day,
           sum(k) / CAST(sum(n) AS DOUBLE) AS baseline_accuracy, stddev_samp(a) AS daily_std,
           sum(k) / CAST(sum(n) AS DOUBLE) - 2 * stddev_samp(a) AS threshold
    FROM day_accuracy WHERE nth <= 7 GROUP BY segment)
"""

INGEST_LOG = """
tickets AS (
    SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
           CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS day
    FROM events),
raw_tickets AS (
    SELECT event_id, ts, day, k, event_type AS label,
           CASE WHEN day >= 7 AND k < 15 THEN (CASE WHEN k % 2 = 1 THEN '' END)
                ELSE concat(event_type, ' #', event_id) END AS ticket_text,
           CASE WHEN day >= 15 AND k BETWEEN 20 AND 49 THEN 'UNSET' ELSE concat('P', 1 + user_id % 5) END AS priority,
           CASE WHEN day >= 21 AND k >= 80 THEN 'new_source' ELSE concat('src', user_id % 4) END AS source_system,
           concat('seg', user_id % 4) AS segment
    FROM tickets),
flagged AS (
    SELECT *, ticket_text IS NULL OR length(trim(ticket_text)) < 5 AS bad_text,
           coalesce(priority = 'UNSET', FALSE) AS bad_priority,
           coalesce(source_system NOT IN ('src0', 'src1', 'src2', 'src3'), FALSE) AS bad_source,
           CASE WHEN k BETWEEN 50 AND 52 THEN 'error' ELSE label END AS said
    FROM raw_tickets),
ingest_log AS (
    SELECT *, CAST(bad_text AS INT) AS blocked,
           concat_ws(',', CASE WHEN bad_text THEN 'null_or_empty_text' END,
                     CASE WHEN bad_priority THEN 'silent_default_priority' END,
                     CASE WHEN bad_source THEN 'schema_violation_source_system' END) AS issue_types,
           CASE WHEN NOT bad_text THEN said END AS predicted,
           CASE WHEN NOT bad_text THEN (100 - k) / CAST(100 AS DOUBLE) END AS confidence,
           CASE WHEN NOT bad_text THEN CAST(said = label AS INT) END AS correct
    FROM flagged)
"""

QUALITY_SERIES = """
quality_days AS (SELECT CAST(d AS INT) AS day FROM range(7, (SELECT max(day) + 1 FROM ingest_log)) r(d)),
quality_series AS (
    SELECT d.day, avg(CAST(bad_text AS INT)) AS null_text_rate, avg(CAST(bad_priority AS INT)) AS sentinel_rate,
           avg(CAST(bad_source AS INT)) AS enum_rate, avg(blocked) AS blocked_rate,
           avg(correct) FILTER (blocked = 0) AS accuracy_unblocked
    FROM quality_days d LEFT JOIN ingest_log i ON i.day > d.day - 7 AND i.day <= d.day GROUP BY d.day)
"""

SEGMENT_QUALITY = """
segment_quality AS (
    SELECT s.segment, d.day, avg(CAST(bad_text AS INT)) AS null_text_rate, avg(CAST(bad_priority AS INT)) AS sentinel_rate,
           avg(CAST(bad_source AS INT)) AS enum_rate, avg(blocked) AS blocked_rate,
           avg(correct) FILTER (blocked = 0) AS accuracy_unblocked
    FROM quality_days d CROSS JOIN (SELECT DISTINCT segment FROM ingest_log) s
    LEFT JOIN ingest_log i ON i.segment = s.segment AND i.day > d.day - 7 AND i.day <= d.day GROUP BY ALL)
"""

# The language rule by counting letters with a regular expression instead of translate.
LETTER_RULE = """
seen_letters AS (
    SELECT *, length(seen) - length(regexp_replace(seen, '[ßäöü]', '', 'g')) AS hd,
           length(seen) - length(regexp_replace(seen, '[ñáíóú]', '', 'g')) AS hs,
           length(seen) - length(regexp_replace(seen, '[èéêçà]', '', 'g')) AS hf
    FROM seen_texts)
"""

SKEW_EVAL = """
seen_texts AS (
    SELECT doc_id AS ex_id, concat('lang_', lang) AS label, path, CAST(n AS INT) AS max_chars,
           CASE WHEN n IS NULL THEN text ELSE substring(text, 1, n) END AS seen
    FROM documents CROSS JOIN (VALUES ('offline', NULL), ('serving', 60), ('serving', 40), ('serving', 30)) p(path, n)),
""" + LETTER_RULE + """,
skew_eval AS (
    SELECT ex_id, label, path, max_chars, predicted, CAST(predicted = label AS INT) AS correct,
           (h + 1) / CAST(h + 2 AS DOUBLE) AS confidence
    FROM (SELECT *, CASE WHEN hd > 0 THEN 'lang_de' WHEN hs > 0 THEN 'lang_es' WHEN hf > 0 THEN 'lang_fr'
                         ELSE 'lang_en' END AS predicted,
                 CASE WHEN hd > 0 THEN hd WHEN hs > 0 THEN hs ELSE hf END AS h FROM seen_letters)),
skew_gaps AS (
    SELECT s.max_chars, (SELECT avg(correct) FROM skew_eval WHERE path = 'offline') AS offline_accuracy,
           avg(s.correct) AS serving_accuracy,
           (SELECT avg(confidence) FROM skew_eval WHERE path = 'offline') AS offline_confidence,
           avg(s.confidence) AS serving_confidence,
           (SELECT avg(correct) FROM skew_eval WHERE path = 'offline') - avg(s.correct) AS gap
    FROM skew_eval s WHERE s.path = 'serving' GROUP BY s.max_chars)
"""

_SPOKEN = """
        CASE WHEN hd > 0 THEN 'lang_de' WHEN hs > 0 THEN 'lang_es' WHEN hf > 0 THEN 'lang_fr'
             WHEN model = 'base' THEN 'INVALID' ELSE 'lang_en' END
"""

MODEL_RUNS = """
model_letters AS (
    SELECT doc_id AS ex_id, concat('lang_', lang) AS label, source, length(text) AS size, model, i,
           regexp_matches(text, '[ßäöü]')::INT AS hd, regexp_matches(text, '[ñáíóú]')::INT AS hs,
           regexp_matches(text, '[èéêçà]')::INT AS hf, regexp_matches(lower(text), ' (the|of|and) ') AS english
    FROM documents CROSS JOIN (VALUES ('base', 0), ('tuned', 1)) m(model, i)),
model_said AS (SELECT *, """ + _SPOKEN + """ AS predicted FROM model_letters),
model_runs AS (
    SELECT model, ex_id, label, source, predicted, CAST(predicted = label AS INT) AS correct,
           (size + 37 * i) / (CAST(100000 AS DOUBLE) / (i + 1)) AS latency_s,
           CASE WHEN model = 'base' THEN (CASE WHEN predicted = 'INVALID' THEN 2 ELSE 6 END)
                WHEN predicted = 'lang_en' AND NOT english THEN 6
                WHEN predicted = 'lang_en' THEN 1 ELSE 1 END AS output_tokens
    FROM model_said)
"""

REPEATED_RUNS = """
run_parts AS (
    SELECT doc_id AS ex_id, model, run,
           substring(text, CAST(run * ((length(text) + 4) // 5) + 1 AS BIGINT), CAST((length(text) + 4) // 5 AS BIGINT)) AS part
    FROM documents CROSS JOIN (VALUES ('base'), ('tuned')) m(model) CROSS JOIN range(5) r(run)),
run_letters AS (
    SELECT *, regexp_matches(part, '[ßäöü]')::INT AS hd, regexp_matches(part, '[ñáíóú]')::INT AS hs,
           regexp_matches(part, '[èéêçà]')::INT AS hf FROM run_parts),
repeated_runs AS (SELECT model, ex_id, run, """ + _SPOKEN + """ AS predicted FROM run_letters)
"""
