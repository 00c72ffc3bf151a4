"""Registered queries of batch scoring, classifier evaluation and training/serving skew."""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from modelvigil.functions.text import normalize_prediction as normalized
from modelvigil.functions.text import truncate
from modelvigil.operators import evaluation, scoring, sketches, skew
from modelvigil.plans.rolling import rounded
from modelvigil.plans.sql import MODEL_RUNS, PRED_LOG, REPEATED_RUNS, SKEW_EVAL, with_
from modelvigil.presets import ROLLING_DAYS
from modelvigil.session import materialise
from modelvigil.sources import views
from modelvigil.sources.views import LANG_LABELS, SERVING_LENGTHS

MODEL = ["model"]


def normalize_prediction(spark, folder):
    outputs = views.raw_outputs(spark, folder)
    return outputs.select("model", "ex_id", normalized(F.col("raw_output"), LANG_LABELS).alias("predicted"))


def eval_summary(spark, folder):
    summary = evaluation.accuracy_summary(views.model_runs(spark, folder), MODEL)
    return rounded(summary, "accuracy", "invalid_rate", "avg_output_tokens")


def eval_per_category(spark, folder):
    return rounded(evaluation.per_category(views.model_runs(spark, folder), LANG_LABELS, MODEL), "accuracy")


def eval_confusion(spark, folder):
    return evaluation.confusion(views.model_runs(spark, folder), MODEL)


def eval_top_confusions(spark, folder):
    return evaluation.top_confusions(views.model_runs(spark, folder), 5, MODEL)


def eval_latency(spark, folder):
    runs = materialise(views.model_runs(spark, folder).select("model", "ex_id", "latency_s"))
    latency = evaluation.latency_percentiles(runs, by=MODEL)
    return rounded(latency, "p50", "p95")


def rolling_latency(spark, folder):
    """Trailing median and 95th percentile of latencies from daily sketches, each held against the exact ranks.

    What is sketched differs from run to run inside its bound, so the query returns whether it is inside."""
    log = views.pred_log(spark, folder).select("day", "latency_ms")
    found = materialise(sketches.rolling_quantiles(sketches.daily_sketches(log, "latency_ms")))
    ends = F.explode(F.sequence(F.col("day"), F.col("day") + ROLLING_DAYS - 1))
    near = log.where(F.col("latency_ms").isNotNull()).select("latency_ms", ends.alias("day")).join(F.broadcast(found), "day")

    def inside(name, share):  # the rank that the value has, or ends at if it comes several times
        below, through = F.count_if(F.col("latency_ms") < F.col(name)), F.count_if(F.col("latency_ms") <= F.col(name))
        slack = 2 * sketches.rank_error() * F.count(F.lit(1)) + 1
        return ((below - slack <= share * F.count(F.lit(1))) & (through + slack >= share * F.count(F.lit(1)))).alias(f"{name}_inside")

    checked = near.groupBy("day", "n_in_window").agg(F.count(F.lit(1)).alias("n_counted"), inside("p50", 0.5), inside("p95", 0.95))
    return checked.select("day", "n_in_window", "n_counted", "p50_inside", "p95_inside")


def event_latency(spark, folder):
    log = views.pred_log(spark, folder)
    return rounded(evaluation.latency_percentiles(log, "latency_ms", row_key="event_id"), "p50", "p95")


def self_consistency(spark, folder):
    stable = evaluation.self_consistency(views.repeated_runs(spark, folder), MODEL)
    return rounded(stable, "self_consistency")


def compare_models(spark, folder):
    """The judged rows are stored once; every metric reads them instead of scoring again."""
    judged = materialise(
        views.model_runs(spark, folder).select(
            "model", "ex_id", "label", "predicted", "correct", "latency_s", "output_tokens"
        )
    )
    table = evaluation.compare_models(judged, "base", "tuned", views.repeated_runs(spark, folder), vocabulary=LANG_LABELS)
    return rounded(table, "base", "tuned", "delta")


def error_groups(spark, folder):
    return rounded(evaluation.error_groups(views.model_runs(spark, folder), MODEL), "share")


def offline_scores(spark, folder):
    return skew.score_paths(views.labelled_docs(spark, folder), views.language_rule, ())


def worst_errors(spark, folder):
    worst = evaluation.worst_errors(offline_scores(spark, folder), 10)
    return rounded(worst.select("place", "ex_id", "label", "predicted", "confidence"), "confidence")


def skew_scores(spark, folder):
    return skew.score_paths(views.labelled_docs(spark, folder), views.language_rule, SERVING_LENGTHS)


def skew_truncate(spark, folder):
    docs = views.labelled_docs(spark, folder)
    seen = docs.select("ex_id", truncate(F.col("text"), 60).alias("seen"))
    return seen.select("ex_id", "seen", F.length("seen").alias("n_seen"))


def skew_gap(spark, folder):
    gap = skew.skew_gap(skew.score_paths(views.labelled_docs(spark, folder), views.language_rule, (60,)))
    return rounded(gap, "offline_accuracy", "serving_accuracy", "offline_confidence", "serving_confidence", "gap")


def skew_sweep(spark, folder):
    swept = skew.skew_sweep(skew_scores(spark, folder), SERVING_LENGTHS)
    return rounded(swept, "offline_accuracy", "serving_accuracy", "offline_confidence", "serving_confidence", "gap")


def skew_by_category(spark, folder):
    table = skew.skew_by_category(skew_scores(spark, folder))
    return rounded(table, "offline_accuracy", "serving_accuracy", "gap", "confidence_wrong", "confidence_all")


def score_rule(spark, folder):
    scored = scoring.score_with_rule(views.labelled_docs(spark, folder), views.language_rule)
    scored = evaluation.with_correct(scored)
    return rounded(scored.select("ex_id", "predicted", "confidence", "correct"), "confidence")


def load_letter_scorer():
    """The language rule as a Python model, to be loaded once per worker."""
    letters = [(label, f"[{chars}]") for label, chars in views.LETTERS.items()]

    def score(texts: pd.Series) -> pd.DataFrame:
        started = time.perf_counter()
        hits = np.stack([texts.str.count(pattern).to_numpy() for _, pattern in letters])
        found = hits > 0
        first = np.where(found.any(axis=0), found.argmax(axis=0), -1)
        names = np.array([label for label, _ in letters] + ["lang_en"])
        chosen = np.where(first >= 0, hits[first, np.arange(len(texts))], 0)
        spent = (time.perf_counter() - started) * 1000 / max(len(texts), 1)
        return pd.DataFrame(
            {"predicted": names[first], "confidence": (chosen + 1) / (chosen + 2), "latency_ms": spent}
        )

    return score


def score_batched(spark, folder):
    docs = views.labelled_docs(spark, folder).select("ex_id", "label", "text")
    scored = scoring.score_in_batches(docs, load_letter_scorer, "letters", "1")
    scored = evaluation.with_correct(scored)
    return rounded(scored.select("ex_id", "predicted", "confidence", "correct"), "confidence")


def softmax_confidence(spark, folder):
    scored = scoring.softmax_confidence(
        views.score_vectors(spark, folder), "scores", views.SCORE_POSITIONS, views.SCORE_LABELS
    )
    scored = evaluation.with_correct(scored)
    return rounded(scored.select("ex_id", "predicted", "confidence", "correct"), "confidence")


QUERIES = {
    q.__name__: q
    for q in (
        normalize_prediction, eval_summary, eval_per_category, eval_confusion, eval_top_confusions, eval_latency,
        event_latency, rolling_latency, self_consistency, compare_models, error_groups, worst_errors, skew_truncate, skew_gap,
        skew_sweep, skew_by_category, score_rule, score_batched, softmax_confidence,
    )
}

_SCORED = with_(SKEW_EVAL) + """
    SELECT ex_id, predicted, round(confidence, 6) AS confidence, correct FROM skew_eval WHERE path = 'offline'"""

_SUMMARY = """
summary AS (
    SELECT model, avg(correct) AS accuracy, avg(CAST(predicted = 'INVALID' AS INT)) AS invalid_rate,
           avg(output_tokens) AS avg_output_tokens FROM model_runs GROUP BY model),
ordered AS (
    SELECT model, latency_s, row_number() OVER (PARTITION BY model ORDER BY latency_s) - 1 AS i,
           count(*) OVER (PARTITION BY model) AS n FROM model_runs),
latency AS (
    SELECT model,
           max(CASE WHEN i = least(CAST(floor(n * CAST(0.5 AS DOUBLE)) AS BIGINT), n - 1) THEN latency_s END) AS p50,
           max(CASE WHEN i = least(CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT), n - 1) THEN latency_s END) AS p95
    FROM ordered GROUP BY model)
"""

ORACLES = {
    "rolling_latency": with_(PRED_LOG) + """
        SELECT d.day, count(*) AS n_in_window, count(*) AS n_counted, TRUE AS p50_inside, TRUE AS p95_inside
        FROM (SELECT DISTINCT day FROM pred_log WHERE latency_ms IS NOT NULL) d
        JOIN pred_log p ON p.day > d.day - 7 AND p.day <= d.day AND p.latency_ms IS NOT NULL GROUP BY d.day""",
    "normalize_prediction": with_(MODEL_RUNS) + "SELECT model, ex_id, predicted FROM model_runs",
    "eval_summary": with_(MODEL_RUNS) + """
        SELECT model, count(*) AS n, CAST(sum(correct) AS BIGINT) AS n_correct, round(avg(correct), 6) AS accuracy,
               round(avg(CAST(predicted = 'INVALID' AS INT)), 6) AS invalid_rate,
               round(avg(output_tokens), 6) AS avg_output_tokens FROM model_runs GROUP BY model""",
    "eval_per_category": with_(MODEL_RUNS) + """
        SELECT m.model, v.label, count(r.ex_id) AS n, CAST(coalesce(sum(r.correct), 0) AS BIGINT) AS n_correct,
               round(coalesce(avg(r.correct), 0), 6) AS accuracy
        FROM (VALUES ('base'), ('tuned')) m(model)
        CROSS JOIN (VALUES ('lang_de'), ('lang_en'), ('lang_es'), ('lang_fr')) v(label)
        LEFT JOIN model_runs r ON r.model = m.model AND r.label = v.label GROUP BY m.model, v.label""",
    "eval_confusion": with_(MODEL_RUNS) + """
        SELECT model, label, predicted, count(*) AS n FROM model_runs GROUP BY ALL""",
    "eval_top_confusions": with_(MODEL_RUNS) + """,
        cells AS (SELECT model, label, predicted, count(*) AS n, min(ex_id) AS f FROM model_runs
                  WHERE label <> predicted GROUP BY ALL),
        placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY model ORDER BY n DESC, f) AS INT) AS place FROM cells)
        SELECT model, label, predicted, n, place FROM placed WHERE place <= 5""",
    "eval_latency": with_(MODEL_RUNS, _SUMMARY) + "SELECT model, round(p50, 6) AS p50, round(p95, 6) AS p95 FROM latency",
    "event_latency": """
        WITH o AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS i, count(*) OVER () AS n FROM events)
        SELECT round(max(CASE WHEN i = CAST(floor(n * CAST(0.5 AS DOUBLE)) AS BIGINT) THEN value END), 6) AS p50,
               round(max(CASE WHEN i = least(CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT), n - 1) THEN value END), 6)
               AS p95 FROM o""",
    "self_consistency": with_(REPEATED_RUNS) + """
        SELECT model, count(*) AS n_examples, count(*) FILTER (kinds = 1) AS n_agree,
               round(avg(CAST(kinds = 1 AS INT)), 6) AS self_consistency
        FROM (SELECT model, ex_id, count(DISTINCT predicted) AS kinds FROM repeated_runs GROUP BY ALL)
        GROUP BY model""",
    "compare_models": with_(MODEL_RUNS, _SUMMARY, REPEATED_RUNS) + """,
        stable AS (SELECT model, avg(CAST(kinds = 1 AS INT)) AS v
                   FROM (SELECT model, ex_id, count(DISTINCT predicted) AS kinds FROM repeated_runs GROUP BY ALL)
                   GROUP BY model),
        long AS (
            SELECT model, 'accuracy' AS metric, accuracy AS v FROM summary
            UNION ALL SELECT model, 'invalid_rate', invalid_rate FROM summary
            UNION ALL SELECT model, 'avg_output_tokens', avg_output_tokens FROM summary
            UNION ALL SELECT model, 'p50', p50 FROM latency UNION ALL SELECT model, 'p95', p95 FROM latency
            UNION ALL SELECT model, 'self_consistency', v FROM stable
            UNION ALL SELECT model, concat('accuracy:', label), avg(correct) FROM model_runs GROUP BY model, label)
        SELECT b.metric, round(b.v, 6) AS base, round(t.v, 6) AS tuned, round(t.v - b.v, 6) AS delta
        FROM long b JOIN long t ON t.metric = b.metric AND b.model = 'base' AND t.model = 'tuned'""",
    "error_groups": with_(MODEL_RUNS) + """
        SELECT model, label, predicted, count(*) AS n,
               round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY model) AS DOUBLE), 6) AS share
        FROM model_runs WHERE correct = 0 GROUP BY model, label, predicted""",
    "worst_errors": with_(SKEW_EVAL) + """
        SELECT CAST(row_number() OVER (ORDER BY confidence DESC, ex_id) AS INT) AS place, ex_id, label, predicted,
               round(confidence, 6) AS confidence
        FROM skew_eval WHERE path = 'offline' AND correct = 0 QUALIFY place <= 10""",
    "skew_truncate": """
        SELECT doc_id AS ex_id, substring(text, 1, 60) AS seen, CAST(least(length(text), 60) AS INT) AS n_seen
        FROM documents""",
    "skew_gap": with_(SKEW_EVAL) + """
        SELECT max_chars, round(offline_accuracy, 6) AS offline_accuracy,
               round(serving_accuracy, 6) AS serving_accuracy, round(offline_confidence, 6) AS offline_confidence,
               round(serving_confidence, 6) AS serving_confidence, round(gap, 6) AS gap, gap > 0.05 AS flagged
        FROM skew_gaps WHERE max_chars = 60""",
    "skew_sweep": with_(SKEW_EVAL) + """
        SELECT max_chars, round(offline_accuracy, 6) AS offline_accuracy,
               round(serving_accuracy, 6) AS serving_accuracy, round(offline_confidence, 6) AS offline_confidence,
               round(serving_confidence, 6) AS serving_confidence, round(gap, 6) AS gap, gap > 0.05 AS flagged
        FROM skew_gaps""",
    "skew_by_category": with_(SKEW_EVAL) + """,
        o AS (SELECT label, avg(correct) AS a FROM skew_eval WHERE path = 'offline' GROUP BY label)
        SELECT s.label, s.max_chars, count(*) AS n, round(o.a, 6) AS offline_accuracy,
               round(avg(s.correct), 6) AS serving_accuracy, round(o.a - avg(s.correct), 6) AS gap,
               round(avg(s.confidence) FILTER (s.correct = 0), 6) AS confidence_wrong,
               round(avg(s.confidence), 6) AS confidence_all
        FROM skew_eval s JOIN o USING (label) WHERE s.path = 'serving' GROUP BY s.label, s.max_chars, o.a""",
    "score_rule": _SCORED,
    "score_batched": _SCORED,
    "softmax_confidence": """
        WITH v AS (SELECT vec_id, CAST(label AS VARCHAR) AS label,
                          list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
        p AS (SELECT *, [e[1], e[7], e[13], e[19], e[25], e[31], e[37], e[43], e[49], e[55]] AS c FROM v),
        w AS (SELECT *, list_position(c, list_max(c)) - 1 AS best,
                     exp(list_max(c)) / list_sum(list_transform(e, lambda x: exp(x))) AS conf FROM p)
        SELECT vec_id AS ex_id, CAST(best AS VARCHAR) AS predicted, round(conf, 6) AS confidence,
               CAST(CAST(best AS VARCHAR) = label AS INT) AS correct FROM w""",
}
