import random

import pytest
from pyspark.sql import functions as F

from modelvigil.operators import incidents

DAY = "day int"


def spans(spark, days):
    df = spark.createDataFrame([(d,) for d in days], DAY)
    return sorted((r.start_day, r.end_day) for r in incidents.incident_spans(df).collect())


def test_spans(spark):
    assert spans(spark, [1, 2, 4, 5, 6, 9]) == [(1, 2), (4, 6), (9, 9)]
    assert spans(spark, [6, 5, 5, 4, 4]) == [(4, 6)]
    assert spans(spark, []) == []


def test_spans_cover_exactly_the_alert_days_of_each_key(spark):
    rng = random.Random(3)
    alerts = {(k, d) for k in "abc" for d in rng.sample(range(60), 25)}
    df = spark.createDataFrame(list(alerts), "metric string, day int")
    covered = set()
    for r in incidents.incident_spans(df, ["metric"]).collect():
        run = {(r.metric, d) for d in range(r.start_day, r.end_day + 1)}
        assert not covered & run and r.n_days == len(run)
        covered |= run
    assert covered == alerts


def drift_frame(spark, rows):
    return spark.createDataFrame(rows, "day int, psi double, accuracy_as_known double")


def long_drift(spark):
    """Forty days of significant drift, accuracy dipping once under the band of its first values."""
    early = [0.97, 0.96, 0.97, 0.975, 0.955, 0.964, 0.97]
    rows = []
    for day in range(7, 90):
        psi = 0.12 if day < 50 else (0.6509158342 if day == 72 else 0.45)
        accuracy = None if day < 12 else early[day - 12] if day < 19 else 0.9357142857 if day == 69 else 0.98
        rows.append((day, psi, accuracy))
    return drift_frame(spark, rows)


def test_long_confirmed_drift_is_one_p1(spark):
    found = incidents.score_priority(incidents.drift_incidents(long_drift(spark))).collect()
    assert len(found) == 1
    one = found[0]
    assert (one.start_day, one.end_day, one.impact_confirmed, one.priority) == (50, 89, True, "P1")
    assert one.peak_value == pytest.approx(0.6509158342)
    assert "93.6%" in one.impact_description


def test_drift_without_accuracy_impact_is_p4(spark):
    rows = [(d, 0.9 if d > 20 else 0.0, 0.95 + 0.001 * (d % 3)) for d in range(7, 60)]
    one = incidents.score_priority(incidents.drift_incidents(drift_frame(spark, rows))).head()
    assert one.priority == "P4" and not one.impact_confirmed


def test_unknown_accuracy_confirms_nothing(spark):
    one = incidents.drift_incidents(drift_frame(spark, [(7, 0.5, None), (8, 0.6, None)])).head()
    assert not one.impact_confirmed and (one.start_day, one.end_day) == (7, 8)
    assert "unknown" in one.impact_description
    single = incidents.drift_incidents(drift_frame(spark, [(7, 0.5, 0.1)])).head()
    assert not single.impact_confirmed


def test_impact_band_takes_seven_known_values(spark):
    early = [0.97, 0.96, 0.97, 0.975, 0.955, 0.964, 0.97]
    mean = sum(early) / 7
    std = (sum((x - mean) ** 2 for x in early) / 6) ** 0.5
    got = {r.impact_threshold for r in incidents.with_impact_threshold(long_drift(spark)).collect()}
    assert len(got) == 1 and got.pop() == pytest.approx(mean - 2 * std)


def quality_frame(spark, peaks, days=25):
    rows = [(d, *[p if d >= s else 0.0 for p, s in peaks]) for d in range(7, 7 + days)]
    return spark.createDataFrame(rows, "day int, null_text_rate double, sentinel_rate double, enum_rate double")


def test_digest_order(spark):
    gap = spark.createDataFrame([(60, 0.922, 0.826, 0.096, True)], "max_chars int, offline_accuracy double, serving_accuracy double, gap double, flagged boolean")
    quality = quality_frame(spark, [(0.214, 9), (0.357, 20), (0.271, 25)])
    digest = incidents.alert_digest(
        incidents.quality_incidents(quality), incidents.skew_incidents(gap), incidents.drift_incidents(long_drift(spark))
    )
    rows = digest.orderBy("digest_rank").collect()
    assert [(r.priority, r.alert_type) for r in rows] == [
        ("P1", "psi_shift"), ("P1", "null_or_empty_text"), ("P2", "offline_serving_gap"),
        ("P2", "silent_default_priority"), ("P2", "schema_violation_source_system"),
    ]
    assert [round(r.peak_value, 3) for r in rows] == [0.651, 0.214, 0.096, 0.357, 0.271]
    summary = incidents.digest_summary(digest).head()
    assert (summary.n_incidents, summary.n_confirmed, summary.n_page_worthy) == (5, 5, 5)
    assert summary.n_daily_signals == sum(r.end_day - r.start_day + 1 for r in rows)


@pytest.mark.parametrize(
    "stage, blocking, confirmed, peak, days, want",
    [
        (incidents.DRIFT, False, False, 5.0, 40, "P4"),
        (incidents.DRIFT, False, True, 0.4, 14, "P2"),
        (incidents.DRIFT, False, True, 0.41, 1, "P1"),
        (incidents.DRIFT, False, True, 0.3, 15, "P1"),
        (incidents.SKEW, False, True, 0.149, 1, "P2"),
        (incidents.SKEW, False, True, 0.15, 1, "P1"),
        (incidents.QUALITY, True, True, 0.10, 14, "P2"),
        (incidents.QUALITY, True, True, 0.11, 1, "P1"),
        (incidents.QUALITY, True, True, 0.03, 1, "P3"),
        (incidents.QUALITY, True, True, 0.03, 15, "P1"),
        (incidents.QUALITY, False, True, 0.25, 21, "P3"),
        (incidents.QUALITY, False, True, 0.26, 1, "P2"),
        (incidents.QUALITY, False, True, 0.06, 22, "P2"),
        (incidents.QUALITY, False, True, 0.10, 5, "P4"),
    ],
)
def test_priority_rules(spark, stage, blocking, confirmed, peak, days, want):
    df = spark.range(1).select(
        F.lit(stage).alias("source_stage"), F.lit(blocking).alias("blocking"), F.lit(confirmed).alias("impact_confirmed"),
        F.lit(peak).alias("peak_value"), F.lit(10).alias("start_day"), F.lit(10 + days - 1).alias("end_day"),
    )
    assert incidents.score_priority(df).head().priority == want


def test_incidents_per_key(spark):
    frame = long_drift(spark)
    both = frame.withColumn("tenant", F.lit("a")).unionByName(
        frame.withColumn("psi", F.col("psi") / 10).withColumn("tenant", F.lit("b"))
    )
    found = incidents.drift_incidents(both, by=["tenant"]).collect()
    assert [(r.tenant, r.start_day, r.end_day) for r in found] == [("a", 50, 89)]


def test_a_fourth_issue_type_reaches_the_digest(spark):
    rows = [(d, 0.0, 0.0, 0.0, 0.5 if d in (3, 4) else 0.0) for d in range(8)]
    series = spark.createDataFrame(
        rows, "day int, null_text_rate double, sentinel_rate double, enum_rate double, encoding_rate double"
    )
    rates = {**incidents.RATE_ALERTS, "encoding_rate": ("broken_encoding", True)}
    digest = incidents.alert_digest(incidents.quality_incidents(series, rates=rates), rates=rates).collect()
    assert [(r.alert_type, r.start_day, r.end_day, r.blocking, r.priority) for r in digest] == [("broken_encoding", 3, 4, True, "P1")]
    calm = incidents.alert_digest(
        incidents.quality_incidents(series, rates=rates), rates=rates, ladder={**incidents.PRIORITY_LADDER, "blocking_high": 0.6}
    )
    assert [r.priority for r in calm.collect()] == ["P2"]
