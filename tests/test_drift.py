import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modelvigil.operators import drift, timeseries
from tests.test_functions import reference_kl, reference_psi

VOCABULARY = ["a", "b", "c"]
SCHEMA = "key string, day int, predicted string, correct int"


def brute_series(rows, baseline, window=7, delay=5):
    """The definition, day by day over all rows."""
    import numpy as np

    out = {}
    for day in range(window, max(r[1] for r in rows) + 1):
        inside = [r[2] for r in rows if day - window < r[1] <= day and r[2] is not None]
        shares = np.array([inside.count(v) / len(inside) if inside else 0.0 for v in VOCABULARY])
        known = day - delay
        hits = [r[3] for r in rows if known - window < r[1] <= known and r[3] is not None]
        accuracy = sum(hits) / len(hits) if known >= window and hits else None
        base = np.array(baseline)
        out[day] = (len(inside), reference_psi(base, shares), reference_kl(base, shares), accuracy)
    return out


def same(got, want):
    assert set(got) == set(want)
    for day, expected in want.items():
        for x, y in zip(got[day], expected):
            assert (x is None) == (y is None)
            assert x is None or x == pytest.approx(y, abs=1e-9)


def series_of(df, baseline, by=()):
    rows = drift.drift_series(df, baseline, VOCABULARY, by=by).collect()
    out = {}
    for r in rows:
        key = tuple(r[k] for k in by)
        out.setdefault(key, {})[r.day] = (r.n_in_window, r.psi, r.kl, r.accuracy_as_known)
    return out


def random_rows(seed, n=300, days=30):
    rng = random.Random(seed)
    observed = sorted(rng.sample(range(days), 12))
    return [
        (rng.choice(["x", "y"]), rng.choice(observed), rng.choice(["a", "b", "c", "zzz", None]), rng.choice([0, 1, 1, None]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_series_equals_the_definition_on_sparse_days(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    baseline = [0.5, 0.3, 0.2]
    same(series_of(df, baseline)[()], brute_series(rows, baseline))
    by_key = series_of(df.repartition(5), baseline, ["key"])
    for key in ("x", "y"):
        same(by_key[(key,)], brute_series([r for r in rows if r[0] == key], baseline))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.just("x"), st.integers(0, 16), st.sampled_from(["a", "b", None]), st.sampled_from([0, 1, None])), min_size=1, max_size=25))
def test_series_property(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = series_of(df, [0.4, 0.4, 0.2]).get((), {})
    same(got, brute_series(rows, [0.4, 0.4, 0.2]))


def test_baseline_from_a_frame_per_key(spark):
    rows = random_rows(9)
    df = spark.createDataFrame(rows, SCHEMA)
    base = drift.label_vector(df.where("day < 10"), "predicted", VOCABULARY, ["key"])
    got = series_of(df, base, ["key"])
    vectors = {r.key: r.baseline for r in base.collect()}
    for key, vector in vectors.items():
        same(got[(key,)], brute_series([r for r in rows if r[0] == key], vector))


def test_days_without_traffic_are_reported(spark):
    df = spark.createDataFrame([("x", 12, "a", 1), ("x", 30, "a", 0)], SCHEMA)
    got = series_of(df, [1.0, 0.0, 0.0])[()]
    assert sorted(got) == list(range(7, 31))
    assert got[7][0] == 0 and got[20][0] == 0 and got[20][1] > 1
    assert got[12][0] == 1 and got[18][0] == 1 and got[19][0] == 0


def test_one_day_of_history(spark):
    df = spark.createDataFrame([("x", 3, "a", 1), ("x", 3, "b", 0)], SCHEMA)
    assert drift.drift_series(df, [1.0, 0.0, 0.0], VOCABULARY).count() == 0
    band = drift.noise_band(df).head()
    assert band.baseline_accuracy == 0.5 and band.daily_std is None and band.threshold is None


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert drift.drift_series(df, [1.0, 0.0, 0.0], VOCABULARY).count() == 0
    assert [r.n for r in drift.label_distribution(df, "predicted", VOCABULARY).collect()] == [0, 0, 0]


def test_noise_band_uses_the_first_observed_days(spark):
    rows = [("x", d, "a", int(i < k)) for d, k in [(2, 9), (3, 8), (5, 10), (9, 7), (11, 9), (12, 10), (20, 9), (25, 0)] for i in range(10)]
    rows += [("x", 2, "a", 0)] * 10
    band = drift.noise_band(spark.createDataFrame(rows, SCHEMA)).head()
    means = [9 / 20, 0.8, 1.0, 0.7, 0.9, 1.0, 0.9]
    assert (band.first_day, band.last_day) == (2, 20)
    assert band.baseline_accuracy == pytest.approx(62 / 80)
    assert band.daily_std == pytest.approx(statistics.stdev(means))
    assert band.threshold == pytest.approx(62 / 80 - 2 * statistics.stdev(means))


def test_first_alerts_are_strict_and_null_when_none(spark):
    series = spark.createDataFrame(
        [("k", 7, 0.25, None), ("k", 8, 0.26, 0.9), ("k", 9, 0.3, 0.7), ("q", 7, 0.1, 0.95)],
        "key string, day int, psi double, accuracy_as_known double",
    )
    band = spark.createDataFrame([("k", 0.9), ("q", None)], "key string, threshold double")
    got = {r.key: r for r in drift.first_alerts(series, band, ["key"]).collect()}
    assert (got["k"].first_psi_day, got["k"].first_accuracy_day, got["k"].lead_days, got["k"].led_by) == (8, 9, 1, "psi")
    assert got["q"].first_psi_day is None and got["q"].lead_days is None and got["q"].led_by is None
    assert drift.first_crossing(series.where("key = 'k'"), "psi", above=0.25).head()[0] == 8
    assert drift.first_crossing(series, "accuracy_as_known", below=0.5).head()[0] is None


def test_label_delay_reads_the_exact_day(spark):
    series = spark.createDataFrame([(7, 0.5), (8, 0.6), (13, 0.7)], "day int, accuracy double")
    got = {r.day: r.accuracy_as_known for r in drift.label_delayed(series, delay=5).collect()}
    assert got == {7: None, 8: None, 13: 0.6}


def test_raw_rows_shuffle_only_as_daily_partials(spark):
    df = spark.range(1000).select(
        F.lit("x").alias("key"), (F.col("id") % 20).cast("int").alias("day"), F.lit("a").alias("predicted"), F.lit(1).alias("correct")
    )
    plan = timeseries.rolling_counts(df, {"n": F.count(F.lit(1))}, by=["key"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") == 1 and "Join" not in plan


def test_a_silent_segment_keeps_its_rows_to_the_common_last_day(spark):
    rows = [("loud", d) for d in range(30)] + [("silent", d) for d in range(12)]
    df = spark.createDataFrame(rows, "key string, day int")
    rolled = timeseries.rolling_counts(df, {"n": F.count(F.lit(1))}, by=["key"]).collect()
    got = {(r.key, r.day): r.n for r in rolled}
    assert sorted(d for k, d in got if k == "silent") == list(range(7, 30))
    assert got["silent", 12] == 6 and all(got["silent", d] == 0 for d in range(18, 30))


def test_a_stray_date_fails_or_is_reported(spark):
    df = spark.createDataFrame([("a", d) for d in range(20)] + [("a", 2_932_896), ("b", -19_723)], "key string, day int")
    n = {"n": F.count(F.lit(1))}
    with pytest.raises(Exception, match="give a range of days"):
        timeseries.rolling_counts(df, n, by=["key"]).collect()
    inside = timeseries.rolling_counts(df, n, by=["key"], days=(0, 3_000)).collect()
    assert sorted(r.day for r in inside) == list(range(7, 20))
    outside = timeseries.rows_outside(df, (0, 3_000), by=["key"]).collect()
    assert sorted((r.key, r.day, r.n) for r in outside) == [("a", 2_932_896, 1), ("b", -19_723, 1)]
