import random

import pytest
from pyspark.sql import functions as F

from modelvigil.functions.checks import check_enum, check_null_text, check_sentinel
from modelvigil.operators import quality

RULES = [check_null_text("body"), check_sentinel("priority"), check_enum("origin", ["web", "mail"])]


def log(spark, seed=1, n=250):
    rng = random.Random(seed)
    days = rng.sample(range(26), 11)
    rows = [
        (i, rng.choice(days), rng.choice([None, "", "good text", "other text"]), rng.choice(["P1", "UNSET", None]), rng.choice(["web", "mail", "fax", None]), rng.choice([0, 1]), rng.choice("xy"))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "id int, day int, body string, priority string, origin string, correct int, tenant string")
    checked = quality.validate_records(df, RULES).withColumn("correct", F.when(F.col("blocked") == 0, F.col("correct")))
    return rows, checked


def expected(rows, day, window=7):
    inside = [r for r in rows if day - window < r[1] <= day]
    n = len(inside)
    if not n:
        return (None,) * 5
    clean = [r[5] for r in inside if r[2] not in (None, "")]
    return (
        (n - len(clean)) / n, sum(r[3] == "UNSET" for r in inside) / n, sum(r[4] == "fax" for r in inside) / n,
        (n - len(clean)) / n, sum(clean) / len(clean) if clean else None,
    )


@pytest.mark.parametrize("by", [[], ["tenant"]])
def test_rates_equal_the_definition(spark, by):
    rows, checked = log(spark)
    series = quality.rolling_issue_rates(checked, by=by).collect()
    keys = {tuple(r[k] for k in by) for r in series}
    assert keys == ({("x",), ("y",)} if by else {()})
    for key in keys:
        mine = [r for r in rows if not by or r[6] == key[0]]
        got = {r.day: r for r in series if tuple(r[k] for k in by) == key}
        assert sorted(got) == list(range(7, max(r[1] for r in mine) + 1))
        for day, r in got.items():
            values = (r.null_text_rate, r.sentinel_rate, r.enum_rate, r.blocked_rate, r.accuracy_unblocked)
            for x, y in zip(values, expected(mine, day)):
                assert (x is None) == (y is None) and (x is None or x == pytest.approx(y))


def test_first_alerts_and_attribution(spark):
    series = spark.createDataFrame(
        [(7, 0.05, 0.2, 0.0, 0.05, 0.9), (8, 0.06, 0.1, 0.0, 0.2, None), (9, 0.0, 0.0, 0.0, 0.3, 0.85)],
        "day int, null_text_rate double, sentinel_rate double, enum_rate double, blocked_rate double, accuracy_unblocked double",
    )
    got = {r.metric: r.first_day for r in quality.first_rate_alerts(series).collect()}
    assert got == {"null_text_rate": 8, "sentinel_rate": 7, "enum_rate": None}
    ends = quality.attribution(series).head()
    assert (ends.accuracy_first, ends.accuracy_last, ends.blocked_first, ends.blocked_last) == (0.9, 0.85, 0.05, 0.3)
    assert quality.attribution(series.where("day < 9")).head().accuracy_last is None


def test_daily_counts(spark):
    rows, checked = log(spark)
    got = {r.day: (r.n, r.n_with_issue, r.n_blocked) for r in quality.daily_ingestion(checked).collect()}
    for day in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == day]
        blocked = [r for r in mine if r[2] in (None, "")]
        issue = [r for r in mine if r in blocked or r[3] == "UNSET" or r[4] == "fax"]
        assert got[day] == (len(mine), len(issue), len(blocked))
