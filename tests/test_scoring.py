import pandas as pd
from pyspark.sql import functions as F

from modelvigil.functions.text import truncate
from modelvigil.operators import evaluation, quality, scoring
from modelvigil.functions.checks import check_null_text


def load():
    def score(texts: pd.Series) -> pd.DataFrame:
        if texts.isna().any() or (texts.str.len() < 5).any():
            raise ValueError("blocked row reached the scorer")
        return pd.DataFrame({"predicted": texts.str[0], "confidence": 1.0 / texts.str.len(), "latency_ms": 0.5})

    return score


def tickets(spark):
    rows = [(i, None if i % 7 == 0 else f"{'ab'[i % 2]}text number {i}", "ab"[i % 2]) for i in range(200)]
    return spark.createDataFrame(rows, "ex_id long, text string, label string").repartition(4)


def test_only_unblocked_rows_reach_the_scorer(spark):
    checked = quality.validate_records(tickets(spark), [check_null_text("text")])
    routed = quality.score_unblocked(checked, lambda df: scoring.score_in_batches(df, load, "first-letter", "1"))
    got = evaluation.with_correct(routed).collect()
    assert len(got) == 200
    assert all((r.predicted is None) == (r.ex_id % 7 == 0) for r in got)
    assert all(r.correct == 1 for r in got if r.blocked == 0)


def test_column_scorer_routes_the_same_way(spark):
    checked = quality.validate_records(tickets(spark), [check_null_text("text")])
    routed = quality.score_unblocked_columns(checked, {"predicted": F.substring("text", 1, 1)})
    assert routed.where("predicted IS NULL").count() == checked.where("blocked = 1").count() == 29


def test_preprocessing_is_seen_by_the_scorer_only(spark):
    df = spark.createDataFrame([(1, "abcdefghij")], "ex_id long, text string")
    row = scoring.score_in_batches(df, load, "cut", "1", preprocess=lambda c: truncate(c, 5)).head()
    assert row.confidence == 0.2 and row.text == "abcdefghij" and row.latency_ms == 0.5
    rule = lambda c: F.struct(c.alias("predicted"), F.lit(1.0).alias("confidence"))
    assert scoring.score_with_rule(df, rule, preprocess=lambda c: truncate(c, 3)).head().predicted == "abc"


def test_the_model_loads_once_per_worker(spark, tmp_path):
    path = str(tmp_path / "loads")

    def counted():
        with open(path, "a") as f:
            f.write("x")
        return load()

    df = tickets(spark).where("text IS NOT NULL").repartition(40)
    assert len(scoring.score_in_batches(df, counted, f"counted-{path}", "1").collect()) == 171
    with open(path) as f:
        assert 1 <= len(f.read()) <= 20


def test_another_version_under_the_same_name_is_loaded(spark):
    df = spark.createDataFrame([(i, "some text") for i in range(40)], "ex_id long, text string").repartition(4)

    def constant(answer):
        return lambda: lambda texts: pd.DataFrame({"predicted": [answer] * len(texts), "confidence": 1.0, "latency_ms": 0.0})

    for version in ("old", "new", "old"):
        scored = scoring.score_in_batches(df, constant(version), "versioned", version)
        assert {r.predicted for r in scored.collect()} == {version}
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInPandas" not in plan


def test_no_rows_are_scored_as_none(spark):
    df = spark.createDataFrame([], "ex_id long, text string")
    assert scoring.score_in_batches(df, load, "first-letter", "1").count() == 0
