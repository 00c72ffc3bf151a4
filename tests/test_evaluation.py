import random

import pytest
from pyspark.sql import functions as F

from modelvigil.functions.text import truncate
from modelvigil.operators import evaluation, joins, ranking, skew

SCHEMA = "model string, ex_id long, label string, predicted string, confidence double, latency_s double, output_tokens int"
VOCABULARY = ["a", "b", "c", "never"]


def judged(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # one model holds most rows
        model = "big" if rng.random() < 0.8 else "small"
        rows.append((model, i, rng.choice("abc"), rng.choice(["a", "b", "c", "INVALID"]), rng.random(), rng.choice([0.1, 0.2, rng.random()]), rng.randint(1, 5)))
    return rows, evaluation.with_correct(spark.createDataFrame(rows, SCHEMA))


def by_index(values, share):
    ordered = sorted(values)
    return ordered[min(int(len(ordered) * share), len(ordered) - 1)]


@pytest.mark.parametrize("n", [1, 2, 4, 20, 100])
def test_percentile_index(spark, n):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(n)], "ex_id long, v double").repartition(3)
    got = {r.share: r.value for r in ranking.index_percentiles(df, "v", [0.0, 0.5, 0.95, 1.0]).collect()}
    assert got == {p: by_index([float(i * i) for i in range(n)], p) for p in (0.0, 0.5, 0.95, 1.0)}


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_percentiles_of_a_hot_group_with_coarse_sketch(spark, broadcast_rows):
    rng = random.Random(5)
    rows = [("hot" if i % 3 else None if i % 2 else "k", i, rng.choice([1.0, 2.0, rng.gauss(5, 2)])) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, ex_id long, v double").repartition(6)
    got = ranking.index_percentiles(df, "v", [0.5, 0.95, 0.01], ["g"], accuracy=50, broadcast_rows=broadcast_rows)
    want = {(g, p): by_index([r[2] for r in rows if r[0] == g], p) for g in ("hot", None, "k") for p in (0.5, 0.95, 0.01)}
    assert {(r.g, r.share): r.value for r in got.collect()} == want


def test_percentiles_ignore_null_and_take_constants(spark):
    df = spark.createDataFrame([(i, 3.0 if i % 2 else None) for i in range(50)], "ex_id long, v double")
    assert [r.value for r in ranking.index_percentiles(df, "v", [0.5, 0.95]).collect()] == [3.0, 3.0]
    assert ranking.index_percentiles(df.where("v > 5"), "v", [0.5]).count() == 0


def test_salted_join_equals_broadcast_join(spark):
    rows, df = judged(spark)
    groups = df.groupBy("model").agg(F.max("ex_id").alias("top"))
    a = joins.join_group_rows(df, groups, ["model"], "ex_id", broadcast_rows=0, salts=4)
    b = joins.join_group_rows(df, groups, ["model"], "ex_id")
    assert "_g_salt" in a._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() == len(rows)


def test_summary_and_categories(spark):
    rows, df = judged(spark)
    for model in ("big", "small"):
        mine = [r for r in rows if r[0] == model]
        s = evaluation.accuracy_summary(df, ["model"]).where(F.col("model") == model).head()
        hits = sum(r[2] == r[3] for r in mine)
        assert (s.n, s.n_correct) == (len(mine), hits)
        assert s.accuracy == pytest.approx(hits / len(mine))
        assert s.invalid_rate == pytest.approx(sum(r[3] == "INVALID" for r in mine) / len(mine))
        assert s.avg_output_tokens == pytest.approx(sum(r[6] for r in mine) / len(mine))
        per = {r.label: r for r in evaluation.per_category(df, VOCABULARY, ["model"]).where(F.col("model") == model).collect()}
        for v in VOCABULARY:
            of = [r for r in mine if r[2] == v]
            assert per[v].n == len(of)
            assert per[v].accuracy == pytest.approx(sum(r[2] == r[3] for r in of) / len(of) if of else 0.0)


def test_null_prediction_is_wrong_not_unknown(spark):
    df = evaluation.with_correct(spark.createDataFrame([(1, "a", None), (2, "a", "a")], "ex_id long, label string, predicted string"))
    assert evaluation.accuracy_summary(df).head().accuracy == 0.5


def test_confusion_ties_go_by_first_appearance(spark):
    cells = [("a", "b"), ("c", "a"), ("a", "b"), ("c", "a"), ("b", "a"), ("a", "a")]
    df = spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(cells)], "ex_id long, label string, predicted string")
    got = evaluation.top_confusions(df, 2).orderBy("place").collect()
    assert [(r.label, r.predicted, r.n) for r in got] == [("a", "b", 2), ("c", "a", 2)]
    assert {(r.label, r.predicted): r.n for r in evaluation.confusion(df).collect()}[("a", "a")] == 1


def test_self_consistency(spark):
    runs = [(1, "a")] * 5 + [(2, "a")] * 4 + [(2, "b")] + [(3, None)] * 5 + [(4, "a")] * 4 + [(4, None)]
    df = spark.createDataFrame(runs, "ex_id long, predicted string")
    got = evaluation.self_consistency(df).head()
    assert (got.n_examples, got.n_agree, got.self_consistency) == (4, 2, 0.5)
    assert evaluation.self_consistency(df, first_n=1).head().self_consistency == 1.0


def test_compare_models(spark):
    rows, df = judged(spark)
    table = {r.metric: r for r in evaluation.compare_models(df, "big", "small").collect()}
    for name, share in (("p50", 0.5), ("p95", 0.95)):
        base, tuned = (by_index([r[5] for r in rows if r[0] == m], share) for m in ("big", "small"))
        assert (table[name].base, table[name].tuned) == (base, tuned)
        assert table[name].delta == pytest.approx(tuned - base)
    assert set(table) == {"accuracy", "invalid_rate", "avg_output_tokens", "p50", "p95"}


def test_errors(spark):
    rows, df = judged(spark)
    wrong = [r for r in rows if r[2] != r[3]]
    worst = evaluation.worst_errors(df, 5).orderBy("place").collect()
    assert [r.ex_id for r in worst] == [r[1] for r in sorted(wrong, key=lambda r: (-r[4], r[1]))[:5]]
    many = evaluation.worst_errors(df, 2000, ["model"])
    assert many.count() == len(wrong)
    groups = evaluation.error_groups(df).collect()
    assert sum(g.n for g in groups) == len(wrong) and sum(g.share for g in groups) == pytest.approx(1)


def test_first_per_group_beyond_the_map_side_limit(spark):
    df = spark.range(10_000).select("id", (F.col("id") % 3 == 0).cast("int").alias("g"))
    got = ranking.first_per_group(df, 2500, "id", ["g"])
    want = {g: [i for i in range(10_000) if (i % 3 == 0) == bool(g)][:2500] for g in (0, 1)}
    assert {g: sorted(r.id for r in got.where(F.col("g") == g).collect()) for g in (0, 1)} == want


def counts(df):
    return [r.n for r in evaluation.histogram(df, "v").orderBy("bin").collect()]


def test_histogram_bins(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "v double")
    rows = evaluation.histogram(df, "v").orderBy("bin").collect()
    assert [r.n for r in rows] == [2] + [1] * 9
    assert rows[0].lower == pytest.approx(-0.01) and rows[-1].upper == 10.0
    assert counts(spark.createDataFrame([(0.0,), (10.0,)], "v double")) == [1] + [0] * 8 + [1]
    assert sum(counts(spark.createDataFrame([(5.0,), (5.0,)], "v double"))) == 2
    assert counts(spark.createDataFrame([], "v double")) == []


def test_prediction_counts_descending(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "predicted string")
    assert [tuple(r) for r in evaluation.prediction_counts(df).collect()] == [("b", 2), ("a", 1), ("c", 1)]


def test_skew_gap_by_length(spark):
    docs = spark.createDataFrame(
        [(1, "aaaa key", "x"), (2, "key aaaa", "x"), (3, "nothing here", "y"), (4, "aa key", "x")], "ex_id long, text string, label string"
    )

    def rule(text):
        hit = F.instr(text, "key") > 0
        return F.struct(F.when(hit, "x").otherwise("y").alias("predicted"), F.when(hit, 0.9).otherwise(0.7).alias("confidence"))

    scored = skew.score_paths(docs, rule, [8, 6, 4])
    assert scored.count() == 16
    got = {r.max_chars: r for r in skew.skew_sweep(scored, [8, 6, 4]).collect()}
    assert [got[n].serving_accuracy for n in (8, 6, 4)] == [1.0, 0.75, 0.5]
    assert got[8].gap == 0 and not got[8].flagged and got[4].flagged
    table = {(r.label, r.max_chars): r for r in skew.skew_by_category(scored).collect()}
    assert table[("x", 4)].confidence_wrong == pytest.approx(0.7)
    assert table[("x", 4)].gap == pytest.approx(2 / 3) and table[("y", 4)].confidence_wrong is None
    assert docs.select(truncate(F.col("text"), 4).alias("t")).head().t == "aaaa"
