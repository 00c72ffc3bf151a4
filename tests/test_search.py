import itertools
import random

import pytest
from pyspark.sql import functions as F

from modelvigil.operators import search
from modelvigil.presets import SEARCH_AXES

TRIAL = "search_id string, trial_idx int, val_accuracy double"


def replay(values, patience=3, delta=0.005):
    best, stalls, out = -1.0, 0, []
    for v in values:
        if stalls >= patience:
            out.append((False, False, best, stalls))
            continue
        better = v is not None and v > best + delta
        best, stalls = (v, 0) if better else (best, stalls + 1)
        out.append((True, better, best, stalls))
    return out


def test_early_stop_equals_a_loop(spark):
    rng = random.Random(4)
    searches = {"fixed": [0.90, 0.929, 0.93, 0.92, 0.91, 0.99], "one": [0.5], "null": [None, None, 0.2, None]}
    for i in range(30):
        searches[f"s{i}"] = [round(rng.choice([0.9, 0.903, 0.906, 0.91, rng.random()]), 4) for _ in range(rng.randint(1, 27))]
    rows = [(s, i, v) for s, values in searches.items() for i, v in enumerate(values)]
    rng.shuffle(rows)
    got = {}
    for r in search.patience_stop(spark.createDataFrame(rows, TRIAL).repartition(3)).collect():
        got[(r.search_id, r.trial_idx)] = (r.executed, r.improved, r.best_so_far, r.stalls)
    want = {(s, i): out for s, values in searches.items() for i, out in enumerate(replay(values))}
    assert got == want
    assert [want[("fixed", i)][:2] for i in range(6)] == [(True, True), (True, True), (True, False), (True, False), (True, False), (False, False)]


def test_grid_order(spark):
    got = [(r["rank"], r.learning_rate, r.epochs) for r in search.grid(spark).orderBy("trial_idx").collect()]
    assert got == list(itertools.product(*SEARCH_AXES.values())) and len(got) == 27


def test_untried_cells(spark):
    trials = spark.createDataFrame([("s", i, v) for i, v in enumerate([0.9, 0.9, 0.9, 0.9, 0.99])], TRIAL)
    run = search.patience_stop(trials).where("executed")
    assert [r.trial_idx for r in search.untried(trials, run).collect()] == [4]


def test_leaderboard_and_verification(spark):
    trials = spark.createDataFrame([("s", 0, 0.8), ("s", 1, 0.9), ("s", 2, 0.9), ("q", 0, 0.4)], TRIAL)
    board = {(r.search_id, r.trial_idx): r.place for r in search.leaderboard(trials).collect()}
    assert board == {("s", 1): 1, ("s", 2): 2, ("s", 0): 3, ("q", 0): 1}
    holdout = spark.createDataFrame([("s", 1, 0.85)], "search_id string, trial_idx int, test_accuracy double")
    got = {r.search_id: r for r in search.verify_winner(trials, holdout).collect()}
    assert got["s"].trial_idx == 1 and got["s"].gap == pytest.approx(0.05) and got["q"].gap is None


def test_ablation_pools_rows(spark):
    df = spark.createDataFrame([(8, 10, 9, 0.9), (8, 30, 15, 0.5), (16, 10, 7, 0.7)], "rank int, n long, n_correct long, accuracy double")
    got = {r["rank"]: r for r in search.ablation(df, "rank").collect()}
    assert got[8].accuracy == pytest.approx(24 / 40) and got[8].best_accuracy == 0.9 and got[16].n_trials == 1


def test_trained_classifier_beats_chance_and_scores_as_a_model(spark):
    from modelvigil.operators import dataset, evaluation, scoring
    from modelvigil.sources import views

    docs = dataset.row_split(views.labelled_docs(spark, "/root/testdata/sf0.001"), train=0.6, val=0.2)
    train, rest = docs.where("split = 'train'"), docs.where("split <> 'train'")
    accuracies = {}
    for smoothing in (0.5, 1.0):
        model = search.train_classifier(train, n_features=1 << 12, smoothing=smoothing)
        scored = scoring.score_with_model(rest, model)
        assert scored.columns == [*rest.columns, "predicted", "confidence"]
        judged = evaluation.with_correct(scored)
        accuracies[smoothing] = evaluation.accuracy_summary(judged).head().accuracy
        assert judged.where(~F.col("confidence").between(0, 1)).count() == 0
    assert max(accuracies.values()) > 0.9


def test_a_search_trains_stops_and_ranks_what_ran(spark):
    words = {"a": "apple pear plum", "b": "bolt nut screw"}
    rows = [(f"{words[k]} {i}", k) for i in range(30) for k in words]
    train = spark.createDataFrame(rows, "text string, label string")
    val = spark.createDataFrame([("pear plum", "a"), ("screw", "b"), ("apple", "a"), ("unheard of", "c")], "text string, label string")
    axes = {"smoothing": (1.0, 2.0, 3.0), "n_features": (256, 512)}
    model, board = search.search_classifier(train, val, axes, patience=2)
    ran = board.orderBy("place").collect()
    assert [(r.trial_idx, r.smoothing, r.n_features, r.val_accuracy, r.place) for r in ran] == [
        (0, 1.0, 256, 0.75, 1), (1, 1.0, 512, 0.75, 2), (2, 2.0, 256, 0.75, 3)
    ]
    assert model is not None and search.search_classifier(train, val.limit(0), axes, patience=1)[0] is None


def test_ablation_pools_consistency_where_it_is_known(spark):
    rows = [(8, 10, 9, 0.9, 3, 4), (8, 30, 20, 0.67, 5, 6), (16, 10, 8, 0.8, 0, 0)]
    trials = spark.createDataFrame(rows, "rank int, n long, n_correct long, accuracy double, n_agree long, n_examples long")
    got = {r.rank: r for r in search.ablation(trials, "rank").collect()}
    assert got[8].accuracy == 29 / 40 and got[8].self_consistency == 0.8 and got[16].self_consistency is None
    assert "self_consistency" not in search.ablation(trials.drop("n_agree"), "rank").columns
