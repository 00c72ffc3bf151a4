import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from modelvigil.functions.checks import check_null_text, check_reference
from modelvigil.operators import bayes, quality, sketches

ROWS = [
    (1, "a", "red red blue"), (2, "a", "red green"), (3, "b", "sky blue blue"), (4, "b", "sea"), (5, None, "red"), (6, "b", None),
    (7, "a", ""), (8, "c", "once"),
]
ASKED = [(11, "a", "red red sky"), (12, "b", "blue sea"), (13, "c", "nothing known"), (14, "b", None), (15, None, "once red")]


def plain(train, asked, alpha, min_docs, presence):
    labels = sorted({label for _, label, _ in train if label})
    priors = Counter(label for _, label, _ in train if label)
    n, d, docs = defaultdict(Counter), defaultdict(Counter), Counter()
    for _, label, text in train:
        if label:
            for word, tf in Counter((text or "").split()).items():
                n[label][word] += tf
                d[label][word] += 1
                docs[word] += 1
    words = [w for w in docs if docs[w] >= min_docs]
    counts = d if presence else n
    out = {}
    for key, _, text in asked:
        scores = []
        for label in labels:
            total = sum(counts[label][w] for w in words) + alpha * len(words)
            score = round(math.log(priors[label] / sum(priors.values())) * 1e6)
            for word, tf in Counter((text or "").split()).items():
                if word in words:
                    score += round(math.log((counts[label][word] + alpha) / total) * 1e6) * (1 if presence else tf)
            scores.append(score)
        out[key] = (labels[scores.index(max(scores))], scores)
    return out


@pytest.mark.parametrize("head", [0, 2, 1 << 16])
def test_words_in_and_beyond_the_broadcast_part_score_alike(spark, head):
    schema = "id long, label string, text string"
    rng = random.Random(3)
    said = lambda: " ".join(rng.choices(["red", "blue", "sea", "sky", "x" * 90, "new"], k=rng.randint(0, 30)))
    taught = [(i, rng.choice("abc"), said().replace("new", "red")) for i in range(40)]
    questions = [(100 + i, rng.choice("abc"), said()) for i in range(60)] + [(None, "a", "red sea")]
    train, asked = (spark.createDataFrame(rows, schema) for rows in (taught, questions))
    stats = bayes.statistics(train, bayes.word_features(train, "id", keep=["label"]))
    grid = bayes.cells()
    scored = bayes.posteriors(asked, bayes.word_features(asked, "id").repartition(5), stats, grid, "id", head=head)
    rows = {r.id: r for r in scored.collect()}
    for j, cell in enumerate(grid):
        want = plain(taught, [q for q in questions if q[0]], **cell)
        assert {i: r.scores[j] for i, r in rows.items() if i} == {i: s for i, (_, s) in want.items()}, cell
    plan = scored._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("MapInArrow") == 1  # 48 sums a pair of text and word are no generated code


def test_all_cells_equal_their_own_fit(spark):
    schema = "id long, label string, text string"
    train, asked = spark.createDataFrame(ROWS, schema), spark.createDataFrame(ASKED, schema)
    stats = bayes.statistics(train, bayes.word_features(train, "id", keep=["label"]))
    assert stats.labels == ["a", "b", "c"] and stats.priors == [3, 3, 1]
    grid = bayes.cells()
    scored = bayes.posteriors(asked, bayes.word_features(asked, "id"), stats, grid, "id")
    rows = {r.id: r for r in scored.collect()}
    assert len(rows) == len(ASKED)
    for j, cell in enumerate(grid):
        want = plain(ROWS, ASKED, **cell)
        assert {i: r.scores[j] for i, r in rows.items()} == {i: s for i, (_, s) in want.items()}, cell
    board = bayes.select_cell(scored, stats, grid).collect()
    assert sorted(r.trial_idx for r in board) == list(range(12)) and all(r.n_val == 5 for r in board)
    for r in board:
        want = plain(ROWS, ASKED, r.alpha, r.min_docs, r.presence)
        assert r.n_correct == sum(want[i][0] == label for i, label, _ in ASKED)
    assert [r.trial_idx for r in sorted(board, key=lambda r: r.place)] == [
        r.trial_idx for r in sorted(board, key=lambda r: (-r.n_correct, r.trial_idx))
    ]


def test_sketched_quantiles_are_inside_their_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 12).cast("int").alias("day"), (F.hash("id") % 10_000).cast("double").alias("v"), F.lit("k").alias("key"))
    df = df.union(spark.createDataFrame([(3, None, "k"), (3, float("nan"), "k"), (None, 1.0, "k"), (20, 7.0, "other")], "day int, v double, key string"))
    daily = sketches.daily_sketches(df, "v", by=["key"])
    assert daily.count() == 13
    rows = {(r.key, r.day): r for r in sketches.rolling_quantiles(daily, by=["key"]).collect()}
    assert len(rows) == 13 and rows["other", 20].p50 == 7.0
    values = defaultdict(list)
    for r in df.where("key = 'k' AND day IS NOT NULL AND v IS NOT NULL AND NOT isnan(v)").collect():
        values[r.day].append(r.v)
    for day in range(12):
        own = sorted(v for d in range(max(0, day - 6), day + 1) for v in values[d])
        found = rows["k", day]
        assert found.n_in_window == len(own)
        for value, share in ((found.p50, 0.5), (found.p95, 0.95)):
            assert abs(sum(v <= value for v in own) / len(own) - share) <= 2 * sketches.rank_error() + 1e-3


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 1}, {"broadcast_bytes": 2}])
def test_values_that_a_reference_table_lacks(spark, limits):
    rows = [(1, "x", "some text"), (2, "zz", None), (3, None, "some text"), (4, "y", "t"), (5, "zz", "some text"), (6, "", "some text")]
    df = spark.createDataFrame(rows, "id long, source string, body string")
    table = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "name string")
    held = quality.with_reference(df, "source", table, "name", "known", **limits)
    got = quality.validate_records(held, [check_null_text("body"), check_reference("source", "known")])
    assert {r.id: r.issue_types for r in got.collect()} == {
        1: "", 2: "null_or_empty_text,unknown_reference_value", 3: "", 4: "null_or_empty_text", 5: "unknown_reference_value",
        6: "unknown_reference_value",
    }
    assert got.count() == 6
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert limits or "BroadcastHashJoin" in plan
    none = quality.with_reference(df, "source", table.limit(0), "name", "known", **limits)
    assert none.where("known").count() == 0 and none.count() == 6


def test_a_restarted_stream_sees_the_changed_table(spark, tmp_path):
    schema = "id long, source string"
    got = {}
    for turn, (rows, names) in enumerate([([(1, "x"), (2, "new")], ["x"]), ([(3, "new"), (4, "old")], ["x", "new"])]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        table = spark.createDataFrame([(n,) for n in names], "name string")
        stream = quality.with_reference(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "source", table, "name", "known")
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ckpt").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination()
    got = {r.id: r.known for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: True, 2: False, 3: True, 4: False}
