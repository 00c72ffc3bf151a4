import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from modelvigil.operators import conversations, dataset, ranking, vocabulary


def encoded(spark, rows, table, **options):
    df = spark.createDataFrame(rows, "k long, words array<string>, _ids int" if len(rows[0]) == 3 else "k long, words array<string>")
    return [(r.k, r.ids) for r in vocabulary.encode_words(df, "words", table, "ids", **options).orderBy("k").collect()]


def test_vocabulary_ranks_words_and_shares_no_id(spark):
    rows = [(["b", "a", "b", None], ["c"]), (None, ["b", "ä", "a"]), ([], None)]
    df = spark.createDataFrame(rows, "x array<string>, y array<string>")
    got = sorted(map(tuple, vocabulary.learn_vocabulary(df, "x", "y").select("id", "word", "n").collect()))
    assert got == [(3, "b", 3), (4, "a", 2), (5, "c", 1), (6, "ä", 1)]
    assert vocabulary.learn_vocabulary(df.limit(0), "x").count() == 0


def test_order_positions_are_dense(spark):
    df = spark.range(5_000).select(F.col("id"), (F.col("id") * 7 % 1_000).alias("v"))
    got = ranking.with_order_position(df, [F.desc("v"), F.asc("id")]).collect()
    want = sorted(((r.v, r.id) for r in got), key=lambda p: (-p[0], p[1]))
    assert [(r.v, r.id) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(5_000))


@pytest.mark.parametrize("head", [0, 1, 4_096])
def test_words_keep_their_order(spark, head):
    table = spark.createDataFrame([("a", 9, 3), ("b", 5, 4), ("c", 1, 5)], "word string, n long, id long")
    rows = [(1, ["a", "c", "a", "b", "a"]), (2, []), (3, None), (4, ["new", None, "b"]), (5, ["a"] * 300), (6, ["a", "c", "a", "b", "a"]), (6, [""])]
    got = encoded(spark, rows, table, head=head)
    assert sorted(got, key=str) == sorted([
        (1, [3, 5, 3, 4, 3]), (2, []), (3, []), (4, [2, 2, 4]), (5, [3] * 300), (6, [3, 5, 3, 4, 3]), (6, [2]),
    ], key=str)


def test_known_words_are_looked_up_where_they_are(spark):
    table = spark.createDataFrame([("a", 9, 3), ("b", 5, 4)], "word string, n long, id long")
    df = spark.createDataFrame([(1, ["b", "a", "new"])], "k long, words array<string>")
    plan = lambda **options: vocabulary.encode_words(df, "words", table, "ids", **options)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan() and "Generate" not in plan()
    assert "ShuffledHashJoin" in plan(head=1)  # the word beyond the head is joined


@pytest.mark.parametrize("head", [0, 3, 40, 4_096])
def test_any_split_of_the_vocabulary_gives_the_same_ids(spark, head):
    rng = random.Random(5)
    known = [f"w{i}" for i in range(60)] + ["long" * 30]
    table = spark.createDataFrame([(w, 1, 3 + i) for i, w in enumerate(known)], "word string, n long, id long")
    rows = [(i, rng.choices([*known, "new", None, "", "w\x000"], k=rng.randint(0, 70))) for i in range(200)] + [(200, None)]
    rows += [(1_000 + i, words) for i, (_, words) in enumerate(rows[:50])]
    ids = {w: 3 + i for i, w in enumerate(known)}
    df = spark.createDataFrame(rows, "k long, words array<string>").repartition(7)
    got = vocabulary.encode_words(df, "words", table, "ids", head=head).collect()
    assert {r.k: r.ids for r in got} == {k: [ids.get(w, 2) for w in words or []] for k, words in rows}
    assert len(got) == len(rows)


def test_examples_of_a_vocabulary_equal_those_of_its_function(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{i % 7}" for i in range(40)), "yes no"), (2, None, "yes"), (3, "w1", None), (4, "", "")], "ex_id long, prompt string, label string")
    words = [f"w{i}" for i in range(7)] + ["yes", "no"]
    table = spark.createDataFrame([(w, 1, 3 + i) for i, w in enumerate(words)], "word string, n long, id long")
    ids = F.create_map(*[F.lit(x) for i, w in enumerate(words) for x in (w, 3 + i)])
    shown = lambda arrays: sorted(map(str, arrays.select("ex_id", "window", "input_ids", "labels", "attention_mask").collect()))
    want = dataset.build_examples(df, token_id=lambda w: ids[w], max_len=10)
    assert shown(dataset.build_examples(df, token_id=table, max_len=10)) == shown(want)


def plain_windows(turns, size, learnt):
    said = {}
    for conv, turn, role, text in turns:
        if conv is not None and turn is not None:
            said.setdefault((conv, turn), []).append((role or "user", text or ""))
    words = {}
    for (conv, turn), ways in sorted(said.items()):
        role, text = min(ways)
        own = [f"<|im_start|>{role}", *text.split(), "<|im_end|>"]
        words.setdefault(conv, []).extend((turn, w, int(i > 0 and role in learnt)) for i, w in enumerate(own))
    out = []
    for conv, all_words in words.items():
        for a in range(0, len(all_words), size):
            part = all_words[a : a + size]
            out.append((conv, a // size, len({t for t, _, _ in part}), [w for _, w, _ in part], [m for _, _, m in part]))
    return sorted(out)


def test_windows_of_odd_conversations(spark):
    long = " ".join(f"t{i}" for i in range(100))
    turns = [
        (1, 0, "system", "be kind"), (1, 2, "assistant", long), (1, 1, "user", None), (1, 1, "user", None), (1, 3, None, "more"),
        (1, 700, "assistant", "much later"), (1, -5, "user", "before all"), (2, 4, "assistant", "b"), (2, 4, "assistant", "a"),
        (2, 4, "user", "0"), (None, 1, "user", "lost"), (3, None, "user", "lost"), (4, 0, "assistant", ""), (5, 2**40, "user", "x"),
        *[(9, t, ("user", "assistant")[t % 2], f"say {t}") for t in range(600)],
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("_n", F.lit(1)).withColumn("window", F.lit(2))
    got = conversations.chat_windows(df, max_len=16)
    rows = sorted((r.conv_id, r.window, r.n_turns, r.words, r["mask"]) for r in got.collect())
    assert rows == plain_windows(turns, 16, ("assistant",))
    assert max(len(r[3]) for r in rows) == 16
    assert conversations.chat_windows(df.limit(0)).count() == 0


def test_labels_follow_the_mask(spark):
    turns = [(1, 0, "user", "how are you"), (1, 1, "assistant", "fine how are you")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    [row] = conversations.chat_examples(df).collect()
    assert len(row.input_ids) == 11 and row.labels == [-100] * 6 + row.input_ids[6:]
    assert Counter(row.input_ids)[row.input_ids[1]] == 2 and len(set(row.input_ids)) == 7
