import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modelvigil.operators import dataset, quality, ranking
from modelvigil.presets import NOISE_PREFIXES, NOISE_SUFFIXES, TYPO_SWAPS


def examples(spark, rows):
    return spark.createDataFrame(rows, "ex_id long, text string, label string, group_id string")


def some(spark, n=300, seed=2):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["Same text", "same TEXT", f"text {rng.randint(0, 60)}", "ÄÖ", "äö"]), rng.choice("ab"), f"g{rng.randint(0, 12)}") for i in range(n)]
    return rows, examples(spark, rows).repartition(5)


def test_dedup_keeps_the_first_of_each_label(spark):
    rows, df = some(spark)
    first = {}
    for r in rows:
        first.setdefault((r[2], r[1].lower()), r)
    got = dataset.dedup_ci(df)
    assert sorted(map(tuple, got.select("ex_id", "text", "label", "group_id").collect())) == sorted(first.values())


def test_dedup_of_one_hot_text_ranks_no_group(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("ex_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("text"), F.lit("l").alias("label")
    )
    got = dataset.dedup_ci(df)
    assert got.count() == 6667 + 1
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [7, 90, 1500])
def test_cap_per_label(spark, n):
    df = spark.range(4000).select(F.col("id").alias("ex_id"), F.when(F.col("id") % 4 == 0, "rare").otherwise("hot").alias("label"))
    got = dataset.cap_per_label(df, n).collect()
    for label, ids in (("rare", range(0, 4000, 4)), ("hot", [i for i in range(4000) if i % 4])):
        assert sorted(r.ex_id for r in got if r.label == label) == list(ids)[:n]


def split_by_definition(groups, train=0.7, val=0.15, seed=42):
    order = sorted(groups, key=lambda g: hashlib.md5(f"{seed}{g}".encode()).hexdigest())
    n = len(order)
    n_train, n_val = max(1, int(n * train)), max(1, int(n * val))
    return {g: "train" if i < n_train else "val" if i < n_train + n_val else "test" for i, g in enumerate(order)}


@pytest.mark.parametrize("n_groups", [1, 2, 3, 7, 20, 101])
def test_group_split_sizes(spark, n_groups):
    df = examples(spark, [(i, "t", "a", f"g{i % n_groups}") for i in range(n_groups * 3)])
    got = {r.group_id: r.split for r in dataset.group_split(df).select("group_id", "split").distinct().collect()}
    assert got == split_by_definition({f"g{i}" for i in range(n_groups)})


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abcdé ", max_size=3)), min_size=1, max_size=30), st.booleans())
def test_group_split_covers_all_and_leaks_nothing(spark, groups, exact):
    df = examples(spark, [(i, "t", "a", g) for i, g in enumerate(groups)])
    split = dataset.group_split(df, exact=exact)
    assert split.count() == len(groups) and split.where("split IS NULL").count() == 0
    assert dataset.leakage_audit(split).count() == 0


def test_group_split_moves_no_rows(spark):
    _, df = some(spark)
    plan = dataset.group_split(df.coalesce(1).select("ex_id", "text", "group_id"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_row_split_leaks(spark):
    df = examples(spark, [(i, "t", "a", f"g{i % 5}") for i in range(500)])
    split = dataset.row_split(df)
    audit = {r.group_id: (r.n_sides, r.n_rows) for r in dataset.leakage_audit(split).collect()}
    assert audit == {f"g{i}": (3, 100) for i in range(5)}


def test_shuffle_position_is_the_rank_of_the_hash(spark):
    df = spark.range(3000).withColumnRenamed("id", "ex_id").repartition(6)
    got = {r.ex_id: r.position for r in ranking.with_shuffle_position(df, "ex_id", 7, prefix_digits=2).collect()}
    order = sorted(range(3000), key=lambda i: hashlib.md5(f"7{i}".encode()).hexdigest())
    assert got == {i: p for p, i in enumerate(order)}
    assert [r.ex_id for r in ranking.hash_shuffle(df, "ex_id", 7).collect()] == order


def test_noise_frames_the_text_and_swaps_once(spark):
    df = spark.range(4000).select(F.col("id").alias("ex_id"), F.lit("the password issue, the connect issue").alias("text"))
    seen = dataset.augment_noise(df).collect()
    plain = swapped = 0
    starts = set()
    for r in seen:
        frames = [p for p in NOISE_PREFIXES if r.noisy_text.startswith(p) and any(r.noisy_text.endswith(s) for s in NOISE_SUFFIXES)]
        assert frames
        starts.add(max(frames, key=len))
        core = r.text
        if core in r.noisy_text:
            plain += 1
        else:
            swapped += 1
            options = [core.replace(a, b, 1) for a, b in TYPO_SWAPS]
            in_frame = [p for p in NOISE_SUFFIXES for a, b in TYPO_SWAPS if a in p]
            assert any(o in r.noisy_text for o in options) or in_frame
    assert starts == set(NOISE_PREFIXES)
    assert 0.07 < swapped / 4000 < 0.13
    assert sorted(map(tuple, seen)) == sorted(map(tuple, dataset.augment_noise(df.repartition(9)).collect()))


def test_resampling_to_a_mix(spark):
    df = spark.range(30_000).select(
        F.col("id").alias("ex_id"), F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int")).alias("label"), (F.col("id") % 10).cast("int").alias("day")
    )
    kept = dataset.resample_mix(df, {"a": 4.0, "b": 1.0, "c": 4.0})
    n = {r.label: r["count"] for r in kept.groupBy("label").count().collect()}
    assert n["a"] == n["c"] == 10_000 and abs(n["b"] - 2500) < 200
    unlisted = dataset.resample_mix(df, {"a": 4.0, "c": 4.0})
    assert sorted(map(tuple, unlisted.collect())) == sorted(map(tuple, kept.collect()))
    assert dataset.resample_mix(df, {"a": 4.0}, default_weight=0.0).select("label").distinct().count() == 1
    late = dataset.resample_mix(df, {"a": 4.0, "b": 1.0, "c": 4.0}, day="day", start_day=5)
    assert late.where("day < 5").count() == 15_000 and late.where("day >= 5 and label = 'b'").count() < 1500


def test_masked_arrays(spark):
    df = spark.createDataFrame([(1, "one two  three", "la bel"), (2, "", "x"), (3, "w " * 40, "x")], "ex_id long, prompt string, label string")
    rows = dataset.build_examples(df, max_len=20).collect()
    got = {r.ex_id: r for r in rows}
    one = got[1]
    assert len(one.input_ids) == 3 + 2 + 1 and one.labels == [-100] * 3 + one.input_ids[3:]
    assert one.input_ids[-1] == 1 and min(one.input_ids[:-1]) >= 2 and one.attention_mask == [1] * 6
    assert got[2].labels == got[2].input_ids and len(got[2].input_ids) == 2
    windows = sorted((r.window, r.input_ids, r.labels) for r in rows if r.ex_id == 3)
    word, answer = windows[0][1][0], got[2].input_ids
    assert [w for w, _, _ in windows] == [0, 1, 2]
    assert [ids for _, ids, _ in windows] == [[word] * 18 + answer, [word] * 18 + answer, [word] * 4 + answer]
    assert [labels for _, _, labels in windows] == [[-100] * 18 + answer, [-100] * 18 + answer, [-100] * 4 + answer]


def test_every_prompt_token_is_in_one_window_and_answers_are_whole(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(n)), " ".join(f"a{j}" for j in range(m))) for i, (n, m) in enumerate(
        [(0, 0), (1, 30), (3, 19), (97, 2), (98, 5), (10, 9), (11, 9), (12, 9)]
    )] + [(90, None, "x"), (91, "w", None)]
    df = spark.createDataFrame(rows, "ex_id long, prompt string, label string")
    whole = {r.ex_id: r for r in dataset.build_examples(df, max_len=10_000).collect()}
    parts = {}
    for r in dataset.build_examples(df, max_len=20).collect():
        parts.setdefault(r.ex_id, []).append(r)
    for ex_id, own in parts.items():
        answer = [t for t in whole[ex_id].labels if t != -100]
        assert all([t for t in r.labels if t != -100] == answer and r.input_ids[-1] == 1 for r in own)
        prompt = [t for r in sorted(own, key=lambda r: r.window) for t in r.input_ids[: -len(answer)]]
        assert prompt == whole[ex_id].input_ids[: -len(answer)]
        assert all(len(r.input_ids) <= 20 or len(answer) >= 20 for r in own)
    assert set(parts) == set(whole) == {r[0] for r in rows}


def test_padding_to_the_longest_of_each_batch(spark):
    df = spark.range(21).select(F.col("id").alias("ex_id"), F.repeat(F.lit("w "), (F.col("id") % 6 + 1).cast("int")).alias("prompt"), F.lit("l").alias("label"))
    arrays = dataset.build_examples(df)
    padded = dataset.pad_batches(arrays, batch_size=8).collect()
    before = {r.ex_id: r for r in arrays.collect()}
    sizes = {}
    for r in padded:
        sizes.setdefault(r.batch, []).append(r)
    assert sorted(len(b) for b in sizes.values()) == [5, 8, 8]
    for batch in sizes.values():
        longest = max(len(before[r.ex_id].input_ids) for r in batch)
        for r in batch:
            raw, n = before[r.ex_id], longest - len(before[r.ex_id].input_ids)
            assert r.input_ids == raw.input_ids + [0] * n
            assert r.labels == raw.labels + [-100] * n and r.attention_mask == raw.attention_mask + [0] * n


def test_sizes_are_known_without_ids_and_arrays_are_made_once(spark):
    prompts = [(i, " ".join(f"w{j}" for j in range(n)), " ".join(f"a{j}" for j in range(m))) for i, (n, m) in enumerate(
        [(0, 0), (1, 30), (3, 19), (97, 2), (98, 5), (40, 9)]
    )] + [(90, None, "x"), (91, "w", None)]
    df = spark.createDataFrame(prompts, "ex_id long, prompt string, label string")
    table = spark.createDataFrame([(f"w{j}", 1, 3 + j) for j in range(98)], "word string, n long, id long")
    arrays = dataset.build_examples(df, token_id=table, max_len=20)
    sizes = dataset.example_sizes(df, max_len=20)
    assert sorted(map(tuple, sizes.collect())) == sorted((r.ex_id, r.window, len(r.input_ids)) for r in arrays.collect())
    padded = dataset.pad_batches(arrays, sizes=sizes, batch_size=3)
    assert sorted(map(str, padded.collect())) == sorted(map(str, dataset.pad_batches(arrays, batch_size=3).collect()))
    plan = padded._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ArrowEvalPython") == 1 and "SortMergeJoin" not in plan


def test_words_are_split_at_all_blanks(spark):
    texts = ["", " ", "a\t\nb\x0bc\fd\re  f ", "no\u00a0blank\x1cno\x85blank", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.w for r in df.select("i", dataset.split_words(F.col("t")).alias("w")).collect()}
    assert got == {0: [], 1: [], 2: list("abcdef"), 3: [texts[3]], 4: None}


def test_gate(spark):
    rows = [(1, "long enough", "a"), (2, None, None), (3, "  ab ", "b"), (4, "long enough", "zzz")]
    df = spark.createDataFrame(rows, "ex_id long, text string, label string")
    got = sorted((r.ex_id, r.problem) for r in quality.gate_problems(df, ["a", "b"]).collect())
    assert got == [(2, "invalid_label"), (2, "short_text"), (3, "short_text"), (4, "invalid_label")]
    with pytest.raises(quality.DatasetRejected, match="4 problem"):
        quality.assert_clean(df, ["a", "b"], "ex_id")
    assert quality.assert_clean(df.where("ex_id = 1"), ["a", "b"], "ex_id") is None
    both = {"train": df.where("ex_id = 1"), "val": df.where("ex_id = 4")}
    with pytest.raises(quality.DatasetRejected, match="1 problem.*val 4: invalid_label"):
        quality.assert_clean(both, ["a", "b"], "ex_id")
    assert [(r.split, r.ex_id) for r in quality.gate_splits(both, ["a", "b"]).collect()] == [("val", 4)]
