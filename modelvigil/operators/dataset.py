"""Preparation of labelled examples: dedup, caps, splits, leakage audit, noise and training arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelvigil.functions.draws import draw, draw_int, pick, shuffle_hash
from modelvigil.functions.text import replace_first
from modelvigil.operators.joins import join_group_rows
from modelvigil.operators.ranking import PREFIX_DIGITS, bucket_offsets, first_per_group, with_shuffle_position
from modelvigil.operators.vocabulary import encode_words
from modelvigil.presets import (
    BATCH_SIZE,
    IGNORED_LABEL_ID,
    MAX_TOKENS,
    NOISE_PREFIXES,
    NOISE_SUFFIXES,
    TRAIN_SHARE,
    TYPO_RATE,
    TYPO_SWAPS,
    VAL_SHARE,
)
from modelvigil.session import materialise


def dedup_ci(df: DataFrame, label: str = "label", text: str = "text", row_key: str = "ex_id") -> DataFrame:
    """Keep the first row of each text per label, ignoring case; ``row_key`` is unique and never null.

    The first row of each digest comes out of a narrow aggregation that combines copies on the map side.
    The texts themselves move once, by row key, and are never sorted.
    """
    digests = df.select(label, F.sha2(F.lower(text), 256).alias("_digest"), row_key)
    first = digests.groupBy(label, "_digest").agg(F.min(row_key).alias(row_key)).select(row_key)
    return df.join(first, row_key, "left_semi")


def cap_per_label(df: DataFrame, n: int, order: str = "ex_id", label: str = "label") -> DataFrame:
    """At most the first ``n`` rows of each label; ``order`` is unique within a label.

    The n-th key of each label is found on two columns; the full rows are then only filtered by it.
    """
    keys = first_per_group(df.select(label, order), n, order, [label])
    cuts = keys.groupBy(label).agg(F.max(order).alias("_last"))
    return join_group_rows(df, cuts, [label], order).where(F.col(order) <= F.col("_last")).drop("_last")


def _group_order(group: str, seed: int) -> Column:
    name = F.coalesce(F.col(group).cast("string"), F.lit("\x00"))
    return F.concat(shuffle_hash(name, seed), name)


def split_cuts(
    df: DataFrame, group: str, seed: int, train: float, val: float, prefix_digits: int = PREFIX_DIGITS
) -> DataFrame:
    """The last train group and the last validation group in shuffled order, as one row."""
    groups = df.select(_group_order(group, seed).alias("_order")).distinct()
    groups = groups.withColumn("_bucket", F.substring("_order", 1, prefix_digits))
    buckets = bucket_offsets(groups.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")))
    total = F.sum("_n").over(Window.partitionBy(F.lit(0)))
    n_train = F.greatest(F.lit(1), F.floor(total * F.lit(float(train))))
    n_val = F.greatest(F.lit(1), F.floor(total * F.lit(float(val))))
    wanted = buckets.withColumn("_train", n_train).withColumn("_val", F.least(total, n_train + n_val)).select(
        "_bucket", "_n", "_before",
        F.inline(F.array(
            F.struct(F.lit("train").alias("_side"), F.col("_train").alias("_place")),
            F.struct(F.lit("val").alias("_side"), F.col("_val").alias("_place")),
        )),
    )
    target = wanted.where((F.col("_before") < F.col("_place")) & (F.col("_place") <= F.col("_before") + F.col("_n")))
    # Two rows: the bucket each cut falls into. Only the groups of those buckets are ranked.
    candidates = groups.join(F.broadcast(target), "_bucket")
    inside = Window.partitionBy("_side").orderBy("_order")
    return (
        candidates.withColumn("_rank", F.row_number().over(inside))
        .where(F.col("_before") + F.col("_rank") == F.col("_place"))
        .agg(
            F.struct(
                F.max(F.when(F.col("_side") == "train", F.col("_order"))).alias("train"),
                F.max(F.when(F.col("_side") == "val", F.col("_order"))).alias("val"),
            ).alias("cuts")
        )
    )


def group_split(
    df: DataFrame, group: str = "group_id", seed: int = 42, train: float = TRAIN_SHARE, val: float = VAL_SHARE,
    exact: bool = True,
) -> DataFrame:
    """Add ``split`` so that no group is divided.

    Exact: the shuffled groups are cut at ``max(1, floor(share * groups))``; the rows compare their hash
    with the two cut points, so they are never shuffled or joined. Otherwise the hash itself is compared
    with the shares, in one pass.
    """
    if not exact:
        return _split_by_draw(df, F.coalesce(F.col(group).cast("string"), F.lit("\x00")), seed, train, val)
    cuts = split_cuts(df, group, seed, train, val)
    order = _group_order(group, seed)
    return (
        df.withColumn("_cuts", cuts.scalar())
        .withColumn(
            "split",
            F.when(order <= F.col("_cuts.train"), "train").when(order <= F.col("_cuts.val"), "val").otherwise("test"),
        )
        .drop("_cuts")
    )


def _split_by_draw(df: DataFrame, key: Column, seed: int, train: float, val: float) -> DataFrame:
    at = draw(key, seed)
    return df.withColumn("split", F.when(at < train, "train").when(at < train + val, "val").otherwise("test"))


def row_split(df: DataFrame, row_key: str = "ex_id", seed: int = 42, train: float = TRAIN_SHARE, val: float = VAL_SHARE) -> DataFrame:
    """Split row by row; kept to measure the leak that a group split removes."""
    return _split_by_draw(df, F.col(row_key), seed, train, val)


def leakage_audit(df: DataFrame, group: str = "group_id", split: str = "split") -> DataFrame:
    """Groups found on more than one side, with their sides and rows."""
    sides = df.groupBy(group, split).agg(F.count(F.lit(1)).alias("_n"))
    return (
        sides.groupBy(group)
        .agg(F.count(F.lit(1)).alias("n_sides"), F.sum("_n").alias("n_rows"))
        .where(F.col("n_sides") > 1)
    )


def augment_noise(
    df: DataFrame, text: str = "text", key: str = "ex_id", seed: int = 42,
    prefixes: Sequence[str] = NOISE_PREFIXES, suffixes: Sequence[str] = NOISE_SUFFIXES,
    swaps: Sequence[tuple[str, str]] = TYPO_SWAPS, rate: float = TYPO_RATE,
) -> DataFrame:
    """Random prefix and suffix; at ``rate`` one typo, the first applicable swap whose coin falls right."""
    k = F.col(key)
    framed = F.concat(
        pick(prefixes, k, f"{seed}:prefix:"), F.col(text), pick(suffixes, k, f"{seed}:suffix:")
    )
    framed_df = df.withColumn("_framed", framed)
    typo = F.col("_framed")
    for i, (find, replacement) in reversed(list(enumerate(swaps))):
        chosen = F.col("_framed").contains(find) & (draw_int(k, f"{seed}:swap{i}:") % 2 == 0)
        typo = F.when(chosen, replace_first(F.col("_framed"), find, replacement)).otherwise(typo)
    noisy = F.when(draw(k, f"{seed}:typo:") < rate, typo).otherwise(F.col("_framed"))
    return framed_df.withColumn("noisy_text", noisy).drop("_framed")


def resample_mix(
    df: DataFrame, weights: dict[str, float], label: str = "label", key: str = "ex_id", seed: int = 42,
    day: str | None = None, start_day: int | None = None, default_weight: float = 1.0,
) -> DataFrame:
    """Thin each label to a target mix; with ``day``, only from ``start_day`` on. A label that ``weights`` does not
    name has ``default_weight``.

    A row stays when its draw is below weight / largest weight, so no label needs a second pass.
    """
    largest = max([default_weight, *weights.values()])
    share = F.lit(default_weight / largest)
    for name, weight in weights.items():
        share = F.when(F.col(label) == name, F.lit(weight / largest)).otherwise(share)
    kept = draw(F.col(key), seed) < share
    if day is not None:
        kept = (F.col(day) < start_day) | kept
    return df.where(kept)


def split_words(text: Column) -> Column:
    """Words between blanks, the characters ``\\s`` names. One literal blank splits several times faster than a pattern."""
    for blank in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def hashed_id(word: Column, vocabulary_size: int = 32_000) -> Column:
    """Token id of a word by hashing; ids 0 and 1 are left for padding and end of text."""
    return (F.conv(F.substring(F.md5(word), 1, 7), 16, 10).cast("int") % (vocabulary_size - 2)) + 2


def token_ids(words: Column, token_id: Callable[[Column], Column]) -> Column:
    """Ids of an array of words; none of a null."""
    return F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: token_id(w))


def _windows(split: DataFrame, answer_size: Column, max_len: int) -> DataFrame:
    """A row for each window of ``_prompt`` that leaves room for the answer, its part in ``_own``."""
    split = split.withColumn("_room", F.greatest(F.lit(max_len) - answer_size, F.lit(1)))
    last = F.greatest(F.ceil(F.size("_prompt") / F.col("_room")).cast("int") - 1, F.lit(0))
    split = split.withColumn("window", F.explode(F.sequence(F.lit(0), last)))
    return split.withColumn("_own", F.slice("_prompt", F.col("window") * F.col("_room") + 1, F.col("_room")))


def _word_windows(df: DataFrame, prompt: str, label: str, words: Callable[[Column], Column], max_len: int) -> DataFrame:
    none = F.array().cast("array<string>")
    split = df.withColumns({"_prompt": F.coalesce(words(F.col(prompt)), none), "_answer": F.coalesce(words(F.col(label)), none)})
    return _windows(split, F.size("_answer") + 1, max_len)


def example_sizes(
    df: DataFrame, key: str = "ex_id", prompt: str = "prompt", label: str = "label",
    words: Callable[[Column], Column] = split_words, max_len: int = MAX_TOKENS,
) -> DataFrame:
    """``key``, ``window`` and ``n_tokens`` of the arrays that :func:`build_examples` makes, without any ids."""
    own = _word_windows(df.select(key, prompt, label), prompt, label, words, max_len)
    return own.select(key, "window", (F.size("_own") + F.size("_answer") + 1).alias("n_tokens"))


def _examples_of_vocabulary(
    df: DataFrame, prompt: str, label: str, words: Callable[[Column], Column], vocabulary: DataFrame, eos_id: int,
    max_len: int,
) -> DataFrame:
    """Windows are cut in words; each then meets the vocabulary, prompt part and answer together."""
    own = _word_windows(df, prompt, label, words, max_len)
    own = own.withColumns({"_all": F.concat("_own", "_answer"), "_masked": F.size("_own")})
    coded = encode_words(own.drop("_prompt", "_answer", "_own", "_room"), "_all", vocabulary, "_ids")
    ids = F.concat("_ids", F.array(F.lit(eos_id).cast("bigint")))
    hidden = F.array_repeat(F.lit(IGNORED_LABEL_ID).cast("bigint"), F.col("_masked"))
    answer = F.slice("input_ids", F.col("_masked") + 1, F.size("input_ids"))
    arrays = coded.withColumn("input_ids", ids).withColumn("labels", F.concat(hidden, answer))
    return arrays.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids"))).drop("_all", "_ids", "_masked")


def build_examples(
    df: DataFrame, prompt: str = "prompt", label: str = "label",
    words: Callable[[Column], Column] = split_words, token_id: Callable[[Column], Column] | DataFrame = hashed_id,
    eos_id: int = 1, max_len: int = MAX_TOKENS,
) -> DataFrame:
    """Training arrays whose loss covers the label only: prompt ids are masked in ``labels``.

    A prompt that does not fit ``max_len`` together with its answer is dealt to consecutive windows, a row each with
    its number in ``window``: every prompt token is in exactly one array, and every array ends with the whole answer,
    so each has a loss target. An answer of ``max_len`` tokens or more takes windows of one prompt token and is longer
    than ``max_len``; it is never cut. A null prompt or label counts as empty.

    ``token_id`` makes an id of a word, or is a table of a learnt vocabulary, which keeps different words apart.
    """
    if isinstance(token_id, DataFrame):
        return _examples_of_vocabulary(df, prompt, label, words, token_id, eos_id, max_len)
    split = df.withColumn("_prompt", token_ids(words(F.col(prompt)), token_id))
    answer = token_ids(words(F.col(label)), token_id)
    split = split.withColumn("_answer", F.concat(answer, F.array(F.lit(eos_id))))
    own = _windows(split, F.size("_answer"), max_len)
    arrays = own.withColumn("input_ids", F.concat("_own", "_answer")).withColumn(
        "labels", F.concat(F.array_repeat(F.lit(IGNORED_LABEL_ID), F.size("_own")), F.col("_answer"))
    )
    arrays = arrays.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
    return arrays.drop("_prompt", "_answer", "_own", "_room")


def pad_batches(
    df: DataFrame, key: str = "ex_id", seed: int = 42, batch_size: int = BATCH_SIZE, pad_id: int = 0,
    window: str = "window", sizes: DataFrame | None = None,
) -> DataFrame:
    """Shuffle rows into batches and pad each batch to its longest member; labels pad with the ignored id.

    A row is named by ``key`` and its ``window``, as :func:`build_examples` returns them. Place, batch and longest
    member are found on the name and the length alone, which are computed once: from ``sizes`` (``key``, ``window``,
    ``n_tokens``) if given, so that ``df`` is computed once too. The arrays then move once, unsorted, to be joined with them.
    """
    name = F.concat_ws(":", F.col(key).cast("string"), F.col(window).cast("string"))
    if sizes is None:
        sizes = df.select(key, window, F.size("input_ids").alias("n_tokens"))
    narrow = materialise(sizes.select(name.alias("_name"), F.col("n_tokens").alias("_size")))
    placed = with_shuffle_position(narrow, "_name", seed).withColumn("batch", F.floor(F.col("position") / batch_size))
    longest = F.max("_size").over(Window.partitionBy("batch"))
    placed = placed.select("_name", "batch", longest.alias("_longest"))
    padded = df.withColumn("_name", name).join(placed.hint("shuffle_hash"), "_name")
    padded = padded.withColumn("_missing", F.col("_longest") - F.size("input_ids"))
    for column, filler in (("input_ids", pad_id), ("labels", IGNORED_LABEL_ID), ("attention_mask", 0)):
        padded = padded.withColumn(column, F.concat(F.col(column), F.array_repeat(F.lit(filler), F.col("_missing"))))
    return padded.drop("_longest", "_missing", "_name")
