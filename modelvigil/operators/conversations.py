"""Conversations of any number of turns as training arrays with a loss mask for each turn."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelvigil.operators.dataset import IGNORED_LABEL_ID, MAX_TOKENS, split_words
from modelvigil.operators.vocabulary import encode_words, learn_vocabulary

#: Consecutive turn numbers summed in one group.
BLOCK_TURNS = 256
START, END = "<|im_start|>", "<|im_end|>"


def ordered_turns(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row a conversation and turn: ``conversation``, ``turn``, ``role``, ``text``.

    A turn that comes several times is said once: the smallest by role, then text. A null role is a user's, a null
    text empty. Rows without a conversation or a turn have no place and are left out.
    """
    said = F.struct(F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = turns.where(F.col(conversation).isNotNull() & F.col(turn).isNotNull())
    once = placed.groupBy(conversation, turn).agg(F.min(said).alias("_said"))
    return once.select(conversation, turn, "_said.role", "_said.text")


def turn_words(role: Column, text: Column) -> Column:
    """Words of a turn: one that opens it with its role, those of the text, and one that closes it."""
    opening = F.concat(F.lit(START), F.regexp_replace(role, r"\s+", "_"))
    return F.concat(F.array(opening), split_words(text), F.array(F.lit(END)))


def chat_windows(
    turns: DataFrame, learnt: Sequence[str] = ("assistant",), max_len: int = MAX_TOKENS,
    conversation: str = "conv_id", turn: str = "turn",
) -> DataFrame:
    """Conversations laid out in order and cut into windows of ``max_len`` words: ``conversation``, ``window``,
    ``n_turns``, ``words`` and ``mask`` (1 where the loss counts).

    Each word of each turn is in exactly one window, whatever the number and length of turns. The loss covers text
    and closing word of turns by a role of ``learnt``. Where a turn begins is a sum over the turns before it: inside
    blocks of ``BLOCK_TURNS`` turn numbers, and over the totals of the blocks, so the turns of a very long
    conversation never meet in one task.
    """
    rows = ordered_turns(turns, conversation, turn)
    rows = rows.withColumn("_words", turn_words(F.col("role"), F.col("text"))).withColumn("_n", F.size("_words").cast("long"))
    rows = rows.withColumn("_block", F.floor(F.col(turn) / BLOCK_TURNS))
    inside = Window.partitionBy(conversation, "_block").orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(conversation).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(conversation, "_block").agg(F.sum("_n").alias("_total"))
    totals = totals.select(conversation, "_block", F.coalesce(F.sum("_total").over(over), F.lit(0)).alias("_before"))
    rows = rows.withColumn("_start", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    rows = rows.join(totals, [conversation, "_block"]).withColumn("_start", F.col("_start") + F.col("_before"))
    counts = F.col("role").isin(*learnt).cast("int")
    rows = rows.withColumn("_mask", F.concat(F.array(F.lit(0)), F.array_repeat(counts, (F.col("_n") - 1).cast("int"))))
    first, last = (F.floor(p / max_len) for p in (F.col("_start"), F.col("_start") + F.col("_n") - 1))
    pieces = rows.withColumn("window", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("window") * max_len - F.col("_start"), F.lit(0))
    end = F.least((F.col("window") + 1) * max_len - F.col("_start"), F.col("_n"))
    cut = lambda name: F.slice(name, (begin + 1).cast("int"), (end - begin).cast("int"))
    pieces = pieces.select(
        conversation, "window", F.struct((F.col("_start") + begin).alias("at"), cut("_words").alias("words"), cut("_mask").alias("mask")).alias("_piece")
    )
    # A window holds at most ``max_len`` words, and every piece at least one.
    windows = pieces.groupBy(conversation, "window").agg(F.array_sort(F.collect_list("_piece")).alias("_pieces"))
    return windows.select(
        conversation, F.col("window").cast("int").alias("window"), F.size("_pieces").alias("n_turns"),
        F.flatten(F.transform("_pieces", lambda p: p["words"])).alias("words"),
        F.flatten(F.transform("_pieces", lambda p: p["mask"])).alias("mask"),
    )


def chat_examples(
    turns: DataFrame, vocabulary: DataFrame | None = None, learnt: Sequence[str] = ("assistant",),
    max_len: int = MAX_TOKENS, conversation: str = "conv_id", turn: str = "turn",
) -> DataFrame:
    """Training arrays of conversations: ``input_ids``, and ``labels`` that hold the id where the loss counts.

    Without a vocabulary that of the conversations' own words is learnt.
    """
    windows = chat_windows(turns, learnt, max_len, conversation, turn)
    vocabulary = learn_vocabulary(windows, "words") if vocabulary is None else vocabulary
    coded = encode_words(windows, "words", vocabulary, "input_ids")
    labels = F.zip_with("input_ids", "mask", lambda i, m: F.when(m == 1, i).otherwise(F.lit(IGNORED_LABEL_ID)))
    return coded.withColumn("labels", labels).drop("words", "mask")
