"""A grid of naive Bayes text classifiers fitted together from one table of word counts."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from modelvigil.operators.dataset import split_words
from modelvigil.operators.search import leaderboard
from modelvigil.session import materialise, stored

AXES = {"alpha": (0.1, 1.0, 10.0), "min_docs": (1, 3), "presence": (False, True)}
#: The most frequent words, which are broadcast, and the longest word among them.
HEAD, HEAD_CHARS = 1 << 16, 64
#: Log probabilities are whole millionths, so their sums are the same in any order.
MICRO = 1_000_000


def word_features(df: DataFrame, key: str, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``key``, the columns of ``keep``, ``word`` and ``tf``: how often each word is in each text. Computed once."""
    words = df.select(key, *keep, F.explode(split_words(F.col(text))).alias("word"))
    return stored(words.groupBy(key, *keep, "word").agg(F.count(F.lit(1)).alias("tf")), "features")


@dataclass
class Statistics:
    """All that any cell of the grid needs: by word and label its occurrences (``n``) and texts (``d``), and by label
    the number of texts. ``table``: ``word``, ``docs`` (texts with the word), ``n`` and ``d`` as arrays over ``labels``."""

    labels: list[str]
    priors: list[int]
    table: DataFrame


def statistics(train: DataFrame, features: DataFrame, label: str = "label") -> Statistics:
    """Counts of the training rows in one pass over their features; rows without a label teach nothing."""
    classes = train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label).collect()
    labels = [r[label] for r in classes]  # a row a class

    def by_label(value: Column) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col(label) == v, value)), F.lit(0)) for v in labels])

    seen = features.where(F.col(label).isin(labels))
    table = seen.groupBy("word").agg(
        F.count(F.lit(1)).alias("docs"), by_label(F.col("tf")).alias("n"), by_label(F.lit(1).cast("bigint")).alias("d")
    )
    return Statistics(labels, [r.n for r in classes], materialise(table))


def cells(axes: dict[str, Sequence] | None = None) -> list[dict]:
    axes = axes or AXES
    return [dict(zip(axes, values)) for values in itertools.product(*axes.values())]


def _terms(stats: Statistics, grid: Sequence[dict]) -> list[tuple]:
    """For each cell and label: the column counted, what is added to it, what it is divided by, the fewest texts of a
    word the cell keeps, and whether repeats count."""
    totals = {}
    for least in sorted({c["min_docs"] for c in grid}):
        kept = F.col("docs") >= least
        totals[least] = stats.table.agg(
            F.count_if(kept).alias("words"),
            *[F.coalesce(F.sum(F.when(kept, F.get(m, F.lit(i)))), F.lit(0)).alias(f"{m}{i}") for m in "nd" for i in range(len(stats.labels))],
        ).first()
    out = []
    for c in grid:
        total, measure = totals[c["min_docs"]], "d" if c["presence"] else "n"
        for i in range(len(stats.labels)):
            below = total[f"{measure}{i}"] + c["alpha"] * total["words"]
            out.append((f"{measure}{i}", c["alpha"], float(below) or 1.0, c["min_docs"], not c["presence"]))
    return out


def _rare_from(table: DataFrame, head: int) -> int:
    """The fewest texts of a word among at most ``head`` frequent ones."""
    counts = table.groupBy("docs").agg(F.count(F.lit(1)).alias("_n"))
    through = F.sum("_n").over(Window.orderBy(F.desc("docs")))  # a row a number of texts
    least = counts.withColumn("_through", through).where(F.col("_through") <= head).agg(F.min("docs")).first()[0]
    return (1 << 62) if least is None else least


def _log_likelihoods(batches: Iterator[pa.RecordBatch], terms: Sequence[tuple]) -> Iterator[pa.RecordBatch]:
    """Sums over the words of each key, a row a batch and key: for each term the log probability in millionths."""
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
        column = {name: batch.column(name).to_numpy(zero_copy_only=False)[order] for name in batch.schema.names[1:]}
        kept = {least: column["docs"] >= least for _, _, _, least, _ in terms}
        # Few counts are different, so their logarithms are taken once.
        seen = {measure: pa.array(column[measure]).dictionary_encode() for measure in {t[0] for t in terms}}
        seen = {measure: (d.dictionary.to_numpy(), d.indices.to_numpy()) for measure, d in seen.items()}
        sums = np.empty((len(starts), len(terms)), dtype=np.int64)
        for j, (measure, alpha, below, least, repeats) in enumerate(terms):
            values, at = seen[measure]
            micro = -np.floor(0.5 - np.log((values + alpha) / below) * MICRO).astype(np.int64)
            sums[:, j] = np.add.reduceat(micro[at] * (kept[least] * column["tf"] if repeats else kept[least]), starts)
        offsets = pa.array(np.arange(len(starts) + 1) * len(terms), pa.int32())
        keys = batch.column(0).take(pa.array(order[starts]))
        yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(offsets, sums.ravel())], [batch.schema.names[0], "_sums"])


def posteriors(
    rows: DataFrame, features: DataFrame, stats: Statistics, grid: Sequence[dict], key: str, head: int = HEAD
) -> DataFrame:
    """``rows`` with ``scores``: for every cell an array of label scores, log prior plus log likelihoods in millionths.

    Texts meet the counts of their words once for all cells. The most frequent words, which would make hot keys, meet a
    broadcast part of at most ``head`` short words, the others a shuffled one. The words of a text are then brought
    together and summed, a batch of them in one call; a key of very many words may lie in several tasks.
    """
    width, terms = len(stats.labels), _terms(stats, grid)
    counts = [F.get(m, F.lit(i)).alias(f"{m}{i}") for m in "nd" for i in range(width)]
    table = stats.table.where(F.length("word") > 0).select("word", "docs", *counts)
    frequent = (F.col("docs") >= _rare_from(stats.table, head)) & (F.length("word") <= HEAD_CHARS)
    common = F.broadcast(table.where(frequent))
    words = features.select(key, "word", "tf")
    others = words.join(common.select("word"), "word", "left_anti").join(table.where(~frequent), "word")
    met = words.join(common, "word").unionByName(others).select(key, "tf", "docs", *[f"{m}{i}" for m in "nd" for i in range(width)])
    schema = StructType([features.select(key).schema[0], StructField("_sums", ArrayType(LongType()))])
    parts = met.hint("rebalance", key).sortWithinPartitions(key).mapInArrow(lambda batches: _log_likelihoods(batches, terms), schema)
    sums = parts.groupBy(key).agg(*[
        F.sum(F.get("_sums", F.lit(j * width + i))).alias(f"_s{j}_{i}") for j in range(len(grid)) for i in range(width)
    ])
    every = sum(stats.priors)
    priors = [F.round(F.ln(F.lit(n / every)) * MICRO).cast("bigint") for n in stats.priors]
    scores = F.array(*[
        F.array(*[F.coalesce(f"_s{j}_{i}", F.lit(0)) + priors[i] for i in range(width)]) for j in range(len(grid))
    ])
    return rows.join(sums, key, "left").withColumn("scores", scores).select(*rows.columns, "scores")


def chosen(scores: Column, labels: Sequence[str]) -> Column:
    """The label with the largest score; ties go to the first."""
    best = F.array_position(scores, F.array_max(scores)).cast("int")
    return F.get(F.array(*[F.lit(v) for v in labels]), best - 1)


def select_cell(scored: DataFrame, stats: Statistics, grid: Sequence[dict], label: str = "label") -> DataFrame:
    """The cells by accuracy on scored rows, best first: ``trial_idx``, the axes, ``n_val``, ``n_correct``,
    ``val_accuracy``, ``place``. All of them are measured in one pass."""
    names = list(grid[0])
    entry = [
        F.struct(
            F.lit(j).alias("trial_idx"), *[F.lit(c[n]).alias(n) for n in names],
            F.coalesce(chosen(F.get("scores", F.lit(j)), stats.labels) == F.col(label), F.lit(False)).cast("int").alias("_right"),
        )
        for j, c in enumerate(grid)
    ]
    trials = scored.select(F.inline(F.array(*entry))).groupBy("trial_idx", *names).agg(
        F.count(F.lit(1)).alias("n_val"), F.sum("_right").alias("n_correct")
    )
    trials = trials.withColumn("val_accuracy", F.col("n_correct") / F.col("n_val"))
    return leaderboard(trials, by=())
