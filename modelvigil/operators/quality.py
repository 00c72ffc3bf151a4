"""Record validation, routing around the scorer, and rolling data-quality rates."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelvigil.functions.checks import Check, has_blocking, issue_types, validate
from modelvigil.functions.text import is_blank
from modelvigil.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS
from modelvigil.operators.timeseries import rolling_counts
from modelvigil.presets import ISSUE_RATE_ALERT, MIN_TEXT_LENGTH, ROLLING_DAYS
from modelvigil.session import materialise

RATE_OF_ISSUE = {
    "null_text_rate": "null_or_empty_text",
    "sentinel_rate": "silent_default_priority",
    "enum_rate": "schema_violation_source_system",
}


def validate_records(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Add the issues of each row, the blocked flag and the comma-joined issue types."""
    checked = df.withColumn("issues", validate(checks))
    return checked.withColumn("blocked", has_blocking(F.col("issues")).cast("int")).withColumn(
        "issue_types", issue_types(F.col("issues"))
    )


def with_reference(
    df: DataFrame, field: str, reference: DataFrame, column: str, known: str,
    broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with ``known``: whether the value of ``field`` is in ``column`` of a reference table of any size.

    A left join with the distinct values, so rows neither vanish nor multiply, and issues keep their order. The values
    are computed once and measured: only up to ``broadcast_rows`` and ``broadcast_bytes`` they are broadcast; beyond
    that the join is a shuffle whose heavy values adaptive execution splits. ``df`` may be a stream; the table is then
    as it was when the stream started, so restart it (a run that takes what is there does) to see a changed one.
    """
    values = materialise(reference.where(F.col(column).isNotNull()).select(F.col(column).alias("_reference")).distinct())
    size = F.coalesce(F.sum(F.octet_length(F.col("_reference").cast("string"))), F.lit(0))
    n, n_bytes = values.agg(F.count(F.lit(1)), size).first()
    side = F.broadcast(values) if n <= broadcast_rows and n_bytes <= broadcast_bytes else values
    return df.join(side, F.col(field) == F.col("_reference"), "left").withColumn(
        known, F.col("_reference").isNotNull()
    ).drop("_reference")


def score_unblocked(df: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Send only unblocked rows to the scorer; blocked rows keep null outcomes.

    The filter stands before the scorer because Catalyst moves none through a Python stage.
    """
    scored = scorer(df.where(F.col("blocked") == 0))
    return scored.unionByName(df.where(F.col("blocked") == 1), allowMissingColumns=True)


def score_unblocked_columns(df: DataFrame, outcomes: dict[str, Column]) -> DataFrame:
    """The same routing for a scorer made of expressions: one scan, outcomes null where blocked."""
    return df.withColumns({name: F.when(F.col("blocked") == 0, value) for name, value in outcomes.items()})


def daily_ingestion(df: DataFrame, day: str = "day", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, day).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.size("issues") > 0).alias("n_with_issue"),
        F.count_if(F.col("blocked") == 1).alias("n_blocked"),
    )


def has_issue(issue: str, issues: str = "issues") -> Column:
    return F.exists(issues, lambda i: i["issue_type"] == issue)


def rolling_issue_rates(
    df: DataFrame, rates: dict[str, str] | None = None, day: str = "day", by: Sequence[str] = (),
    window: int = ROLLING_DAYS, warmup: int | None = None, correct: str = "correct",
    days: tuple[int, int] | None = None,
) -> DataFrame:
    """Share of rows with each issue, share blocked, and accuracy on what reached the model."""
    rates = rates or RATE_OF_ISSUE

    reached = F.col("blocked") == 0
    sums = {
        "_n": F.count(F.lit(1)),
        **{f"_{name}": F.count_if(has_issue(issue)) for name, issue in rates.items()},
        "_blocked": F.count_if(F.col("blocked") == 1),
        "_correct": F.coalesce(F.sum(F.when(reached, F.col(correct).cast("bigint"))), F.lit(0)),
        "_scored": F.count(F.when(reached, F.col(correct))),
    }
    rolled = rolling_counts(df, sums, day, by, window, warmup, days)

    def share(part: str, whole: str = "_n") -> Column:
        return F.try_divide(F.col(part).cast("double"), F.col(whole))

    return rolled.select(
        *by,
        "day",
        *[share(f"_{name}").alias(name) for name in rates],
        share("_blocked").alias("blocked_rate"),
        share("_correct", "_scored").alias("accuracy_unblocked"),
    )


def long_rates(series: DataFrame, rates: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The rate columns as rows (metric, metric_order, value)."""
    rates = list(rates or RATE_OF_ISSUE)
    entries = F.array(*[
        F.struct(F.lit(r).alias("metric"), F.lit(i).alias("metric_order"), F.col(r).alias("value"))
        for i, r in enumerate(rates)
    ])
    return series.select(*by, "day", F.inline(entries))


def first_rate_alerts(
    series: DataFrame, threshold: float = ISSUE_RATE_ALERT, rates: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """First day each rate passes the threshold, null if never."""
    crossed = F.when(F.col("value") > threshold, F.col("day"))
    return long_rates(series, rates, by).groupBy(*by, "metric").agg(F.min(crossed).alias("first_day"))


def attribution(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First and last accuracy on unblocked rows beside first and last blocked rate.

    Flat accuracy with a rising blocked rate points at the data and not at the model.
    """
    ends = series.groupBy(*by).agg(
        F.min_by("accuracy_unblocked", "day").alias("accuracy_first"),
        F.max_by("accuracy_unblocked", "day").alias("accuracy_last"),
        F.min_by("blocked_rate", "day").alias("blocked_first"),
        F.max_by("blocked_rate", "day").alias("blocked_last"),
    )
    return ends.withColumn("accuracy_change", F.col("accuracy_last") - F.col("accuracy_first")).withColumn(
        "blocked_change", F.col("blocked_last") - F.col("blocked_first")
    )


def gate_problems(
    df: DataFrame, vocabulary: Sequence[str], text: str = "text", label: str = "label",
    min_length: int = MIN_TEXT_LENGTH,
) -> DataFrame:
    """One row per problem of a training example; a row may have both."""
    bad_text = F.when(is_blank(F.col(text), min_length), F.lit("short_text"))
    bad_label = F.when(F.coalesce(~F.col(label).isin(*vocabulary), F.lit(True)), F.lit("invalid_label"))
    problems = F.array_compact(F.array(bad_text, bad_label))
    return df.withColumn("problem", F.explode(problems))


class DatasetRejected(ValueError):
    """The dataset gate found problems."""


def gate_splits(splits: dict[str, DataFrame], vocabulary: Sequence[str], **columns) -> DataFrame:
    """The problems of several splits (say train and validation) with the name of the split in ``split``."""
    named = [gate_problems(df, vocabulary, **columns).withColumn("split", F.lit(name)) for name, df in splits.items()]
    return functools.reduce(DataFrame.unionByName, named)


def assert_clean(
    df: DataFrame | dict[str, DataFrame], vocabulary: Sequence[str], key: str, text: str = "text", label: str = "label",
    shown: int = 5,
) -> None:
    """Raise with the number of problems and the first few of them; return nothing when clean.

    Splits by name are looked at together, and the name stands with each problem.
    """
    splits = df if isinstance(df, dict) else {"": df}
    problems = gate_splits(splits, vocabulary, text=text, label=label).select("split", key, "problem")
    first = problems.orderBy("split", key, F.desc("problem")).limit(shown).collect()
    if first:
        listing = ", ".join(f"{r.split} {r[key]}: {r['problem']}".lstrip() for r in first)
        raise DatasetRejected(f"{problems.count()} problem(s) in the dataset, first: {listing}")
