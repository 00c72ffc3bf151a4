"""Monitoring-shaped views over the given tables. Every row of a table takes part, with its whole text."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelvigil.functions.checks import check_enum, check_null_text, check_sentinel
from modelvigil.functions.draws import draw
from modelvigil.functions.text import normalize_prediction
from modelvigil.operators.quality import score_unblocked_columns, validate_records
from modelvigil.operators.search import grid_array
from modelvigil.sources.files import read_table

ORIGIN = "2024-01-01"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
LANG_LABELS = ("lang_de", "lang_en", "lang_es", "lang_fr")
SOURCES_KNOWN = ("src0", "src1", "src2", "src3")
SERVING_LENGTHS = (60, 40, 30)
SCORE_POSITIONS = tuple(range(0, 60, 6))
SCORE_LABELS = tuple(str(i) for i in range(10))
TRIAL_AXES = {"min_hits": (1, 2, 4), "min_per_1000": (0, 2, 8), "first_class": (0, 1, 2)}
SYSTEM_TEXT = "Name the language of the text. Answer with one of: " + ", ".join(LANG_LABELS) + "."
# Letters that give a language away, in the order they are tried.
LETTERS = {"lang_de": "ßäöü", "lang_es": "ñáíóú", "lang_fr": "èéêçà"}


def ticket_checks():
    return [check_null_text("ticket_text"), check_sentinel("priority"), check_enum("source_system", SOURCES_KNOWN)]


def _k() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int")


def event_day(ts: str = "ts") -> Column:
    return F.datediff(F.to_date(ts), F.lit(ORIGIN).cast("date"))


def _model_says(k: Column, day: Column) -> Column:
    return F.when(k < F.when(day >= 15, 30).otherwise(5), F.lit("error")).otherwise(F.col("event_type"))


def scenario_of(user: Column) -> Column:
    """Two scenarios of traffic; a filter on one reaches the scan as a test on the user."""
    return F.when(user % 2 == 0, F.lit("drift")).otherwise(F.lit("baseline"))


def predictions_of(events: DataFrame, day: Column) -> DataFrame:
    k = _k()
    return events.select(
        "event_id",
        "ts",
        day.alias("day"),
        F.col("event_type").alias("label"),
        _model_says(k, day).alias("predicted"),
        (_model_says(k, day) == F.col("event_type")).cast("int").alias("correct"),
        ((100 - k) / F.lit(100.0)).alias("confidence"),
        F.col("value").alias("latency_ms"),
        scenario_of(F.col("user_id")).alias("scenario"),
        F.concat(F.lit("seg"), (F.col("user_id") % 4).cast("string")).alias("segment"),
    )


def pred_log(spark: SparkSession, folder: str, before: str | None = None) -> DataFrame:
    """Prediction telemetry; ``before`` is a date and reaches the scan as a pushed filter on ``ts``."""
    events = read_table(spark, folder, "events")
    if before is not None:
        events = events.where(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    return predictions_of(events, event_day())


def baseline_log(spark: SparkSession, folder: str) -> DataFrame:
    """The first seven days, standing in for the training labels."""
    return pred_log(spark, folder, before="2024-01-08")


def raw_tickets(spark: SparkSession, folder: str) -> DataFrame:
    return tickets_of(read_table(spark, folder, "events"), event_day())


def tickets_of(events: DataFrame, day: Column) -> DataFrame:
    """Ticket records with faults that set in on days 7, 15 and 21."""
    k = _k()
    lost = (day >= 7) & (k < 15)
    return events.select(
        "event_id",
        "ts",
        day.alias("day"),
        F.when(lost & (k % 2 == 0), F.lit(None).cast("string"))
        .when(lost, F.lit(""))
        .otherwise(F.concat_ws(" #", "event_type", F.col("event_id").cast("string")))
        .alias("ticket_text"),
        F.when((day >= 15) & k.between(20, 49), F.lit("UNSET"))
        .otherwise(F.concat(F.lit("P"), (F.col("user_id") % 5 + 1).cast("string")))
        .alias("priority"),
        F.when((day >= 21) & (k >= 80), F.lit("new_source"))
        .otherwise(F.concat(F.lit("src"), (F.col("user_id") % 4).cast("string")))
        .alias("source_system"),
        F.col("event_type").alias("label"),
        k.alias("k"),
        F.concat(F.lit("seg"), (F.col("user_id") % 4).cast("string")).alias("segment"),
    )


def ticket_outcomes() -> dict[str, Column]:
    predicted = F.when(F.col("k").between(50, 52), F.lit("error")).otherwise(F.col("label"))
    return {
        "predicted": predicted,
        "confidence": (100 - F.col("k")) / F.lit(100.0),
        "correct": (predicted == F.col("label")).cast("int"),
    }


def checked_tickets(spark: SparkSession, folder: str) -> DataFrame:
    return validate_records(raw_tickets(spark, folder), ticket_checks())


def ingest_log(spark: SparkSession, folder: str) -> DataFrame:
    """Validated tickets, scored when not blocked."""
    return score_unblocked_columns(checked_tickets(spark, folder), ticket_outcomes())


def has_letters(text: Column, label: str) -> Column:
    """Literal search stays on UTF-8 bytes and is several times faster than a character class."""
    return functools.reduce(lambda a, b: a | b, [text.contains(c) for c in LETTERS[label]])


def count_letters(text: Column, label: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{LETTERS[label]}]"))


def language_rule(text: Column) -> Column:
    """Struct (predicted, confidence): the first language whose letters occur, else English.

    Only the letters of the chosen language are counted.
    """

    def answer(label: str, hits: Column) -> Column:
        confidence = (hits + 1).cast("double") / (hits + 2)
        return F.struct(F.lit(label).alias("predicted"), confidence.alias("confidence"))

    choice = F
    for label in LETTERS:
        choice = choice.when(has_letters(text, label), answer(label, count_letters(text, label)))
    return choice.otherwise(answer("lang_en", F.lit(0)))


def labelled_docs(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return docs.select(
        F.col("doc_id").alias("ex_id"),
        "text",
        F.concat(F.lit("lang_"), "lang").alias("label"),
        "source",
        F.concat_ws("_", "lang", "source").alias("group_id"),
    )


def _base_answer(flags: dict[str, Column], english: Column) -> Column:
    said = [F.when(flag, F.lit(f"I think it is Lang {label[-2:].upper()}")) for label, flag in flags.items()]
    return F.coalesce(*said, F.lit("no idea"))


def _tuned_answer(flags: dict[str, Column], english: Column) -> Column:
    said = [F.when(flag, F.lit(label)) for label, flag in flags.items()]
    return F.coalesce(*said, F.when(english, F.lit("LANG_EN")), F.lit("Probably lang fr or lang en"))


ANSWERS = {"base": _base_answer, "tuned": _tuned_answer}


def _with_flags(df: DataFrame, text: str) -> DataFrame:
    """Look for the tell-tale letters and words once per text, before the models answer."""
    lowered = F.lower(text)
    english = lowered.contains(" the ") | lowered.contains(" of ") | lowered.contains(" and ")
    return df.withColumns({**{f"_{v}": has_letters(F.col(text), v) for v in LETTERS}, "_english": english})


def _flags() -> tuple[dict[str, Column], Column]:
    return {label: F.col(f"_{label}") for label in LETTERS}, F.col("_english")


def raw_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Free-text answers of two models to every document."""
    docs = _with_flags(labelled_docs(spark, folder).withColumn("_size", F.length("text")), "text")
    answers = F.array(*[
        F.struct(
            F.lit(model).alias("model"),
            answer(*_flags()).alias("raw_output"),
            ((F.col("_size") + 37 * i) / F.lit(100_000.0 / (i + 1))).alias("latency_s"),
        )
        for i, (model, answer) in enumerate(ANSWERS.items())
    ])
    return docs.select("ex_id", "label", "source", F.inline(answers))


def model_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluation rows of both models."""
    outputs = raw_outputs(spark, folder).withColumn(
        "predicted", normalize_prediction(F.col("raw_output"), LANG_LABELS)
    )
    return outputs.withColumn("correct", (F.col("predicted") == F.col("label")).cast("int")).withColumn(
        "output_tokens", F.size(F.split("raw_output", " "))
    )


def repeated_runs(spark: SparkSession, folder: str, runs: int = 5) -> DataFrame:
    """Five predictions per document and model; together the runs read the whole text, a fifth each."""
    part = F.floor((F.length("text") + (runs - 1)) / runs).cast("int")
    parts = F.array(*[F.substring(F.col("text"), part * run + 1, part) for run in range(runs)])
    read = labelled_docs(spark, folder).select("ex_id", "label", F.posexplode(parts).alias("run", "_part"))
    answers = F.array(*[
        F.struct(F.lit(model).alias("model"), answer(*_flags()).alias("raw_output")) for model, answer in ANSWERS.items()
    ])
    outputs = _with_flags(read, "_part").select("ex_id", "label", "run", F.inline(answers))
    return outputs.select(
        "model", "ex_id", "run", "label", normalize_prediction(F.col("raw_output"), LANG_LABELS).alias("predicted")
    )


def score_vectors(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "embeddings")
    return table.select(F.col("vec_id").alias("ex_id"), F.col("embedding").alias("scores"), F.col("label").cast("string").alias("label"))


def gate_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their quality mark as the label; unmarked ones have none."""
    docs = read_table(spark, folder, "documents", ["doc_id", "text"])
    marks = read_table(spark, folder, "labels", ["doc_id", "quality"])
    return docs.join(marks, "doc_id", "left").select(
        F.col("doc_id").alias("ex_id"), "text", F.col("quality").cast("string").alias("label")
    )


def _letter_hits(text: Column) -> dict[str, Column]:
    return {
        f"_h{i}": F.when(has_letters(text, v), count_letters(text, v)).otherwise(0) for i, v in enumerate(LETTERS)
    }


def _rule_says(hits: Sequence[Column], size: Column) -> Column:
    """What the rule of a grid cell (its columns are in the row) says of a text with these letters and this size."""
    names = list(LETTERS)
    found = [(h >= F.col("min_hits")) & (h * 1000 >= size * F.col("min_per_1000")) for h in hits]

    def first_found(start: int) -> Column:
        order = [(start + j) % len(names) for j in range(len(names))]
        return F.coalesce(*[F.when(found[i], F.lit(names[i])) for i in order], F.lit("lang_en"))

    return F.when(F.col("first_class") == 0, first_found(0)).when(F.col("first_class") == 1, first_found(1)).otherwise(first_found(2))


def trial_results(spark: SparkSession, folder: str) -> DataFrame:
    """Validation and test accuracy of 27 rule settings, searched separately for every source.

    The letters of a text are counted once. Then each setting is one narrow row with an arithmetic test,
    so one scan and one aggregation with map-side combining measure the whole grid.
    """
    hits = _letter_hits(F.col("text"))
    docs = labelled_docs(spark, folder).select(
        F.col("source").alias("search_id"), "label", F.length("text").alias("_size"),
        (draw(F.col("ex_id"), 42) < 0.5).alias("_val"), *[h.alias(n) for n, h in hits.items()],
    )
    rows = docs.select("*", F.inline(grid_array(TRIAL_AXES)))
    judged = rows.withColumn("_right", _rule_says([F.col(n) for n in hits], F.col("_size")) == F.col("label"))
    sums = judged.groupBy("search_id", "trial_idx", *TRIAL_AXES).agg(
        F.count_if(F.col("_val")).alias("n_val"),
        F.count_if(~F.col("_val")).alias("n_test"),
        F.count_if(F.col("_val") & F.col("_right")).alias("n_val_correct"),
        F.count_if(~F.col("_val") & F.col("_right")).alias("n_test_correct"),
    )
    return sums.withColumn("val_accuracy", F.try_divide(F.col("n_val_correct").cast("double"), F.col("n_val"))).withColumn(
        "test_accuracy", F.try_divide(F.col("n_test_correct").cast("double"), F.col("n_test"))
    )


def trial_consistency(spark: SparkSession, folder: str) -> DataFrame:
    """Of each search and trial the test examples whose two runs, on the two halves of the text, agree.

    The letters of both halves are counted once, then every setting is a narrow row, as for the accuracies.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    halves = [F.substring(F.col("text"), F.lit(1), half), F.substring(F.col("text"), half + 1, F.length("text"))]
    counted = {f"{n}_{run}": h for run, text in enumerate(halves) for n, h in _letter_hits(text).items()}
    docs = labelled_docs(spark, folder).where(draw(F.col("ex_id"), 42) >= 0.5).select(
        F.col("source").alias("search_id"), *[F.length(text).alias(f"_size_{run}") for run, text in enumerate(halves)],
        *[h.alias(n) for n, h in counted.items()],
    )
    rows = docs.select("*", F.inline(grid_array(TRIAL_AXES)))
    first, second = (
        _rule_says([F.col(f"_h{i}_{run}") for i in range(len(LETTERS))], F.col(f"_size_{run}")) for run in range(2)
    )
    return rows.withColumn("_agree", first == second).groupBy("search_id", "trial_idx").agg(
        F.count(F.lit(1)).alias("n_examples"), F.count_if(F.col("_agree")).alias("n_agree")
    )
