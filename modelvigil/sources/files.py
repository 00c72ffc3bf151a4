"""Readers and writers. Missing input reads as an empty table with the declared schema, and says so."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelvigil import schemas


class MissingInput(UserWarning):
    """An input path that does not exist."""


def _or_empty(spark: SparkSession, schema: T.StructType, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no such input, reading an empty table instead: {error.getMessage()}", MissingInput, stacklevel=3)
        return schemas.empty(spark, schema)


class Examples(NamedTuple):
    """What a set of example files holds. All three are views of one scan; to keep both sides from a single pass, land
    ``lines`` with :func:`land_examples`."""

    rows: DataFrame  # text, label
    rejected: DataFrame  # file, line, reason
    lines: DataFrame  # text, label, file, line, reason (null for a sound line)


def read_examples(spark: SparkSession, path: str) -> Examples:
    """Labelled examples from JSON lines, and every line that is none: not a JSON object, or without a text or a label.

    Each line that is not blank is in exactly one of ``rows`` and ``rejected``.
    """
    wanted = T.StructType([*schemas.EXAMPLE, T.StructField("_corrupt", T.StringType())])
    held = T.StructType([T.StructField("line", T.StringType()), T.StructField("file", T.StringType())])
    lines = _or_empty(
        spark, held, lambda: spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    )
    record = F.from_json("line", wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = lines.where(F.length(F.trim("line")) > 0).withColumn("_record", record)
    reason = (
        F.when(F.col("_record._corrupt").isNotNull() | F.col("_record").isNull() | ~F.trim("line").startswith("{"), F.lit("malformed"))
        .when(F.col("_record.text").isNull(), F.lit("no text"))
        .when(F.col("_record.label").isNull(), F.lit("no label"))
    )
    every = parsed.select("_record.text", "_record.label", "file", "line", reason.alias("reason"))
    sound = F.col("reason").isNull()
    return Examples(every.where(sound).select("text", "label"), every.where(~sound).select("file", "line", "reason"), every)


def land_examples(examples: Examples, path: str) -> Examples:
    """Write sound and rejected lines in one job, a folder each, and return them as read from there."""
    spark = examples.lines.sparkSession
    sound = F.col("reason").isNull()
    kept = examples.lines.withColumn("line", F.when(~sound, F.col("line"))).withColumn("sound", sound.cast("int"))
    kept.write.mode("overwrite").partitionBy("sound").parquet(path)
    back = spark.read.schema(kept.schema).parquet(path)
    return Examples(
        back.where("sound = 1").select("text", "label"), back.where("sound = 0").select("file", "line", "reason"), back.drop("sound")
    )


def write_examples(df: DataFrame, path: str, text: str = "text", label: str = "label") -> None:
    """Examples as JSON lines with just the text and the label."""
    df.select(F.col(text).alias("text"), F.col(label).alias("label")).write.mode("overwrite").json(path)


_COMMIT = T.StructType([
    T.StructField("scenario", T.StringType()), T.StructField("batch_id", T.StringType()),
    T.StructField("version", T.StringType()), T.StructField("attempt", T.LongType()), T.StructField("n_rows", T.LongType()),
])


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """A row for each committed version of a batch; the folder's name keeps it out of scans of the data."""
    return _or_empty(spark, _COMMIT, lambda: spark.read.schema(_COMMIT).parquet(f"{path}/_commits"))


def _append_batch(df: DataFrame, path: str, schema: T.StructType, batch_id: str) -> None:
    """Add one batch of rows; a day may come in many batches. Written again, a batch replaces itself as a whole.

    The rows go to partitions of a version of their own (scenario, day, batch, version). When all are written, one
    small file commits the version, so readers see the whole batch or, after a failure, none of it; days that the
    repeated batch no longer has go with the old version. A batch is named by ``batch_id`` within each scenario it
    has rows of. Files of superseded versions stay until they are cleared away. Rows gather by partition; the
    rebalance hint lets adaptive execution split a heavy day into files of the advisory size.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    by = ["scenario", "sim_date", "batch_id", "version"]
    fields = _stored(schema)
    rows = df.withColumns({"batch_id": F.lit(str(batch_id)), "version": F.lit(version)})
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in fields]).hint("rebalance", *by)
    rows.write.mode("append").partitionBy(*by).parquet(path)
    own = spark.read.schema(fields).parquet(path).where(F.col("version") == version)
    written = own.groupBy("scenario", "batch_id", "version").agg(F.count(F.lit(1)).alias("n_rows"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", MissingInput)
        before = _commits(spark, path)
    before = before.where(F.col("batch_id") == str(batch_id)).groupBy(F.col("scenario").alias("_scenario")).agg(F.max("attempt").alias("_last"))
    commit = written.join(before, F.col("scenario").eqNullSafe(F.col("_scenario")), "left")
    commit = commit.withColumn("attempt", F.coalesce(F.col("_last"), F.lit(0)) + 1).select(*_COMMIT.fieldNames())
    commit.coalesce(1).write.mode("append").parquet(f"{path}/_commits")


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("batch_id", T.StringType()), T.StructField("version", T.StringType())])


def _committed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the last committed version of every batch."""
    table = _or_empty(spark, _stored(schema), lambda: spark.read.schema(_stored(schema)).parquet(path))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", MissingInput)
        commits = _commits(spark, path)
    latest = commits.groupBy("scenario", "batch_id").agg(F.max(F.struct("attempt", "version")).alias("_last"))
    live = latest.select(F.col("_last.version").alias("version"))
    return table.join(live, "version", "left_semi").select(*schema.fieldNames())


def append_predictions(df: DataFrame, path: str, batch_id: str) -> None:
    """Add a batch of prediction telemetry; ``batch_id`` names it for repeated runs."""
    _append_batch(df, path, schemas.PREDICTIONS, batch_id)


def append_ingestion(df: DataFrame, path: str, batch_id: str) -> None:
    """Add a batch of ingestion records; ``batch_id`` names it for repeated runs."""
    _append_batch(df, path, schemas.INGESTION, batch_id)


def read_predictions(spark: SparkSession, path: str, scenario: str | None = None) -> DataFrame:
    """Prediction telemetry of all committed batches; a scenario prunes partitions."""
    table = _committed(spark, path, schemas.PREDICTIONS)
    return table if scenario is None else table.where(F.col("scenario") == scenario)


def read_ingestion(spark: SparkSession, path: str) -> DataFrame:
    """Ingestion records of all committed batches."""
    return _committed(spark, path, schemas.INGESTION)


def write_series(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A day series as parquet, or as CSV with a header for other tools."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)


def read_series(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return _or_empty(spark, schema, lambda: reader.load(path))


def write_summary(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_summary(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path))


def read_table(spark: SparkSession, folder: str, name: str, columns: Sequence[str] = ()) -> DataFrame:
    """One table of a folder of parquet files."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return table.select(*columns) if columns else table
