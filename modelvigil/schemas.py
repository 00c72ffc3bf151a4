"""Declared schemas of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

EXAMPLE = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.StringType())])

PREDICTIONS = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("sim_date", T.DateType(), False),
    T.StructField("text", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("predicted", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("correct", T.IntegerType()),
    T.StructField("scenario", T.StringType(), False),
])

ISSUE = T.StructType([
    T.StructField("issue_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("value", T.StringType()),
])

INGESTION = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("sim_date", T.DateType(), False),
    T.StructField("ticket_text", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("issues", T.ArrayType(ISSUE)),
    T.StructField("blocked", T.IntegerType(), False),
    T.StructField("predicted", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("correct", T.IntegerType()),
    T.StructField("scenario", T.StringType(), False),
])

DRIFT_SERIES = T.StructType([
    T.StructField("day", T.IntegerType()),
    T.StructField("n_in_window", T.LongType()),
    T.StructField("psi", T.DoubleType()),
    T.StructField("kl", T.DoubleType()),
    T.StructField("psi_band", T.StringType()),
    T.StructField("accuracy_as_known", T.DoubleType()),
])

QUALITY_SERIES = T.StructType([
    T.StructField("day", T.IntegerType()),
    T.StructField("null_text_rate", T.DoubleType()),
    T.StructField("sentinel_rate", T.DoubleType()),
    T.StructField("enum_rate", T.DoubleType()),
    T.StructField("blocked_rate", T.DoubleType()),
    T.StructField("accuracy_unblocked", T.DoubleType()),
])

SKEW_SUMMARY = T.StructType([
    T.StructField("max_chars", T.IntegerType()),
    T.StructField("offline_accuracy", T.DoubleType()),
    T.StructField("serving_accuracy", T.DoubleType()),
    T.StructField("offline_confidence", T.DoubleType()),
    T.StructField("serving_confidence", T.DoubleType()),
    T.StructField("gap", T.DoubleType()),
    T.StructField("flagged", T.BooleanType()),
])

INCIDENT = T.StructType([
    T.StructField("source_stage", T.StringType(), False),
    T.StructField("alert_type", T.StringType(), False),
    T.StructField("start_day", T.IntegerType()),
    T.StructField("end_day", T.IntegerType()),
    T.StructField("peak_value", T.DoubleType()),
    T.StructField("impact_confirmed", T.BooleanType(), False),
    T.StructField("impact_description", T.StringType()),
    T.StructField("blocking", T.BooleanType(), False),
])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
