import pytest
from pyspark.sql import functions as F

from modelvigil import schemas
from modelvigil.operators import drift, incidents, quality
from modelvigil.sources import files, views

SF = "/root/testdata/sf0.001"


def telemetry(spark):
    return views.pred_log(spark, SF).select(
        "event_id", "day", F.to_date("ts").alias("sim_date"), F.lit("t").alias("text"), "label", "predicted",
        "confidence", "latency_ms", "correct", "scenario",
    )


def test_examples_round_trip_without_the_group(spark, tmp_path):
    rows = [(1, 'quoted "text"\nnext line', "a", "g1"), (2, "äöß 🙂", "b", "g2")]
    df = spark.createDataFrame(rows, "ex_id long, text string, label string, group_id string")
    files.write_examples(df, f"{tmp_path}/x")
    back = files.read_examples(spark, f"{tmp_path}/x").rows
    assert back.columns == ["text", "label"]
    assert sorted(map(tuple, back.collect())) == sorted((r[1], r[2]) for r in rows)


LINES = [
    '{"text": "fine", "label": "a"}', "not json", '{"text": "half', '{"text": null, "label": "a"}', '{"label": "a"}',
    '{"text": "t"}', "", "   ", "[]", "7", '"text"', "null", '{"text": "", "label": "", "more": 1}', '{"text": 5, "label": "b"}', "{}",
]


def test_every_line_is_read_or_rejected(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text("\n".join(LINES[:8]) + "\n")
    (tmp_path / "f.jsonl").write_text("\n".join(LINES[8:]))
    read = files.read_examples(spark, f"{tmp_path}/*.jsonl")
    for examples in (read, files.land_examples(read, f"{tmp_path}/landed")):
        assert sorted(map(tuple, examples.rows.collect())) == [("", ""), ("5", "b"), ("fine", "a")]
        rejected = {r.line: (r.reason, r.file.split("/")[-1]) for r in examples.rejected.collect()}
        assert len(rejected) + 3 == sum(bool(line.strip()) for line in LINES) == examples.lines.count()
        assert rejected['{"text": "t"}'] == ("no label", "e.jsonl") and rejected["{}"] == ("no text", "f.jsonl")
        assert {line for line, r in rejected.items() if r[0] == "malformed"} == {"not json", '{"text": "half', "[]", "7", '"text"', "null"}


def test_a_repeated_batch_replaces_itself_as_a_whole(spark, tmp_path):
    path, log = f"{tmp_path}/p", telemetry(spark)
    files.append_predictions(log, path, "b")
    fewer = log.where("day < 4")
    files.append_predictions(fewer, path, "b")
    assert files.read_predictions(spark, path).count() == fewer.count() < log.count()
    # A version without its commit, as a run that died leaves it, is not seen.
    later = log.where("day = 9").selectExpr("*", "'c' AS batch_id", "'dead' AS version")
    later.write.mode("append").partitionBy("scenario", "sim_date", "batch_id", "version").parquet(path)
    assert files.read_predictions(spark, path).count() == fewer.count()
    files.append_predictions(log.where("day = 9"), path, "c")
    assert files.read_predictions(spark, path).count() == log.where("day < 4 OR day = 9").count()
    files.append_predictions(log.limit(0), path, "d")
    assert files.read_predictions(spark, path).count() == log.where("day < 4 OR day = 9").count()


def test_batches_of_a_day_add_up_and_repeats_do_not_double(spark, tmp_path):
    path = f"{tmp_path}/predictions"
    log = telemetry(spark)
    halves = {"even": log.where("event_id % 2 = 0"), "odd": log.where("event_id % 2 = 1")}
    for batch_id in ("even", "odd", "odd", "even"):
        files.append_predictions(halves[batch_id], path, batch_id)
    back = files.read_predictions(spark, path)
    assert sorted(back.columns) == sorted(log.columns)
    assert back.count() == log.count() and back.select("event_id").distinct().count() == log.count()
    other = log.where("day = 1").withColumn("scenario", F.lit("replay"))
    files.append_predictions(other, path, "even")
    pruned = files.read_predictions(spark, path, "replay")
    assert pruned.count() == other.count() and files.read_predictions(spark, path).count() == log.count() + other.count()
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scenario" in plan


def test_missing_input_is_empty_and_says_so(spark, tmp_path):
    with pytest.warns(files.MissingInput, match="nowhere"):
        assert files.read_predictions(spark, f"{tmp_path}/nowhere").count() == 0


def test_ingestion_log_round_trip(spark, tmp_path):
    log = views.ingest_log(spark, SF).withColumn("sim_date", F.to_date("ts")).withColumn("scenario", F.lit("quality"))
    files.append_ingestion(log, f"{tmp_path}/log", "all")
    back = files.read_ingestion(spark, f"{tmp_path}/log")
    rates = [tuple(r) for r in quality.rolling_issue_rates(back).orderBy("day").collect()]
    assert rates == [tuple(r) for r in quality.rolling_issue_rates(log).orderBy("day").collect()]


def test_series_and_summary_round_trip(spark, tmp_path):
    series = drift.drift_series(views.pred_log(spark, SF), [0.2] * 5, views.EVENT_TYPES)
    rows = sorted(map(tuple, series.collect()))
    for fmt in ("parquet", "csv"):
        files.write_series(series, f"{tmp_path}/{fmt}", fmt)
        back = files.read_series(spark, f"{tmp_path}/{fmt}", schemas.DRIFT_SERIES, fmt)
        assert sorted(map(tuple, back.collect())) == rows
    gap = spark.createDataFrame([(60, 0.9, 0.8, 0.7, 0.6, 0.1, True)], schemas.SKEW_SUMMARY)
    files.write_summary(gap, f"{tmp_path}/summary")
    assert files.read_summary(spark, f"{tmp_path}/summary", schemas.SKEW_SUMMARY).collect() == gap.collect()


def test_missing_input_gives_empty_results(spark, tmp_path):
    gone = f"{tmp_path}/none"
    assert files.read_examples(spark, gone).rows.count() == 0
    log = files.read_predictions(spark, gone, "drift")
    series = drift.drift_series(log, [0.5, 0.5], ["a", "b"])
    assert series.count() == 0 and drift.noise_band(log).head().threshold is None
    digest = incidents.alert_digest(
        incidents.drift_incidents(files.read_series(spark, gone, schemas.DRIFT_SERIES)),
        incidents.skew_incidents(files.read_summary(spark, gone, schemas.SKEW_SUMMARY)),
        incidents.quality_incidents(files.read_series(spark, gone, schemas.QUALITY_SERIES)),
    )
    assert digest.count() == 0 and incidents.digest_summary(digest).head().n_incidents == 0
    assert quality.rolling_issue_rates(files.read_ingestion(spark, gone)).count() == 0


def test_baseline_filter_and_columns_reach_the_scan(spark):
    plan = views.baseline_log(spark, SF).select("label")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
