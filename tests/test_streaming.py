import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from modelvigil.functions.checks import check_null_text
from modelvigil.operators import drift, incidents
from modelvigil.plans import live
from modelvigil.sources import views
from modelvigil.streaming import monitors, rolling

SF = "/root/testdata/sf0.001"
ORIGIN = views.ORIGIN


def at(day, hour=1):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=day, hours=hour)


def drop(spark, folder, rows, schema):
    """Add one file to a stream's folder."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def run(stream, folder, **kwargs):
    query = monitors.run_to_parquet(stream, f"{folder}/out", f"{folder}/ckpt", **kwargs)
    query.awaitTermination()
    return query


SCHEMA = "event_id long, ts timestamp, label string"


def test_quarantine_lands_once_over_restarts(spark, tmp_path):
    inbox = tmp_path / "in"
    schema = "id long, body string"
    for batch in ([(1, "good text"), (2, None)], [(3, "  "), (4, "more text")]):
        drop(spark, inbox, batch, schema)
        stream = spark.readStream.schema(schema).parquet(str(inbox))
        checked = monitors.validated_stream(stream, [check_null_text("body")])
        run(checked.select("id", "issue_types", "blocked"), tmp_path, partition_by=["blocked"])
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.id, r.blocked) for r in got.collect()) == [(1, 0), (2, 1), (3, 1), (4, 0)]
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir() and p.name.startswith("blocked")) == ["blocked=0", "blocked=1"]


def test_sliding_windows_equal_the_batch_series(spark, tmp_path):
    events = live.event_stream(spark, SF)
    log = views.predictions_of(events, monitors.day_of(F.col("ts"), ORIGIN))
    counts = monitors.sliding_label_counts(log, "predicted", views.EVENT_TYPES)
    run(monitors.window_drift(counts, [0.2] * 5), tmp_path)
    last = monitors.day_of(F.col("window.end"), ORIGIN) - 1
    got = {r.day: r for r in spark.read.parquet(f"{tmp_path}/out").withColumn("day", last).collect() if r.day >= 7}
    batch = drift.drift_series(views.pred_log(spark, SF), [0.2] * 5, views.EVENT_TYPES).collect()
    assert sorted(got) == list(range(7, 28))
    for r in batch:
        if r.day in got:
            assert got[r.day].n_in_window == r.n_in_window
            assert got[r.day].psi == pytest.approx(r.psi) and got[r.day].kl == pytest.approx(r.kl)


def test_late_rows_are_left_out(spark, tmp_path):
    inbox = tmp_path / "in"
    for batch in ([(1, at(0), "a"), (2, at(5), "a")], [(3, at(0, 2), "a"), (4, at(5, 3), "a"), (5, at(9), "a")]):
        drop(spark, inbox, batch, SCHEMA)
        stream = spark.readStream.schema(SCHEMA).parquet(str(inbox))
        ledger = monitors.LateRows(spark, f"{tmp_path}/late")
        late = ledger.watch(monitors.run_to_parquet(
            monitors.daily_partials(stream, {"n": F.count(F.lit(1))}), f"{tmp_path}/out", f"{tmp_path}/ckpt"
        ))
    assert late == 1
    days = spark.read.parquet(f"{tmp_path}/out").select(monitors.day_of(F.col("window.start"), ORIGIN).alias("day"), "n")
    assert {r.day: r.n for r in days.collect()} == {0: 1, 5: 2}


def test_late_rows_of_all_batches_are_counted(spark, tmp_path):
    """More batches than a query remembers, two late rows in the second one, and a restart."""
    inbox = tmp_path / "in"
    drop(spark, inbox, [(1, at(20), "a")], SCHEMA)
    for i, rows in enumerate([[(2, at(30), "a")], [(3, at(1), "a"), (4, at(2), "a")]] + [[(n, at(30), "a")] for n in range(105)]):
        drop(spark, tmp_path / f"part{i}", rows, SCHEMA)
        [part] = (tmp_path / f"part{i}").glob("part-*.parquet")
        target = inbox / f"part-{i:05d}.parquet"
        target.write_bytes(part.read_bytes())
        os.utime(target, (time.time() + i, time.time() + i))
    session = live.stream_session(spark, 1)
    for more in (False, True):
        if more:
            drop(spark, inbox, [(999, at(3), "a")], SCHEMA)
        stream = session.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(inbox))
        ledger = monitors.LateRows(spark, f"{tmp_path}/late")
        query = monitors.run_to_parquet(monitors.without_repeats(stream), f"{tmp_path}/out", f"{tmp_path}/ckpt")
        assert ledger.watch(query) == (3 if more else 2)
    assert len(ledger.dropped) > 108 and len(query.recentProgress) < 100
    monitors.LateRows(spark, f"{tmp_path}/late").total()
    gap = monitors.LateRows(spark, f"{tmp_path}/late")
    del gap.dropped[50]
    with pytest.raises(monitors.UnseenBatches, match="1 batches are unknown, the first is batch 50"):
        gap.total()


def trailing(spark, inbox, tmp_path):
    stream = live.stream_session(spark, 2).readStream.schema("ts timestamp, seg string, label string").parquet(str(inbox))
    counts = rolling.trailing_label_counts(stream, "label", ["a", "b"], ORIGIN, "seg", window=3)
    run(counts, tmp_path)
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    return sorted((r.seg, r.day, r.n_in_window, r.c0, r.c1) for r in rows)


def test_rolling_state_over_silent_days_and_restarts(spark, tmp_path):
    inbox = tmp_path / "in"
    schema = "ts timestamp, seg string, label string"
    drop(spark, inbox, [(at(0), "x", "a"), (at(0, 5), "x", "b"), (at(1), "x", "a"), (at(0), "y", "b"), (at(3), "x", "z")], schema)
    first = trailing(spark, inbox, tmp_path)
    want_x = [("x", 0, 2, 1, 1), ("x", 1, 3, 2, 1)]
    assert [r for r in first if r[0] == "x"] == want_x and ("y", 0, 1, 0, 1) in first
    # Key x falls silent after day 3 and comes back on day 12; y only ever had day 0.
    drop(spark, inbox, [(at(12), "x", "a"), (at(14), "w", "a")], schema)
    drop(spark, inbox, [(at(40), "w", "b")], schema)
    trailing(spark, inbox, tmp_path)
    drop(spark, inbox, [(at(80), "w", "b")], schema)
    got = trailing(spark, inbox, tmp_path)
    assert len(got) == len(set(r[:2] for r in got))
    x = {r[1]: r[2:] for r in got if r[0] == "x"}
    assert sorted(x) == list(range(0, 16))  # on to the day on which its window is empty again
    assert x[2] == (3, 2, 1) and x[3] == (2, 1, 0) and x[4] == (1, 0, 0) and x[6] == x[11] == (0, 0, 0)
    assert x[12] == x[14] == (1, 1, 0) and x[15] == (0, 0, 0)
    assert [r[1:] for r in got if r[0] == "y"] == [(0, 1, 0, 1), (1, 1, 0, 1), (2, 1, 0, 1), (3, 0, 0, 0)]


def test_delayed_labels_join_within_the_interval(spark, tmp_path):
    predictions, labels = tmp_path / "p", tmp_path / "l"
    drop(spark, predictions, [(i, at(0), "a") for i in range(4)], "event_id long, ts timestamp, predicted string")
    drop(spark, labels, [(0, at(1), "a"), (1, at(5), "b"), (2, at(5, 2), "a"), (9, at(1), "a")], "event_id long, label_ts timestamp, label string")
    joined = monitors.join_delayed_labels(
        spark.readStream.schema("event_id long, ts timestamp, predicted string").parquet(str(predictions)),
        spark.readStream.schema("event_id long, label_ts timestamp, label string").parquet(str(labels)),
    )
    run(joined, tmp_path)
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 1]


def test_sessions_equal_batch_spans(spark, tmp_path):
    alerts = [("m", d) for d in (1, 2, 4, 5, 6, 9)] + [("k", d) for d in (3, 4)] + [("end", 30)]
    rows = [(m, at(d, 0)) for m, d in alerts]
    drop(spark, tmp_path / "in", rows, "metric string, day_ts timestamp")
    stream = spark.readStream.schema("metric string, day_ts timestamp").parquet(str(tmp_path / "in"))
    run(monitors.alert_sessions(stream), tmp_path)
    days = [monitors.day_of(F.col(c), ORIGIN) for c in ("first_ts", "last_ts")]
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("metric", *days).collect())
    batch = incidents.incident_spans(spark.createDataFrame(alerts, "metric string, day int"), ["metric"])
    want = sorted((r.metric, r.start_day, r.end_day) for r in batch.collect() if r.metric != "end")
    assert got == want == [("k", 3, 4), ("m", 1, 2), ("m", 4, 6), ("m", 9, 9)]


def test_repeats_are_dropped_over_restarts(spark, tmp_path):
    inbox = tmp_path / "in"
    for batch in ([(1, at(0), "a"), (1, at(0), "a"), (2, at(0), "a")], [(2, at(0, 2), "a"), (3, at(0, 3), "a")]):
        drop(spark, inbox, batch, SCHEMA)
        stream = spark.readStream.schema(SCHEMA).parquet(str(inbox))
        run(monitors.without_repeats(stream), tmp_path)
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3]


def test_days_do_not_follow_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(at(3, 0),), (at(3, 23),)], "ts timestamp")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert [r[0] for r in df.select(monitors.day_of(F.col("ts"), ORIGIN)).collect()] == [3, 3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events as part files, each over all days, in shuffled order."""
    folder = tmp_path_factory.mktemp("parts")
    events = spark.read.schema(live.EVENT_SCHEMA).parquet(f"{SF}/events.parquet")
    events.repartition(5, F.xxhash64("event_id")).sortWithinPartitions(F.md5("props")).write.parquet(f"{folder}/events.parquet")
    assert len(list((folder / "events.parquet").glob("part-*"))) >= 4
    return str(folder)


@pytest.mark.parametrize("name", sorted(live.QUERIES))
def test_part_files_give_the_rows_of_one_file(spark, parts, name):
    want = sorted(map(str, live.QUERIES[name](spark, SF).collect()))
    assert sorted(map(str, live.QUERIES[name](spark, parts).collect())) == want and want


def test_a_bounded_stream_gives_all_days_and_open_sessions(spark):
    assert sorted(r.day for r in live.stream_sliding_psi(spark, SF).collect()) == list(range(7, 30))
    assert sorted(r.day for r in live.stream_daily_rates(spark, SF).collect()) == list(range(7, 30))


def test_rows_behind_the_watermark_fail_a_bounded_run(spark, tmp_path):
    events = spark.read.schema(live.EVENT_SCHEMA).parquet(f"{SF}/events.parquet")
    for days in ("ts >= '2024-01-20'", "ts < '2024-01-20' AND ts >= '2024-01-18'", "ts < '2024-01-05'"):
        part = events.where(days)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
        time.sleep(1.1)  # files are taken in order of modification
    with pytest.raises(RuntimeError, match="behind the watermark"):
        live.stream_daily_rates(spark, str(tmp_path), files_per_batch=1)
