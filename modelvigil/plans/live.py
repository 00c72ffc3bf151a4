"""Registered streaming queries: the stream runs over a whole table, then its sink is read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelvigil.functions.divergence import kl, psi, psi_band
from modelvigil.operators import drift, quality
from modelvigil.operators.timeseries import fill_days, rolling_sums
from modelvigil.plans.sql import DAYS, INGEST_LOG, PRED_LOG, PSI_ROWS, QUALITY_SERIES, with_
from modelvigil.presets import CLIP_EPSILON
from modelvigil.session import scratch_path
from modelvigil.sources import views
from modelvigil.streaming import monitors, rolling

# Event time is declared as timestamp: a watermark refuses timestamps without a zone.
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def stream_session(spark, state_stores=None):
    """A session of its own for streams, with the state store on disk.

    The number of state stores is fixed by the shuffle partitions of a stream's first run; without
    ``state_stores`` it is the number of cores of the cluster.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(state_stores or spark.sparkContext.defaultParallelism))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", monitors.ROCKSDB)
    return session


def event_stream(session, folder, files_per_batch=None):
    """The events table as a stream, from one file or a folder of part files.

    ``files_per_batch`` bounds a micro-batch. Files are then taken in order of their modification, so the
    delay of the watermarks has to cover how far their events are apart.
    """
    reader = session.readStream.schema(EVENT_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A pattern, as a stream takes a plain path for a folder.
    return reader.parquet(f"{folder}/events.parque[t]")


def _day():
    return monitors.day_of(F.col("ts"), views.ORIGIN)


def landed(spark, build, name, stream, partition_by=(), ts="ts"):
    """Run a bounded stream to its end into the shared folder and read the result.

    ``build`` makes the query out of ``stream`` and of the closing row that follows it, so that the windows
    and sessions still open at the end come out as well. Rows behind the watermark fail the run.
    """
    path = scratch_path(spark, name)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
    result = build(monitors.with_closing_rows(stream, f"{path}/closing", ts))
    for closing in (False, True):
        if closing:
            monitors.close_stream(spark, f"{path}/closing", schema, ts)
        ledger = monitors.LateRows(spark, f"{path}/late")
        query = monitors.run_to_parquet(result, f"{path}/table", f"{path}/checkpoint", partition_by)
        if late := ledger.watch(query):
            raise RuntimeError(f"{late} rows of stream {name} came behind the watermark")
    fields = [T.StructField(f.name, f.dataType) for f in result.schema if f.name not in partition_by]
    kept = T.StructType(fields + [T.StructField(c, T.IntegerType()) for c in partition_by])
    return spark.read.schema(kept).parquet(f"{path}/table")


def _checked(events):
    return monitors.validated_stream(views.tickets_of(events, _day()), views.ticket_checks())


def _real(df):
    """Without the closing row, which has no id."""
    return df.where(F.col("event_id").isNotNull())


def stream_quarantine(spark, folder, files_per_batch=None):
    """Clean and quarantined tickets from one sink."""
    events = event_stream(stream_session(spark), folder, files_per_batch)

    def build(rows):
        return _checked(_real(rows)).select("event_id", "day", "issue_types", "blocked")

    table = landed(spark, build, "quarantine", events, ["blocked"])
    return table.select("event_id", "day", "issue_types", "blocked")


def stream_sliding_psi(spark, folder, files_per_batch=None):
    """PSI of all seven-day windows that end on a day of the table."""
    baseline = drift.label_vector(views.baseline_log(spark, folder), "label", views.EVENT_TYPES).head()["baseline"]
    events = event_stream(stream_session(spark), folder, files_per_batch)

    def build(rows):
        counts = monitors.sliding_label_counts(views.predictions_of(rows, _day()), "predicted", views.EVENT_TYPES)
        return monitors.window_drift(counts, baseline)

    last = monitors.day_of(F.col("window.end"), views.ORIGIN) - 1
    full = landed(spark, build, "sliding", events).select(
        last.alias("day"), "n_in_window", F.round("psi", 6).alias("psi"), F.round("kl", 6).alias("kl")
    )
    newest = views.pred_log(spark, folder).agg(F.max("day").alias("day")).select("day").scalar()
    return full.where(F.col("day").between(7, newest)).withColumn("psi_band", psi_band(F.col("psi")))


def stream_daily_rates(spark, folder, files_per_batch=None):
    """Daily partials from the stream; the trailing seven-day rates are taken on read."""
    issues = {name: F.count_if(quality.has_issue(issue)) for name, issue in quality.RATE_OF_ISSUE.items()}
    sums = {"n": F.count(F.lit(1)), **issues, "blocked_rate": F.count_if(F.col("blocked") == 1)}
    events = event_stream(stream_session(spark), folder, files_per_batch)
    daily = landed(spark, lambda rows: monitors.daily_partials(_checked(rows), sums), "daily", events)
    daily = daily.select(monitors.day_of(F.col("window.start"), views.ORIGIN).alias("day"), *sums)
    rolled = rolling_sums(fill_days(daily, list(sums), first_day=7), list(sums)).where(F.col("day") >= 7)
    rates = [c for c in sums if c != "n"]
    return rolled.select("day", *[F.round(F.try_divide(F.col(c).cast("double"), F.col("n")), 6).alias(c) for c in rates])


def stream_label_join(spark, folder, files_per_batch=None):
    """Labels arrive one to eight days late; those within five days meet their prediction."""
    session = stream_session(spark)
    late = (F.col("user_id") % 8 + 1).cast("int")
    labels = _real(event_stream(session, folder, files_per_batch)).select(
        "event_id", F.col("event_type").alias("label"), (F.col("ts") + F.make_dt_interval(days=late)).alias("label_ts")
    )

    def build(rows):
        log = views.predictions_of(_real(rows), _day()).select("event_id", "ts", "day", "predicted")
        return monitors.join_delayed_labels(log, labels)

    matched = landed(spark, build, "labels", event_stream(session, folder, files_per_batch))
    correct = (F.col("predicted") == F.col("label")).cast("int")
    known = matched.groupBy(monitors.day_of(F.col("label_ts"), views.ORIGIN).alias("label_day")).agg(
        F.count(F.lit(1)).alias("n_known"), F.avg(correct).alias("accuracy")
    )
    return known.withColumn("accuracy", F.round("accuracy", 6))


def stream_alert_sessions(spark, folder, files_per_batch=None):
    """Incident spans straight from the events, in one stream: label counts a day, those above the baseline week,
    and sessions of the days on which they are."""
    base = drift.label_distribution(views.baseline_log(spark, folder), "label", views.EVENT_TYPES)
    shares = {r.label: r.p for r in base.collect()}  # a row a label of the vocabulary

    def build(rows):
        log = views.predictions_of(rows, _day())
        return monitors.alert_sessions(monitors.label_surges(log, "predicted", shares), delay=None)

    sessions = landed(spark, build, "sessions", event_stream(stream_session(spark), folder, files_per_batch))
    first, last = (monitors.day_of(F.col(c), views.ORIGIN) for c in ("first_ts", "last_ts"))
    return sessions.select("metric", first.alias("start_day"), last.alias("end_day"))


def stream_rolling_psi(spark, folder, files_per_batch=None):
    """PSI of each day's trailing seven days by segment, from rolling state instead of seven windows a row."""
    baseline = drift.label_vector(views.baseline_log(spark, folder), "label", views.EVENT_TYPES, ["segment"])
    events = event_stream(stream_session(spark), folder, files_per_batch)

    def build(rows):
        log = views.predictions_of(rows, _day())
        return rolling.trailing_label_counts(log, "predicted", views.EVENT_TYPES, views.ORIGIN, "segment")

    counts = landed(spark, build, "rolling", events)
    newest = views.pred_log(spark, folder).agg(F.max("day").alias("day")).select("day").scalar()
    shares = F.array(*[
        F.coalesce(F.try_divide(F.col(f"c{i}").cast("double"), F.col("n_in_window")), F.lit(0.0))
        for i in range(len(views.EVENT_TYPES))
    ])
    series = counts.where(F.col("day").between(7, newest)).join(baseline, "segment")
    return series.select(
        "segment", "day", "n_in_window", F.round(psi("baseline", shares, CLIP_EPSILON), 6).alias("psi"),
        F.round(kl("baseline", shares, CLIP_EPSILON), 6).alias("kl"),
    )


def stream_dedup(spark, folder, files_per_batch=None):
    """Every event delivered twice is counted once."""
    def build(rows):
        twice = _real(rows).withColumn("_delivery", F.explode(F.array(F.lit(1), F.lit(2))))
        return monitors.without_repeats(twice).select("event_id", "ts", "event_type")

    once = landed(spark, build, "dedup", event_stream(stream_session(spark), folder, files_per_batch))
    return once.groupBy(_day().alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    q.__name__: q
    for q in (
        stream_quarantine, stream_sliding_psi, stream_rolling_psi, stream_daily_rates, stream_label_join,
        stream_alert_sessions, stream_dedup,
    )
}

ORACLES = {
    "stream_quarantine": with_(INGEST_LOG) + "SELECT event_id, day, issue_types, blocked FROM ingest_log",
    "stream_sliding_psi": with_(PRED_LOG, DAYS, PSI_ROWS) + """
        SELECT day, n_in_window, round(psi, 6) AS psi, round(kl, 6) AS kl,
               CASE WHEN psi > 0.25 THEN 'significant' WHEN psi >= 0.10 THEN 'moderate' ELSE 'none' END AS psi_band
        FROM psi_rows WHERE segment = 'all'""",
    "stream_rolling_psi": with_(PRED_LOG, DAYS, PSI_ROWS) + """
        SELECT segment, day, n_in_window, round(psi, 6) AS psi, round(kl, 6) AS kl FROM psi_rows WHERE segment <> 'all'""",
    "stream_daily_rates": with_(INGEST_LOG, QUALITY_SERIES) + """
        SELECT day, round(null_text_rate, 6) AS null_text_rate, round(sentinel_rate, 6) AS sentinel_rate,
               round(enum_rate, 6) AS enum_rate, round(blocked_rate, 6) AS blocked_rate
        FROM quality_series""",
    "stream_label_join": with_(PRED_LOG) + """
        SELECT p.day + CAST(1 + e.user_id % 8 AS INT) AS label_day, count(*) AS n_known,
               round(avg(p.correct), 6) AS accuracy
        FROM pred_log p JOIN events e USING (event_id) WHERE 1 + e.user_id % 8 <= 5 GROUP BY label_day""",
    "stream_alert_sessions": with_(PRED_LOG) + """,
        week AS (SELECT label, count(*) / CAST((SELECT count(*) FROM pred_log WHERE day < 7) AS DOUBLE) AS base_p
                 FROM pred_log WHERE day < 7 GROUP BY label),
        daily AS (SELECT predicted AS metric, day, count(*) AS n FROM pred_log GROUP BY ALL),
        totals AS (SELECT day, count(*) AS total FROM pred_log GROUP BY day),
        surges AS (SELECT metric, day, day - row_number() OVER (PARTITION BY metric ORDER BY day) AS g
                   FROM daily JOIN totals USING (day) JOIN week ON week.label = metric
                   WHERE n / CAST(total AS DOUBLE) > base_p),
        spans AS (SELECT metric, min(day) AS start_day, max(day) AS end_day FROM surges GROUP BY metric, g)
        SELECT * FROM spans""",
    "stream_dedup": with_(PRED_LOG) + "SELECT day, label AS event_type, count(*) AS n FROM pred_log GROUP BY ALL",
}
