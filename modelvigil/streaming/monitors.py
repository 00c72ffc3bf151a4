"""Structured Streaming forms of the monitors.

Every function maps a streaming DataFrame to a streaming DataFrame, except ``run_to_parquet`` which
starts one. Event time must be ``timestamp``; cast or declare it so when reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from modelvigil.functions.checks import Check
from modelvigil.functions.divergence import kl, psi
from modelvigil.operators.quality import validate_records
from modelvigil.presets import CLIP_EPSILON

#: The state store that keeps its keys on disk instead of the executor's heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Event time of the row that closes a bounded stream; later than any window that holds data.
END_OF_TIME = "2500-01-01T00:00:00Z"


def day_of(ts: Column, origin: str) -> Column:
    """Whole UTC days since ``origin``, whatever the session time zone."""
    days = F.floor(F.unix_seconds(ts) / 86_400)
    return (days - F.datediff(F.lit(origin).cast("date"), F.lit("1970-01-01").cast("date"))).cast("int")


def validated_stream(stream: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Issues and the blocked flag per record; stateless. Written with ``partitionBy("blocked")`` the clean
    and the quarantined records land in two folders of one exactly-once sink."""
    return validate_records(stream, checks)


def sliding_label_counts(
    stream: DataFrame, label: str, vocabulary: Sequence[str], ts: str = "ts", window: str = "7 days",
    slide: str = "1 day", delay: str = "1 day", by: Sequence[str] = (),
) -> DataFrame:
    """Label counts per sliding window, one stateful aggregation for the whole vocabulary."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(*by, F.window(ts, window, slide).alias("window"))
        .agg(
            F.count(label).alias("n_in_window"),
            *[F.count_if(F.col(label) == v).alias(f"_c{i}") for i, v in enumerate(vocabulary)],
        )
    )


def window_drift(
    counts: DataFrame, baseline: Sequence[float], by: Sequence[str] = (), epsilon: float = CLIP_EPSILON
) -> DataFrame:
    """PSI and KL of each window against a fixed baseline; a projection, so it streams too."""
    shares = F.array(*[
        F.coalesce(F.try_divide(F.col(f"_c{i}").cast("double"), F.col("n_in_window")), F.lit(0.0))
        for i in range(len(baseline))
    ])
    base = F.array(*[F.lit(float(p)) for p in baseline])
    return counts.select(
        *by, "window", "n_in_window", psi(base, shares, epsilon).alias("psi"), kl(base, shares, epsilon).alias("kl")
    )


def daily_partials(
    stream: DataFrame, sums: dict[str, Column], ts: str = "ts", delay: str = "1 day", by: Sequence[str] = ()
) -> DataFrame:
    """Daily partial aggregates. Trailing windows are summed when the daily table is read, which keeps one
    state entry per day instead of one per window."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(*by, F.window(ts, "1 day").alias("window"))
        .agg(*[c.alias(n) for n, c in sums.items()])
    )


def join_delayed_labels(
    predictions: DataFrame, labels: DataFrame, key: str = "event_id", ts: str = "ts", label_ts: str = "label_ts",
    within: str = "5 days", delay: str = "1 day",
) -> DataFrame:
    """Match predictions with the labels that arrive within an interval; the interval bounds the state."""
    left = predictions.withWatermark(ts, delay).alias("p")
    right = labels.withWatermark(label_ts, delay).withColumnRenamed(key, "_label_key").alias("l")
    return left.join(
        right,
        (F.col(key) == F.col("_label_key"))
        & (F.col(label_ts) >= F.col(ts))
        & (F.col(label_ts) <= F.col(ts) + F.expr(f"INTERVAL {within}")),
        "inner",
    ).drop("_label_key")


def label_surges(
    stream: DataFrame, label: str, shares: dict[str, float], ts: str = "ts", delay: str = "1 day"
) -> DataFrame:
    """``metric`` and ``day_ts`` of each day on which a label comes oftener than its share: the counts of a day in one
    stateful aggregation, put out when it is over. ``day_ts`` is an event time, so sessions may follow in one query."""
    sums = {"_n": F.count(F.lit(1)), **{f"_c{i}": F.count_if(F.col(label) == v) for i, v in enumerate(shares)}}
    daily = daily_partials(stream, sums, ts, delay)
    entries = F.array(*[
        F.struct(F.lit(v).alias("metric"), F.col(f"_c{i}").alias("n"), F.lit(float(p)).alias("share"))
        for i, (v, p) in enumerate(shares.items())
    ])
    labels = daily.select(F.window_time("window").alias("day_ts"), "_n", F.explode(entries).alias("_e"))
    above = (F.col("_e.n") > 0) & (F.col("_e.n").cast("double") / F.col("_n") > F.col("_e.share"))
    return labels.where(above).select("_e.metric", "day_ts")


def alert_sessions(
    alerts: DataFrame, ts: str = "day_ts", keys: Sequence[str] = ("metric",), delay: str | None = "0 days"
) -> DataFrame:
    """Consecutive alert days as sessions: neighbours 24 hours apart merge, 48 hours apart do not.

    Without ``delay`` the watermark is that of an aggregation before, which the sessions follow.
    """
    return (
        (alerts if delay is None else alerts.withWatermark(ts, delay))
        .groupBy(*keys, F.session_window(ts, "36 hours").alias("session"))
        .agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    )


def without_repeats(stream: DataFrame, key: str = "event_id", ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Drop records seen before within the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def run_to_parquet(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), trigger: dict | None = None
) -> StreamingQuery:
    """Start the stream into an exactly-once parquet sink; by default it takes what is there and stops."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def with_closing_rows(stream: DataFrame, folder: str, ts: str = "ts") -> DataFrame:
    """The stream together with a second source, a folder that stays empty until :func:`close_stream`."""
    spark = stream.sparkSession
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
    spark.createDataFrame([], schema).write.mode("append").parquet(folder)
    return stream.unionByName(spark.readStream.schema(schema).parquet(folder))


def close_stream(spark: SparkSession, folder: str, schema: T.StructType, ts: str = "ts") -> None:
    """Put one row, empty but for a far event time, behind a bounded stream.

    The next run of its query moves the watermark past every window and session that holds data, so that all of
    them come out; what follows is late.
    """
    end = spark.range(1).select(*[
        (F.lit(END_OF_TIME) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])
    end.write.mode("append").parquet(folder)


class UnseenBatches(RuntimeError):
    """Batches whose late rows nobody has counted."""


class LateRows:
    """Counts the rows that the stateful operators of a query leave out, over all its batches and restarts.

    A query remembers the progress of its last hundred batches only, so :meth:`watch` reads it while the query runs
    and adds each batch to a ledger in ``folder`` (one that lives as long as the checkpoint). Batches follow each
    other, so one that was missed, by a driver that died for instance, is a gap in the ledger: the count is then
    refused instead of being too small.
    """

    def __init__(self, spark: SparkSession, folder: str, every: float = 0.2, unwritten: int = 500):
        self.spark, self.folder, self.every, self.unwritten = spark, folder, every, unwritten
        self.dropped: dict[int, int] = {}
        self.fresh: dict[int, int] = {}
        spark.createDataFrame([], _LEDGER).write.mode("append").parquet(folder)
        for r in spark.read.schema(_LEDGER).parquet(folder).collect():  # a row a batch
            self.dropped[r.batch_id] = max(r.dropped, self.dropped.get(r.batch_id, 0))

    def _take(self, query: StreamingQuery) -> None:
        for p in query.recentProgress:
            n = sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])
            # A trigger without new data repeats the number of the batch to come.
            if n > self.dropped.get(p["batchId"], -1):
                self.dropped[p["batchId"]] = self.fresh[p["batchId"]] = n
        if len(self.fresh) >= self.unwritten:
            self._write()

    def _write(self) -> None:
        if self.fresh:
            self.spark.createDataFrame(list(self.fresh.items()), _LEDGER).coalesce(1).write.mode("append").parquet(self.folder)
            self.fresh = {}

    def watch(self, query: StreamingQuery) -> int:
        """Wait for the end of a run and return all rows dropped so far."""
        try:
            while not query.awaitTermination(self.every):
                self._take(query)
        finally:
            self._take(query)
            self._write()
        return self.total()

    def total(self) -> int:
        seen = sorted(self.dropped)
        if seen and seen[-1] != len(seen) - 1:
            missing = sorted(set(range(seen[-1])) - set(seen))
            raise UnseenBatches(f"late rows of {len(missing)} batches are unknown, the first is batch {missing[0]}")
        return sum(self.dropped.values())


_LEDGER = "batch_id long, dropped long"
