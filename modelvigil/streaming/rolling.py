"""Trailing windows of a stream from state of their own: one entry a key, and timers for days without traffic."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from modelvigil.operators.timeseries import LONGEST_GAP
from modelvigil.presets import ROLLING_DAYS
from modelvigil.streaming.monitors import daily_partials

DAY_MS = 86_400_000


class TrailingDays(StatefulProcessor):
    """Sums of the last ``window`` days of each key, a row for every day from the first one seen.

    The state is the last day put out and the counts of the days behind it. A day comes out when its own row arrives,
    with the silent days before it, or by a timer at its end, so a key without traffic goes on until its window is
    empty. When traffic returns after that, the days between come out too; a gap above ``longest_gap`` days fails.
    """

    def __init__(self, measures: Sequence[str], origin: dt.date, window: int, longest_gap: int = LONGEST_GAP):
        self.measures, self.window, self.longest_gap = list(measures), window, longest_gap
        self.origin_ms = (origin - dt.date(1970, 1, 1)).days * DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "day int, counts array<bigint>")

    def close(self) -> None:
        pass

    def _load(self) -> tuple[int | None, np.ndarray]:
        counts = np.zeros((self.window, len(self.measures)), dtype=np.int64)
        if not self.kept.exists():
            return None, counts
        day, flat = self.kept.get()
        return day, np.array(flat, dtype=np.int64).reshape(counts.shape)

    def _store(self, day: int, counts: np.ndarray) -> None:
        self.kept.update((day, counts.ravel().tolist()))
        if counts.any():
            self.handle.registerTimer(self.origin_ms + (day + 2) * DAY_MS - 1)  # the end of the next day

    @staticmethod
    def _rolled(counts: np.ndarray, today: np.ndarray | int) -> np.ndarray:
        counts = np.roll(counts, -1, axis=0)
        counts[-1] = today
        return counts

    def _rows(self, key: tuple, days: list[int], sums: list[np.ndarray]) -> pd.DataFrame:
        table = pd.DataFrame(np.array(sums, dtype=np.int64).reshape(-1, len(self.measures)), columns=self.measures)
        table.insert(0, "day", pd.array(days, dtype="int32"))
        table.insert(0, "key", key[0])
        return table

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, counts = self._load()
        days, sums = [], []
        table = pd.concat(list(rows)).sort_values("day")
        for own, today in zip(table["day"].tolist(), table[self.measures].to_numpy(dtype=np.int64)):
            if last is not None and own - last > self.longest_gap:
                raise ValueError(f"gap of days before day {own}; a stray date")
            for day in range(own if last is None else last + 1, own + 1):
                counts = self._rolled(counts, today if day == own else 0)
                days.append(day)
                sums.append(counts.sum(axis=0))
            last = own
        self._store(last, counts)
        yield self._rows(key, days, sums)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, counts = self._load()
        if last is None or expiredTimerInfo.getExpiryTimeInMs() != self.origin_ms + (last + 2) * DAY_MS - 1:
            return  # the day has come out with a row of its own
        days, sums = [], []
        # The watermark may have passed several days at once.
        while counts.any() and self.origin_ms + (last + 2) * DAY_MS <= timerValues.getCurrentWatermarkInMs() + 1:
            last, counts = last + 1, self._rolled(counts, 0)
            days.append(last)
            sums.append(counts.sum(axis=0))
        self._store(last, counts)
        yield self._rows(key, days, sums)


def trailing_label_counts(
    stream: DataFrame, label: str, vocabulary: Sequence[str], origin: str, key: str, ts: str = "ts",
    window: int = ROLLING_DAYS, delay: str = "1 day",
) -> DataFrame:
    """``key``, ``day``, ``n_in_window`` and the label counts ``c0`` ... over the trailing ``window`` days.

    Rows are reduced to one a key and day first, so a row is counted in one window, not in ``window`` of them, and the
    state that rolls sees a row a day, however hot the key. Appended once a day is over, for silent days too.
    """
    sums = {"n_in_window": F.count(label), **{f"c{i}": F.count_if(F.col(label) == v) for i, v in enumerate(vocabulary)}}
    daily = daily_partials(stream, sums, ts, delay, by=[key])
    since = F.datediff(F.lit(origin).cast("date"), F.lit("1970-01-01").cast("date"))
    rows = daily.select(
        F.col(key).alias("key"), F.window_time("window").alias("ends"),
        (F.floor(F.unix_seconds(F.col("window.start")) / 86_400) - since).cast("int").alias("day"), *sums,
    )
    measures = list(sums)
    schema = "key string, day int, " + ", ".join(f"{m} bigint" for m in measures)
    rolled = rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=TrailingDays(measures, dt.date.fromisoformat(origin), window), outputStructType=schema,
        outputMode="Append", timeMode="EventTime",
    )
    return rolled.withColumnRenamed("key", key)
