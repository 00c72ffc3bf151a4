"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelvigil.operators.joins import join_group_rows
from modelvigil.operators.ranking import first_per_group

#: Learned models never see the rows whose ``crc32(doc_id as text) % FOLDS`` is ``HELD_OUT``.
FOLDS, HELD_OUT = 3, 1
#: Bytes of a batch that become Python values at a time; Spark's own batches may be several times as large.
SLICE_BYTES = 8_000_000


_STATE: dict[tuple, Any] = {}


def worker_state(path: str, make: Callable[[str], Any]) -> Any:
    """``make(path)``, kept by the worker process until another file or form of state is asked for.

    Workers live as long as the session and serve every query. There is one place for all files, and the tasks of
    other operators empty it, so a session that runs many queries needs no more memory than its largest one.
    """
    key = (make, path, os.stat(path).st_mtime_ns)
    if key not in _STATE:
        _STATE.clear()
        _STATE[key] = make(path)
    return _STATE[key]


def release_worker_memory() -> None:
    """Drop what earlier tasks of this worker process have left."""
    _STATE.clear()
    pa.default_memory_pool().release_unused()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the rows no model learns from; a row without an id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, some ``size`` bytes at a time, so that their Python values take little memory."""
    for batch in batches:
        step = max(1, batch.num_rows * size // max(batch.nbytes, 1))
        for a in range(0, batch.num_rows, step):
            yield batch.slice(a, step)


def map_columns(
    df: DataFrame, columns: list[str | Column], schema: str, work: Callable[[Iterator[dict]], Iterator[dict]],
    out: pa.Schema, stateful: bool = False,
) -> DataFrame:
    """Run ``work`` over the batches of the named columns as lists of Python values.

    Other columns of ``df`` are neither read nor sent. ``work`` gets an iterator of dicts column -> list and
    yields such dicts; at most a batch at a time is in memory. ``stateful``: it uses :func:`worker_state`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not stateful:
            release_worker_memory()

        def lists() -> Iterator[dict]:
            for batch in slices(batches):
                yield {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}

        for rows in work(lists()):
            yield pa.RecordBatch.from_pydict(rows, schema=out)

    return df.select(*columns).mapInArrow(run, schema)


def quoted(name: str) -> str:
    """A column name as it stands, whatever marks it holds."""
    return "`" + name.replace("`", "``") + "`"


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], stateful: bool = False
) -> DataFrame:
    """``df`` with its batches changed by ``work``, which keeps columns and types; column names may hold any mark."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not stateful:
            release_worker_memory()
        for batch in work(batch.rename_columns(names) for batch in slices(batches)):
            yield batch.rename_columns(plain)

    plain = [f"c{i}" for i in range(len(names))]
    numbered = df.toDF(*plain)
    return numbered.mapInArrow(run, numbered.schema).toDF(*names)


def crc(data: bytes | memoryview) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def smallest_hashes(ids: DataFrame, n: int, key: str = "doc_id", by: str | None = None) -> DataFrame:
    """At most ``n`` ids, of each ``by`` if given: those with the smallest hashes. A bounded, repeatable sample.

    Repeated rows are one. The ids are counted first and cut at the hash that about ``2 n`` of them stay below, so that no task ranks more,
    however many tasks or rows there are.
    """
    ids = ids.distinct()
    hashed = ids.withColumn("_hash", F.pmod(F.xxhash64(key), F.lit(1 << 40)) / F.lit(float(1 << 40)))
    if by is None:
        few = hashed.where(F.col("_hash") * max(ids.count(), 1) < 2 * n + 100)
    else:
        counts = ids.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
        few = join_group_rows(hashed, counts, [by], key).where(F.col("_hash") * F.col("_n") < 2 * n + 100).drop("_n")
    return first_per_group(few, n, ["_hash", key], [by] if by else []).drop("_hash", "place")
