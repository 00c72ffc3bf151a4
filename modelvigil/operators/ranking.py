"""Exact ranks and order statistics without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelvigil.functions.draws import shuffle_hash
from modelvigil.operators.joins import join_group_rows
from modelvigil.session import materialise

# Hash prefixes split any key evenly; 16**4 of them is also the bound on the offset table.
PREFIX_DIGITS = 4
# The default of spark.sql.optimizer.windowGroupLimitThreshold.
GROUP_LIMIT = 1000
SUBGROUPS = 256
# Equal parts of a percentile bracket.
BINS = 4_096


def bucket_offsets(buckets: DataFrame) -> DataFrame:
    """Rows that come before each bucket. One row per hash prefix, so the global window is bounded."""
    everything = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return buckets.select(
        "_bucket",
        "_n",
        (F.sum("_n").over(everything) - F.col("_n")).alias("_before"),
    )


def with_shuffle_position(
    df: DataFrame, key: str, seed: int, position: str = "position", prefix_digits: int = PREFIX_DIGITS
) -> DataFrame:
    """Zero-based position of every row in the order of ``md5(seed || key)``; ``key`` is a row id.

    Rows are ranked inside hash-prefix buckets of about equal size and shifted by the counts of the
    buckets before.
    """
    hashed = df.withColumn("_hash", shuffle_hash(F.col(key), seed))
    bucketed = hashed.withColumn("_bucket", F.substring("_hash", 1, prefix_digits))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = bucket_offsets(counts).drop("_n")
    inside = Window.partitionBy("_bucket").orderBy("_hash", key)
    return (
        bucketed.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(position, F.col("_before") + F.col("_rank") - 1)
        .drop("_hash", "_bucket", "_rank", "_before")
    )


def with_order_position(df: DataFrame, order: Sequence[Column | str], position: str = "position") -> DataFrame:
    """Zero-based position of every row in any order that no two rows share.

    Rows are dealt by ranges of the order, ranked inside their range and shifted by the counts of the ranges before;
    the one window over all of them sees a row a range. The dealt rows are computed once.
    """
    dealt = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(everything), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = dealt.withColumn("_rank", rank).join(F.broadcast(offsets), "_range")
    return placed.withColumn(position, F.col("_before") + F.col("_rank") - 1).drop("_range", "_rank", "_before")


def first_per_group(
    df: DataFrame, n: int, order: Column | str | Sequence[Column | str], by: Sequence[str] = (),
    spread: str | None = None, place: str = "place",
) -> DataFrame:
    """The first ``n`` rows of each group with their one-based place.

    Spark cuts a rank filter on the map side only up to ``GROUP_LIMIT`` rows per group. Beyond that the
    rows are first cut inside hashed parts of every group, so no task ever ranks a whole group.
    ``spread`` is the column hashed for it; by default the order column.
    """
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    keys = list(by) or [F.lit(0)]
    if n > GROUP_LIMIT:
        part = F.pmod(F.xxhash64(spread or order[-1]), F.lit(SUBGROUPS))
        inner = Window.partitionBy(*keys, "_part").orderBy(*order)
        df = df.withColumn("_part", part).withColumn("_nth", F.row_number().over(inner))
        df = df.where(F.col("_nth") <= n).drop("_part", "_nth")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(place, nth).where(F.col(place) <= n)


def hash_shuffle(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in a reproducible random order."""
    return df.withColumn("_hash", shuffle_hash(F.col(key), seed)).orderBy("_hash", key).drop("_hash")


def index_percentiles(
    df: DataFrame,
    value: str,
    shares: Sequence[float],
    by: Sequence[str] = (),
    row_key: str = "ex_id",
    accuracy: int = 10_000,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Exact ``sorted(values)[min(int(n * share), n - 1)]`` per group and share, in long form.

    A quantile sketch first brackets each wanted rank; its error is at most ``n / accuracy`` ranks. A
    second pass counts the rows below the bracket and in ``BINS`` equal bins of it, and a third ranks only the
    distinct values of the one bin that holds the rank. Should a bracket ever miss its rank the job fails
    instead of answering wrongly.
    """
    shares = [float(p) for p in shares]
    margin = 3.0 / accuracy
    points = [q for p in shares for q in (max(0.0, p - margin), min(1.0, p + margin))]
    rows = df.where(F.col(value).isNotNull())
    marks = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx(value, points, accuracy).alias("_marks"),
    )
    brackets = marks.select(
        *by,
        F.array(*[
            F.struct(
                F.lit(p).alias("share"),
                F.least(F.floor(F.col("_n") * F.lit(p)), F.col("_n") - 1).alias("index"),
                F.element_at("_marks", 2 * i + 1).alias("lo"),
                F.element_at("_marks", 2 * i + 2).alias("hi"),
            )
            for i, p in enumerate(shares)
        ]).alias("_brackets"),
    )
    narrow = rows.select(*by, value, *([row_key] if by and row_key not in by else []))
    if by:
        extra = {} if broadcast_rows is None else {"broadcast_rows": broadcast_rows}
        marked = join_group_rows(narrow, brackets, by, row_key, **extra)
    else:
        marked = narrow.withColumn("_brackets", brackets.select("_brackets").scalar())
    place = marked.select(*by, F.col(value).alias("_v"), F.explode("_brackets").alias("_b")).where(F.col("_v") <= F.col("_b.hi"))
    # Rows below a bracket and rows of one bin fold together already on the map side.
    bins = place.groupBy(*by, F.col("_b.share").alias("share"), "_b", _bin().alias("_bin")).agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(*by, "share").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    holds = F.col("_through") > F.col("_b.index")
    chosen = (
        bins.withColumn("_through", F.sum("_c").over(running))
        .groupBy(*by, "share")
        .agg(
            F.first("_b").alias("_b"),
            F.min(F.when(holds, F.struct("_bin", (F.col("_through") - F.col("_c")).alias("before")))).alias("_at"),
        )
    )
    missed = F.col("_at").isNull() | (F.col("_at._bin") < 0)
    at = F.when(missed, F.raise_error("percentile bracket missed its rank").cast("int")).otherwise(F.col("_at._bin"))
    cells = chosen.groupBy(*by).agg(
        F.collect_list(F.struct("share", "_b.index", "_b.lo", "_b.hi", at.alias("bin"), F.col("_at.before").alias("before"))).alias("_brackets")
    )
    if by:
        inside = join_group_rows(narrow, cells, by, row_key, **extra)
    else:
        inside = narrow.withColumn("_brackets", cells.select("_brackets").scalar())
    inside = inside.select(*by, F.col(value).alias("_v"), F.explode("_brackets").alias("_b"))
    inside = inside.where((F.col("_v") <= F.col("_b.hi")) & (_bin() == F.col("_b.bin")))
    counts = inside.groupBy(*by, F.col("_b.share").alias("share"), "_b", "_v").agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(*by, "share").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    through = F.sum("_c").over(running) + F.col("_b.before")
    return (
        counts.withColumn("_through", through)
        .where(holds)
        .groupBy(*by, "share")
        .agg(F.min("_v").alias("value"))
    )


def _bin() -> Column:
    """Bin of ``_v`` in its bracket ``_b``, from 0; -1 below it."""
    share = F.try_divide(F.col("_v").cast("double") - F.col("_b.lo"), F.col("_b.hi").cast("double") - F.col("_b.lo"))
    inside = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BINS), F.lit(BINS - 1)).cast("int")
    return F.when(F.col("_v") < F.col("_b.lo"), F.lit(-1)).otherwise(inside)
