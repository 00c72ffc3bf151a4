"""Join of a large side with a per-group side whose size is checked, not assumed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelvigil.session import materialise

BROADCAST_ROWS = 100_000
#: Bytes of group keys that are broadcast at most; the other columns of a group are few and of fixed size.
BROADCAST_BYTES = 32 << 20
SALTS = 32


def join_group_rows(
    large: DataFrame,
    groups: DataFrame,
    by: Sequence[str],
    row_key: str,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Attach the one row per group in ``groups`` to every row of ``large``; keys may be null.

    ``groups`` is computed once and measured. Up to ``broadcast_rows`` and ``BROADCAST_BYTES`` it is broadcast. Beyond
    that it is repeated over ``salts`` and each large row joins the copy its ``row_key`` hashes to, so that one hot
    group spreads over that many partitions.
    """
    groups = materialise(groups)
    right = groups.select(*[F.col(k).alias(f"_g_{k}") for k in by], *[c for c in groups.columns if c not in by])
    on = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in by]
    right_keys = [f"_g_{k}" for k in by]
    key_bytes = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in by), F.lit(0))
    n, n_bytes = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum(key_bytes.cast("bigint")), F.lit(0))).first()
    if n <= broadcast_rows and n_bytes <= BROADCAST_BYTES:
        return large.join(F.broadcast(right), on, "inner").drop(*right_keys)
    right = right.withColumn("_g_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    left = large.withColumn("_salt", F.pmod(F.xxhash64(row_key), F.lit(salts)).cast("int"))
    joined = left.join(right, on + [F.col("_salt") == F.col("_g_salt")], "inner")
    return joined.drop("_salt", "_g_salt", *right_keys)
