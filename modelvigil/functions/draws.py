"""Reproducible draws. Every random decision is a hash of a row key, so retries repeat it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def shuffle_hash(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), key.cast("string")))


def draw_int(key: Column, seed: int | str) -> Column:
    """Uniform integer in [0, 2**32)."""
    return F.conv(F.substring(shuffle_hash(key, seed), 1, 8), 16, 10).cast("bigint")


def draw(key: Column, seed: int | str) -> Column:
    """Uniform double in [0, 1)."""
    return draw_int(key, seed) / F.lit(4294967296.0)


def pick(values: Sequence[str], key: Column, seed: int | str) -> Column:
    """One of ``values``, each position equally likely."""
    at = (draw_int(key, seed) % len(values) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), at)
