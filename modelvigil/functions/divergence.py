"""Distances between two label distributions held as arrays in vocabulary order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modelvigil.presets import CLIP_EPSILON, PSI_ALERT, PSI_WATCH


def _clip(p: Column, epsilon: float) -> Column:
    return F.transform(p, lambda x: F.greatest(x, F.lit(epsilon)))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def psi(baseline: Column, current: Column, epsilon: float = CLIP_EPSILON) -> Column:
    """Population stability index; both sides are clipped and not renormalised."""
    terms = F.zip_with(_clip(baseline, epsilon), _clip(current, epsilon), lambda b, c: (c - b) * F.ln(c / b))
    return _total(terms)


def kl(baseline: Column, current: Column, epsilon: float = CLIP_EPSILON) -> Column:
    """KL(current || baseline); both sides are clipped, then renormalised."""
    b, c = _clip(baseline, epsilon), _clip(current, epsilon)
    cross = _total(F.zip_with(b, c, lambda x, y: y * F.ln(y / x)))
    return cross / _total(c) - F.ln(_total(c) / _total(b))


def psi_band(value: Column, watch: float = PSI_WATCH, alert: float = PSI_ALERT) -> Column:
    return (
        F.when(value > alert, F.lit("significant"))
        .when(value >= watch, F.lit("moderate"))
        .when(value.isNotNull(), F.lit("none"))
    )
