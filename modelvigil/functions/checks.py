"""Declarative record checks. A check is a condition plus the issue it reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from modelvigil.functions.text import is_blank
from modelvigil.presets import MIN_TEXT_LENGTH, PRIORITY_SENTINEL

BLOCKING = "blocking"
NON_BLOCKING = "non_blocking"
_NO_ISSUES = "array<struct<issue_type:string,severity:string,field:string,value:string>>"


@dataclass(frozen=True)
class Check:
    """What to report, and the condition as a function of the column, so that rules need no session."""

    issue_type: str
    severity: str
    field: str
    failed: Callable[[Column], Column]

    def issue(self) -> Column:
        return F.struct(
            F.lit(self.issue_type).alias("issue_type"),
            F.lit(self.severity).alias("severity"),
            F.lit(self.field).alias("field"),
            F.col(self.field).cast("string").alias("value"),
        )


def check_null_text(field: str, min_length: int = MIN_TEXT_LENGTH, issue_type: str = "null_or_empty_text") -> Check:
    return Check(issue_type, BLOCKING, field, lambda c: is_blank(c, min_length))


def check_sentinel(
    field: str, sentinel: str = PRIORITY_SENTINEL, issue_type: str = "silent_default_priority"
) -> Check:
    return Check(issue_type, NON_BLOCKING, field, lambda c: F.coalesce(c == sentinel, F.lit(False)))


def check_enum(
    field: str, allowed: Sequence[str], issue_type: str = "schema_violation_source_system"
) -> Check:
    return Check(issue_type, NON_BLOCKING, field, lambda c: c.isNotNull() & ~c.isin(*allowed))


def check_reference(field: str, known: str, issue_type: str = "unknown_reference_value") -> Check:
    """A value that its reference table lacks; ``known`` is the column in which
    :func:`modelvigil.operators.quality.with_reference` says whether the table has it. A null value is no violation."""
    return Check(issue_type, NON_BLOCKING, field, lambda c: c.isNotNull() & ~F.col(known))


def validate(checks: Sequence[Check]) -> Column:
    """Array of the issues a row has, in the order of ``checks``."""
    found = [
        F.when(c.failed(F.col(c.field)), F.array(c.issue())).otherwise(F.array()).cast(_NO_ISSUES)
        for c in checks
    ]
    return F.concat(*found)


def has_blocking(issues: Column) -> Column:
    return F.exists(issues, lambda i: i["severity"] == BLOCKING)


def issue_types(issues: Column) -> Column:
    return F.array_join(F.transform(issues, lambda i: i["issue_type"]), ",")
