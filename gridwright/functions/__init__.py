"""Scalar column functions (E1-E7). All are built-in Spark expressions, so
they stay inside whole-stage code generation."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_parts(ts: str | Column) -> dict[str, Column]:
    """YEAR, MONTH and DAY of a timestamp (E1), in the session time zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}


def month_start(ts: str | Column) -> Column:
    """First day of the timestamp's month as a date."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.trunc(c, "month")


def run_date(as_of: _dt.date | str | None = None) -> Column:
    """The run-date stamp (E2): ``as_of`` when given (deterministic reruns
    and tests), else today's date in the session time zone."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def label_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Assign column labels positionally, e.g. from result metadata."""
    names = list(names)
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} labels for {len(df.columns)} columns")
    return df.toDF(*names)


__all__ = ["date_parts", "label_columns", "month_start", "run_date"]
