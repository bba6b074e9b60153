"""Dashboard controls: filters on granular rows, applied before any aggregation."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidedesk.functions.contact import event_date, event_hour
from tidedesk.schema import DIMENSIONS


@dataclass(frozen=True)
class DashboardFilter:
    """Both dates are inclusive; an empty tuple means no restriction; ``cross`` is a clicked value."""

    start: date | None = None
    end: date | None = None
    channels: tuple[str, ...] = ()
    regions: tuple[str, ...] = ()
    cross: tuple[str, object] | None = None


def last_n_days(as_of: date, n: int, include_today: bool = False) -> DashboardFilter:
    """The ``n`` full days before ``as_of``, or the ``n`` days that end with it."""
    end = as_of if include_today else as_of - timedelta(days=1)
    return DashboardFilter(start=end - timedelta(days=n - 1), end=end)


def this_month(as_of: date) -> DashboardFilter:
    last = calendar.monthrange(as_of.year, as_of.month)[1]
    return DashboardFilter(start=as_of.replace(day=1), end=as_of.replace(day=last))


def apply_filters(rows: DataFrame, controls: DashboardFilter) -> DataFrame:
    """Keeps the rows that every control lets through.

    A date bound is put on the event instant, which Parquet statistics can skip by, and on ``fecha``
    where the rows carry it, since only that prunes partitions.
    """
    instant = F.col("timestamp_evento")
    partitioned = "fecha" in rows.columns
    if controls.start:
        rows = rows.where(instant >= F.lit(controls.start))
        if partitioned:
            rows = rows.where(F.col("fecha") >= F.lit(controls.start))
    if controls.end:
        rows = rows.where(instant < F.lit(controls.end + timedelta(days=1)))
        if partitioned:
            rows = rows.where(F.col("fecha") <= F.lit(controls.end))
    return _by_value(rows, controls)


def _by_value(rows: DataFrame, controls: DashboardFilter) -> DataFrame:
    if controls.channels:
        rows = rows.where(F.col("canal").isin(*controls.channels))
    if controls.regions:
        rows = rows.where(F.col("region").isin(*controls.regions))
    if controls.cross:
        rows = cross_filter(rows, *controls.cross)
    return rows


def filter_dimensions(rows: DataFrame, controls: DashboardFilter) -> DataFrame:
    """The same over rows that have the dimensions but no event instant, such as aggregates."""
    if controls.start:
        rows = rows.where(F.col("fecha") >= F.lit(controls.start))
    if controls.end:
        rows = rows.where(F.col("fecha") <= F.lit(controls.end))
    return _by_value(rows, controls)


def cross_filter(rows: DataFrame, dimension: str, value: object) -> DataFrame:
    """Rows of one clicked dimension value; a clicked "no value" keeps the NULL rows."""
    if dimension not in DIMENSIONS:
        raise ValueError(f"{dimension!r} is not a dimension; choose one of {', '.join(DIMENSIONS)}")
    if dimension == "fecha" and isinstance(value, date) and "timestamp_evento" in rows.columns:
        return apply_filters(rows, DashboardFilter(start=value, end=value))
    derived = {"fecha": event_date, "hora_del_dia": event_hour}
    column = derived[dimension]() if dimension in derived and dimension not in rows.columns else F.col(dimension)
    return rows.where(column.isNull() if value is None else column == F.lit(value))
