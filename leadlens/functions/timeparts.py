"""UTC calendar helpers over microsecond epochs (session time zone is pinned to UTC)."""
from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros_of(ts: Column) -> Column:
    """Microsecond epoch of a timestamp, date or timestamp text."""
    return F.unix_micros(F.to_timestamp(ts))


def calendar_parts(micros: Column, prefix: str) -> list[Column]:
    """``<prefix>_day``, ``<prefix>_month``, ``<prefix>_year`` of a µs epoch (UTC)."""
    t = F.timestamp_micros(micros)
    return [F.dayofmonth(t).alias(f"{prefix}_day"), F.month(t).alias(f"{prefix}_month"),
            F.year(t).alias(f"{prefix}_year")]


def ymd_of_micros(micros: Column) -> Column:
    return F.date_format(F.timestamp_micros(micros), "yyyyMMdd")


def add_months_py(d: dt.date, months: int) -> dt.date:
    """Calendar month shift clamped to the month's last day (29 Feb − 1 year → 28 Feb)."""
    m = d.month - 1 + months
    y, m = d.year + m // 12, m % 12 + 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))
