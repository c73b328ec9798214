"""Rows of some dates, read from their date partitions where there are any."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def between_dates(rows: DataFrame, after: dt.date | None, until: dt.date) -> DataFrame:
    """Rows with ``after`` < event date <= ``until``; uses a date partition if there is one."""
    columns = ["event_ts"] + (["event_date"] if "event_date" in rows.columns else [])
    for name in columns:
        day = F.to_date(name)
        rows = rows.where(day <= F.lit(until))
        if after is not None:
            rows = rows.where(day > F.lit(after))
    return rows


def on_date(rows: DataFrame, date: dt.date) -> DataFrame:
    return between_dates(rows, date - dt.timedelta(days=1), date)
