"""Publish-time and storage-time windows.

``as_of`` is the day (or moment) a job runs for. None means now; a given value makes a run repeatable
and lets a caller backfill.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = dt.date | dt.datetime | None

# Stored stamps run seven hours ahead; posts from two days back to tomorrow are taken.
STORED_SHIFT_HOURS = 7
DAYS_BACK = 2
DAYS_AHEAD = 1


def _shift() -> Column:
    return F.expr(f"interval {STORED_SHIFT_HOURS} hours")


def as_of_day(as_of: AsOf = None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(as_of.date() if isinstance(as_of, dt.datetime) else as_of)


def as_of_moment(as_of: AsOf = None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    text = as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else as_of.isoformat()
    return F.lit(text).cast("timestamp")


def stored_stamp(as_of: AsOf = None) -> Column:
    """Created/updated stamp of a stored row."""
    return as_of_moment(as_of) + _shift()


def in_publish_window(epoch: Column, as_of: AsOf = None) -> Column:
    """Epoch seconds between midnight two days back and midnight tomorrow, both ends included.

    The bounds fold to literals, so the comparison reaches the scan.
    """
    day = as_of_day(as_of)
    return epoch.between(
        F.unix_timestamp(F.date_sub(day, DAYS_BACK).cast("timestamp")),
        F.unix_timestamp(F.date_add(day, DAYS_AHEAD).cast("timestamp")),
    )


def stored_on(df: DataFrame, column: str, as_of: AsOf = None) -> DataFrame:
    """Rows whose stored stamp, with the shift undone, falls on the day.

    The shift is moved from the column to the two bounds, and the bounds take the column's own type,
    so the scan can prune on the raw column.
    """
    kind = df.schema[column].dataType
    day = as_of_day(as_of)
    start = (day.cast("timestamp") + _shift()).cast(kind)
    end = (F.date_add(day, 1).cast("timestamp") + _shift()).cast(kind)
    return df.filter((F.col(column) >= start) & (F.col(column) < end))


def minute_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")
