"""Timestamp range predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.schema import EVENT_DATE


def utc_day(timestamp: Column) -> Column:
    """The UTC date of a timestamp, whatever the session time zone."""
    micros, day = F.unix_micros(timestamp), F.lit(86_400_000_000)
    return F.date_from_unix_date(((micros - F.pmod(micros, day)) / day).cast("int"))


def filter_range(events: DataFrame, start, end, closed: str = "day", column: str = "timestamp") -> DataFrame:
    """Keep events between ``start`` and ``end`` (strings, dates or datetimes).

    ``closed="day"`` covers every whole day from ``start`` to ``end``;
    ``closed="both"`` compares with the bare values, so ``end="2024-01-10"`` ends at
    its midnight.
    """
    first, last = _bounds(start, end, closed)
    value = F.col(column)
    if closed == "day":
        kept = events.filter((value >= first) & (value < F.date_add(_day(end), 1).cast("timestamp")))
    else:
        kept = events.filter(value.between(first, last))
    if EVENT_DATE in events.columns:
        # prunes date folders, which are the UTC days between the two bounds
        kept = kept.filter(F.col(EVENT_DATE).between(utc_day(first), utc_day(last)))
    return kept


def _bounds(start, end, closed: str) -> tuple[Column, Column]:
    """The first and the last instant of a range, both included."""
    if closed == "day":
        after = F.unix_micros(F.date_add(_day(end), 1).cast("timestamp"))
        return _day(start).cast("timestamp"), F.timestamp_micros(after - 1)
    if closed == "both":
        return F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    raise ValueError(f"closed must be 'day' or 'both', not {closed!r}")


def _day(value) -> Column:
    return F.to_date(F.lit(value).cast("timestamp"))
