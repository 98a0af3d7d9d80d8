"""Time functions. They expect the session time zone to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_utc(text: Column) -> Column:
    """Export (``2018-02-20 10:44:42 UTC``) and API (``2019-07-18T20:25:12.394Z``) times alike."""
    return F.to_timestamp(text)


def api_time(text: Column) -> Column:
    """Export time written the way the API writes it, to the second."""
    return F.date_format(F.to_timestamp(text), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def whole_seconds(text: Column) -> Column:
    """The time that :func:`api_time` writes, without the way over its text."""
    return F.timestamp_seconds(F.unix_seconds(F.to_timestamp(text)))


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


def iso_year(ts: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), ts)


def week_key(ts: Column) -> Column:
    """ISO ``year-week`` without zero padding."""
    return F.concat(iso_year(ts).cast("string"), F.lit("-"), iso_week(ts).cast("string"))


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def elapsed(ts: Column, start: Column) -> Column:
    """Interval since ``start``."""
    return ts - start


def elapsed_days(ts: Column, start: Column, digits: int = 1) -> Column:
    micros = F.unix_micros(ts) - F.unix_micros(start)
    return F.round(micros / F.lit(86400e6), digits)


def bucket_start(ts: Column, seconds: int, anchor: int = 0) -> Column:
    """Start of the left-closed bucket of ``seconds`` that holds ``ts``; ``anchor`` shifts the grid (epoch seconds)."""
    whole = F.unix_seconds(ts) - F.lit(anchor)
    return F.timestamp_seconds(whole - F.pmod(whole, F.lit(seconds)) + F.lit(anchor))
