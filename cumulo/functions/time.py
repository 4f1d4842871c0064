"""Time expressions. Instants are UTC; stored dates and times are ISO text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from cumulo.schemas import DAILY_INTERVALS

# Text formats and the seconds of the bucket rules.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
MINUTE, HOUR, DAY = 60, 3600, 86400


def iso_utc(ts: Column) -> Column:
    """UTC ISO text of an instant, '' when there is none."""
    return F.coalesce(F.date_format(ts, ISO_FORMAT), F.lit(""))


def bucket_seconds(ts: Column, period: Column, interval: Column) -> Column:
    """Epoch seconds of the bucket a point falls into.

    All rules come down to a step length counted from UTC midnight, so buckets restart every
    day even when the period does not divide one.
    """
    period = F.coalesce(period.cast("long"), F.lit(0))
    label = F.upper(F.trim(F.coalesce(interval, F.lit(""))))
    step = (
        F.when(label.isin(*DAILY_INTERVALS) | (period >= DAY), DAY)
        .when(period <= 0, HOUR)
        .when(period < MINUTE, MINUTE)
        .when(period % MINUTE != 0, 1)
        .otherwise(period)
    )
    seconds = F.unix_seconds(ts.cast("timestamp"))
    return seconds - F.pmod(seconds, F.lit(DAY)) % step


def bucket_text(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), ISO_FORMAT)


def hour_of(text: Column) -> Column:
    """Hour of a text timestamp, NULL if the text is malformed."""
    return F.hour(F.try_to_timestamp(text))


def month_of(text: Column) -> Column:
    """``yyyy-MM`` of a text date, NULL if the text is malformed."""
    return F.date_format(text.try_cast("date"), "yyyy-MM")


def since(date_text: Column, as_of: dt.date, window_days: int) -> Column:
    """The date lies at most ``window_days`` before ``as_of`` (inclusive).

    ISO dates sort as text, so the comparison of the bare column reaches the file statistics;
    the cast keeps out malformed text.
    """
    first = as_of - dt.timedelta(days=window_days)
    return (date_text >= first.isoformat()) & (date_text.try_cast("date") >= F.lit(first))


def within_window(ts: Column, as_of: dt.datetime, window_days: int) -> Column:
    """``as_of - window_days <= ts < as_of``."""
    start = as_of - dt.timedelta(days=window_days)
    return (ts >= F.lit(start)) & (ts < F.lit(as_of))


def six_places(value: Column) -> Column:
    return F.round(value.cast("double"), 6)
