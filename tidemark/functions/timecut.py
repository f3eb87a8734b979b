"""Time expressions. Nothing here reads the clock: `as_of` is always passed in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of_column(as_of: str | dt.datetime) -> Column:
    """A timestamp literal. Text and naive datetimes are taken as UTC."""
    moment = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return F.lit(moment.isoformat()).cast("timestamp")


def at_or_before(df: DataFrame, ts: str, as_of: str | dt.datetime) -> DataFrame:
    return df.where(F.col(ts) <= as_of_column(as_of))


def within(df: DataFrame, ts: str, as_of: str | dt.datetime, span: str) -> DataFrame:
    """Rows with `as_of - span <= ts <= as_of`, e.g. span = "24 HOURS".

    The bounds fold to literals, so they reach the Parquet scan. A column `dt`
    must be the UTC day of `ts`: a table stored by it is pruned to the days the
    span touches.
    """
    end = as_of_column(as_of)
    start = end - F.expr(f"INTERVAL {span}")
    cut = (F.col(ts) >= start) & (F.col(ts) <= end)
    if "dt" in df.columns:
        cut = cut & F.col("dt").between(F.to_date(start), F.to_date(end))
    return df.where(cut)


def slot(ts: Column, minutes: int) -> Column:
    """Start of the capture slot a time falls into (slots count from the epoch)."""
    seconds = F.unix_seconds(ts)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(minutes * 60)))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 UTC text with microseconds, as written to landing files."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def seconds_of(ts: Column) -> Column:
    """Seconds since the epoch, with the fraction, exact to the microsecond."""
    return F.unix_micros(ts) / F.lit(1_000_000)
