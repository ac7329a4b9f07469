"""Timestamps: one clock per job, one normalising cast, one cutoff rule."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from snapstats.schemas import MONTH_COLUMN

AsOf = "str | dt.datetime | Column | None"


def parse_timestamp(text: Column) -> Column:
    """ISO text to a timestamp; a missing zone means UTC, unreadable text gives NULL.

    Going through `timestamp` keeps the zone of `...Z` and `...+02:00` spellings, which a direct cast
    to `timestamp_ntz` would drop.
    """
    return F.nullif(text, F.lit("")).try_cast("timestamp")


def moment(as_of: AsOf, like: T.DataType | None = None) -> Column:
    """The job's clock, typed like the column it will be compared with.

    Matching the type keeps the comparison free of a cast around the column, so the filter still
    reaches the parquet scan for `timestamp_ntz` as well as `timestamp` columns.
    """
    if as_of is None:
        clock = F.current_timestamp()
    elif isinstance(as_of, Column):
        clock = as_of
    elif isinstance(as_of, dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
        clock = F.lit(as_of.isoformat(sep=" "))
    else:
        clock = F.lit(as_of)
    if isinstance(like, T.TimestampNTZType):
        # Through `timestamp`, so that a spelled-out zone is honoured (session zone is UTC).
        return clock.cast("timestamp").cast("timestamp_ntz")
    return clock.cast("timestamp")


def moment_for(df: DataFrame, column: str, as_of: AsOf) -> Column:
    """`moment` typed like `df[column]`."""
    return moment(as_of, df.schema[column].dataType)


def days_before(clock: Column, days: int) -> Column:
    return clock - F.make_dt_interval(days=F.lit(days))


def hours_before(clock: Column, hours: Column | int) -> Column:
    hours = hours if isinstance(hours, Column) else F.lit(hours)
    return clock - F.make_dt_interval(hours=hours.cast("int"))


def since(df: DataFrame, column: str, as_of: AsOf, days: int) -> Column:
    """Predicate: `column` lies in the last `days` days before `as_of`, cutoff included.

    Where `df` carries the month it was fetched in, months before the cutoff are skipped as a whole: nothing is fetched
    before it is published, so this holds for publish dates as well.
    """
    cutoff = days_before(moment_for(df, column, as_of), days)
    recent = F.col(column) >= cutoff
    return recent & (F.col(MONTH_COLUMN) >= F.trunc(cutoff, "month")) if MONTH_COLUMN in df.columns else recent
