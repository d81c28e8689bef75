"""Calendar fields, run stamps and time parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabloom.functions.text import underscored

STAMP_FORMAT = "yyyyMMdd_HHmmss"

CALENDAR = {
    "year": F.year,
    "month": F.month,
    "dayofweek": F.weekday,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
}


def calendar_fields(ts: Column, names: tuple[str, ...] = tuple(CALENDAR)) -> list[Column]:
    """Calendar parts as integer columns; Monday is day 0."""
    return [CALENDAR[n](ts).alias(n) for n in names]


def is_weekend(ts: Column) -> Column:
    return F.coalesce(F.weekday(ts) >= 5, F.lit(False)).cast("int")


def timestamp_features(name: str, *, typed: bool = False) -> list[Column]:
    """Hour, day of week, month and a weekend flag for the named column; text that is no time gives nulls and no weekend.

    A column that is typed as a time already is not parsed again.
    """
    ts = F.col(f"`{name}`") if typed else parse_time(F.col(f"`{name}`"))
    prefix = underscored(name)
    parts = [c.alias(f"{prefix}_{p}") for p, c in zip(("hour", "dayofweek", "month"), (F.hour(ts), F.weekday(ts), F.month(ts)))]
    return [*parts, is_weekend(ts).alias(f"{prefix}_is_weekend")]


def parse_time(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"))


def parse_stamp(c: Column) -> Column:
    """Read yyyyMMdd_HHmmss; any other text gives null."""
    shaped = F.when(c.rlike(r"^\d{8}_\d{6}$"), c)
    return F.try_to_timestamp(shaped, F.lit(STAMP_FORMAT))


def format_stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP_FORMAT)


def format_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
