"""Parsing, formatting and arithmetic on times."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F, types as T

from curbair.schemas import STAMP


# forms with slashes, month first
SLASHED = ["M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "yyyy/M/d H:mm:ss"]


def lenient_time(text: Column, kind: str = "timestamp_ntz") -> Column:
    """Any ISO form, a 14-digit stamp or a form with slashes; NULL for everything else.

    A failed attempt is costly, so the other forms are tried by their looks only.
    """

    def parsed(fmt: str) -> Column:
        return F.try_to_timestamp(text, F.lit(fmt)).cast(kind)

    return F.coalesce(
        text.try_cast(kind),
        F.when(text.rlike(r"^\d{14}$"), parsed(STAMP)),
        F.when(text.rlike(r"^\d+/\d+/\d+"), F.coalesce(*[parsed(f) for f in SLASHED])),
    )


def strict_time(text: Column, kind: str = "timestamp_ntz", fmt: str = STAMP) -> Column:
    """Parse ``text`` by ``fmt``; a malformed value fails the job (ANSI mode)."""
    if kind == "timestamp_ntz":
        return F.to_timestamp_ntz(text, F.lit(fmt))
    return F.to_timestamp(text, fmt)


def as_time(column: Column, data_type: T.DataType, kind: str) -> Column:
    """``column`` as a time: parsed if text, untouched if already of that kind."""
    if isinstance(data_type, T.StringType):
        return lenient_time(column, kind)
    if data_type.simpleString() == kind:
        return column
    return column.cast(kind)


def stamp(column: Column) -> Column:
    """Interchange text ``yyyyMMddHHmmss``; sub-seconds are cut."""
    return F.date_format(column, STAMP)


def floor_hour(column: Column, data_type: T.DataType) -> Column:
    """Start of the hour, in the same time type as the input.

    ``date_trunc`` always yields a zoned timestamp, so zone-less values are cut
    by calendar parts instead of being pushed through the session zone.
    """
    if isinstance(data_type, T.TimestampNTZType):
        midnight = F.to_date(column).cast("timestamp_ntz")
        return midnight + F.make_dt_interval(hours=F.hour(column))
    return F.date_trunc("hour", column)


def month_start(column: Column) -> Column:
    return F.trunc(column, "month")


def add_minutes(column: Column, minutes: Column) -> Column:
    return column + F.make_dt_interval(mins=minutes.cast("int"))


def utc_bound(value: str | datetime | None) -> datetime | None:
    """A range bound given by the caller; None when it does not parse."""
    if isinstance(value, str):
        try:
            value = datetime.fromisoformat(value.strip())
        except ValueError:
            return None
    if value is None:
        return None
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def bound_literal(value: datetime, data_type: T.DataType) -> Column:
    """A UTC bound as a literal of the compared column's own type.

    Same-type literals keep the comparison free of casts on the column side, so
    that it reaches the file scan.
    """
    text = value.astimezone(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(data_type, T.DateType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(f"{text}+00:00").cast("timestamp")
