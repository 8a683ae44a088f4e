"""UTC days, literals and payload text for timestamps."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, functions as F

_DAY_MICROS = 86_400_000_000
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# Fixed value: ISO-8601 in UTC with milliseconds.
PAYLOAD_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def utc_day(instant: Column) -> Column:
    """The UTC calendar day of an instant, whatever the session time zone. The day's start is found in
    integers: a double would round the last microseconds of a day into the next one."""
    micros = F.unix_micros(instant)
    start = micros - F.pmod(micros, F.lit(_DAY_MICROS))
    return F.date_from_unix_date((start / F.lit(_DAY_MICROS)).cast("int"))


def utc_month(instant: Column) -> Column:
    """First day of the UTC month of an instant."""
    return F.trunc(utc_day(instant), "month")


def as_utc(moment: datetime) -> datetime:
    """An aware UTC datetime; a naive one is taken as UTC."""
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def instant(moment: datetime) -> Column:
    """A TIMESTAMP literal that depends neither on the driver's nor on the session's time zone."""
    since = as_utc(moment) - _EPOCH
    return F.timestamp_micros(F.lit((since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds))


def day_of(moment: datetime) -> date:
    return as_utc(moment).date()
