"""Time expressions.  The session zone must be UTC (see ``session.use_utc``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MOSCOW = "Europe/Moscow"

# Text layout of an offset timestamp, e.g. 2025-12-04T10:09:13+0300.
SECONDS_LAYOUT = "yyyy-MM-dd'T'HH:mm:ss"


def utc_of_text(text: Column) -> Column:
    """Zone-less UTC time of an offset string; NULL when it cannot be read."""
    return text.try_cast("timestamp").cast("timestamp_ntz")


def wall_clock_of_text(text: Column) -> Column:
    """The local time written in an offset string, its offset ignored."""
    return text.try_cast("timestamp_ntz")


def offset_minutes_of_text(text: Column) -> Column:
    """Offset of the string in minutes, SMALLINT (wall clock minus UTC)."""
    return offset_minutes(utc_of_text(text), wall_clock_of_text(text))


def offset_minutes(utc: Column, wall: Column) -> Column:
    return F.timestamp_diff("MINUTE", utc, wall).cast("smallint")


def local_time(utc: Column, minutes: Column) -> Column:
    """Local time from UTC and an offset in minutes."""
    return utc + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0))


def in_zone(utc: Column, zone: str = MOSCOW) -> Column:
    """Zone-less local time in ``zone`` of a zone-less UTC time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def from_zone(wall: Column, zone: str = MOSCOW) -> Column:
    """Zone-less UTC time of a zone-less local time in ``zone``."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)


def zone_day(utc: Column, zone: str = MOSCOW) -> Column:
    """Calendar day in ``zone``, the unit of one daily run."""
    return F.to_date(in_zone(utc, zone))


def previous_day(logical_time: Column, zone: str = MOSCOW) -> tuple[Column, Column]:
    """Half-open UTC window of the calendar day before ``logical_time`` in ``zone``."""
    end = F.date_trunc("day", in_zone(logical_time, zone)).cast("timestamp_ntz")
    start = end - F.expr("interval 1 day")
    return from_zone(start, zone), from_zone(end, zone)


def iso_with_offset(utc: Column, zone: str = MOSCOW) -> Column:
    """ISO text with the numeric offset ``zone`` had at that instant."""
    wall = in_zone(utc, zone)
    minutes = offset_minutes(utc, wall).cast("int")
    sign = F.when(minutes < 0, "-").otherwise("+")
    size = F.abs(minutes)
    hhmm = F.lpad((F.floor(size / 60) * 100 + size % 60).cast("string"), 4, "0")
    return F.concat(F.date_format(wall, SECONDS_LAYOUT), sign, hhmm)


def parse_dump_time(text: Column, layout: str, zone: str = MOSCOW) -> Column:
    """Zone-less UTC time of dump text in ``layout``; NULL when it does not match.

    A layout with an offset gives an instant; one without is local time in ``zone``.
    """
    parsed = F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz")
    return parsed if "X" in layout else from_zone(parsed, zone)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a zone-less UTC time."""
    return F.unix_micros(ts.cast("timestamp"))


def of_micros(value: Column) -> Column:
    return F.timestamp_micros(value).cast("timestamp_ntz")


def seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.unix_seconds(ts.cast("timestamp"))


def of_seconds(value: Column) -> Column:
    return F.timestamp_seconds(value).cast("timestamp_ntz")
