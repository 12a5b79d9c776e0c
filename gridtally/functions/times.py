"""Time expressions on ISO-8601 strings that carry their own offset.

Wall-clock parts are handled as zone-free timestamps and instants as epoch
seconds, so no result depends on the session time zone. Unparseable input
gives NULL.
"""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridtally import config


def wall_time(text: Column) -> Column:
    """The first 19 characters as a zone-free timestamp."""
    head = F.substring(text, 1, 19)
    return F.when(F.length(head) == 19, head.try_cast("timestamp_ntz"))


def wall_date(text: Column) -> Column:
    """The first 10 characters as a date."""
    return F.substring(text, 1, 10).try_cast("date")


def offset(text: Column) -> Column:
    """The offset behind the wall time as ``±hh:mm``; NULL if there is none.

    ``Z``, ``±hh:mm`` and ``±hhmm`` are offsets, also behind a fraction of a second.
    """
    tail = F.regexp_extract(text, r"^.{19}(?:\.\d+)?(Z|[+-]\d\d:?\d\d)$", 1)
    compact = F.concat(F.substring(tail, 1, 3), F.lit(":"), F.substring(tail, -2, 2))
    return F.when(tail == "Z", F.lit("+00:00")).when(tail != "", compact)


def iso_wall(moment: Column) -> Column:
    """A zone-free timestamp as ``yyyy-MM-ddTHH:mm:ss``."""
    return F.replace(moment.cast("string"), F.lit(" "), F.lit("T"))


def minutes_before(moment: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", -minutes, moment)


def seconds_since_1970(wall: Column) -> Column:
    """Seconds between 1970-01-01 and a zone-free timestamp, counted without any zone."""
    days = F.unix_date(wall.cast("date")).cast("long")
    return days * 86400 + F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)


def offset_seconds(utc_offset: Column) -> Column:
    """Seconds of an offset such as ``-05:00``; NULL for any other text."""
    hours = F.substring(utc_offset, 2, 2).try_cast("int")
    minutes = F.substring(utc_offset, 5, 2).try_cast("int")
    size = F.when(F.substring(utc_offset, 4, 1) == ":", hours * 3600 + minutes * 60)
    sign = F.substring(utc_offset, 1, 1)
    return F.when(sign == "-", -size).when(sign == "+", size)


def epoch(wall: Column, utc_offset: Column) -> Column:
    """Epoch seconds of a wall-clock time and the offset that was sent with it."""
    return seconds_since_1970(wall) - offset_seconds(utc_offset)


def epoch_of(text: Column) -> Column:
    """Epoch seconds of an ISO string with offset."""
    return epoch(wall_time(text), offset(text))


def zone_epoch(wall: Column, zone: str) -> Column:
    """Epoch seconds of a wall-clock time in a named zone."""
    utc = wall if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    return seconds_since_1970(utc)


def epoch_text(seconds: Column) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` in UTC, whatever the session zone is."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds, start).cast("string")


def run_date(run_ts: datetime) -> str:
    return run_ts.strftime(config.RUN_DATE_FORMAT)


def batch_label(batch_end: datetime) -> str:
    return batch_end.strftime(config.BATCH_LABEL_FORMAT)


def batch_bound(text: str, zone: str) -> datetime:
    """A batch window bound: wall-clock text in the tenant's zone, as an instant."""
    return datetime.fromisoformat(text).replace(tzinfo=ZoneInfo(zone)).astimezone(timezone.utc)
