"""Value, key and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridtally import config


def as_int(text: Column) -> Column:
    return text.try_cast("int")


def as_double(text: Column) -> Column:
    return text.try_cast("double")


def scale_value(value: Column, flag: Column, multiplier: Column) -> Column:
    """Value times multiplier where the flag is ``Y``; a missing multiplier gives NULL."""
    return F.when(flag == "Y", as_double(value) * as_double(multiplier)).otherwise(
        as_double(value)
    )


def compose_key(parts: list[Column], separator: str = "-") -> Column:
    """The parts joined by the separator, or NULL if any part is NULL."""
    spaced = [parts[0]]
    for part in parts[1:]:
        spaced += [F.lit(separator), part]
    return F.concat(*spaced)


def joined_text(parts: list[Column]) -> Column:
    """The parts put together, with NULL parts left out."""
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def register_name(template: Column, minutes: Column) -> Column:
    """The register template with the interval length filled in."""
    return F.replace(template, F.lit(config.LENGTH_PLACEHOLDER), minutes)


def or_unknown(value: Column) -> Column:
    return F.coalesce(value, F.lit(config.UNKNOWN))


def clean_unit(text: Column) -> Column:
    return F.lower(F.trim(text))


def meter_bucket(serial: Column) -> Column:
    """The last two characters of the trimmed serial number."""
    return F.substring(F.trim(serial), -2, 2)


def authority(premise: Column) -> Column:
    return F.substring(premise, 1, 2)


def usage_date(start: Column) -> Column:
    return F.substring(start, 1, 10)


def null_text() -> Column:
    return F.lit(None).cast("string")
