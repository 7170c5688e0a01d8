"""Date and time conversions on zone-less timestamps, independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zones and the epoch default used by change logs.
UTC = "UTC"
SHANGHAI = "Asia/Shanghai"
EPOCH_DAY = "1970-01-01"

_SECONDS = r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$"
_DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"


def parse_seconds(text: Column, day_only: bool = False) -> Column:
    """TIMESTAMP_NTZ from `2018-01-01 10:00:00`; what follows the first point is dropped.

    Bad or empty text gives NULL. With `day_only` the text is a bare date.
    """
    head = F.split_part(text, F.lit("."), F.lit(1))
    clean = F.regexp_replace(head, r"\s+", " ")
    pattern = _DAY if day_only else _SECONDS
    return F.when(head.rlike(pattern), clean.try_cast("timestamp_ntz"))


def parse_day(text: Column, day_only: bool = False) -> Column:
    """DATE from text, by the rule of `parse_seconds`."""
    return parse_seconds(text, day_only).cast("date")


def to_day(value: Column, is_text: bool = False, default: str | None = EPOCH_DAY) -> Column:
    """DATE of a timestamp or of text, with a default for NULL and bad text."""
    day = parse_day(value) if is_text else value.cast("date")
    return F.coalesce(day, F.lit(default).cast("date"))


def format_seconds(value: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss`, sub-second part dropped."""
    return F.substring(value.cast("timestamp_ntz").cast("string"), 1, 19)


def format_day(value: Column) -> Column:
    """`yyyy-MM-dd 00:00:00`, the form dates take in an envelope."""
    return F.concat(value.cast("date").cast("string"), F.lit(" 00:00:00"))


def with_zone(value: Column, zone: str = UTC) -> Column:
    """TIMESTAMP: the instant a zone-less value names in `zone`."""
    local = F.convert_timezone(F.lit(zone), F.current_timezone(), value.cast("timestamp_ntz"))
    return local.cast("timestamp")


def to_utc(value: Column, zone: str = SHANGHAI) -> Column:
    """Zone-less value read in `zone`, as the zone-less value in UTC."""
    return F.convert_timezone(F.lit(zone), F.lit(UTC), value.cast("timestamp_ntz"))


def to_shanghai(value: Column, zone: str = UTC) -> Column:
    """Zone-less value read in `zone`, as the zone-less value in Shanghai."""
    return F.convert_timezone(F.lit(zone), F.lit(SHANGHAI), value.cast("timestamp_ntz"))


def shift_to_shanghai(text: Column) -> Column:
    """UTC timestamp text as Shanghai timestamp text; bad text gives NULL."""
    return format_seconds(to_shanghai(parse_seconds(text)))
