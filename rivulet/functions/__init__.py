"""Scalar Column -> Column functions, all evaluated inside the JVM."""

from rivulet.functions.dates import (
    format_day,
    format_seconds,
    parse_day,
    parse_seconds,
    shift_to_shanghai,
    to_day,
    to_shanghai,
    to_utc,
    with_zone,
)
from rivulet.functions.numbers import to_float, to_int, to_number
from rivulet.functions.positions import (
    cluster_time,
    decode_token,
    position_from_json,
    position_to_json,
)
from rivulet.functions.text import b64_decode, b64_encode, to_bytes, to_text

__all__ = [
    "b64_decode",
    "b64_encode",
    "cluster_time",
    "decode_token",
    "format_day",
    "format_seconds",
    "parse_day",
    "parse_seconds",
    "position_from_json",
    "position_to_json",
    "shift_to_shanghai",
    "to_bytes",
    "to_day",
    "to_float",
    "to_int",
    "to_number",
    "to_shanghai",
    "to_text",
    "to_utc",
    "with_zone",
]
