"""Text forms of log positions and resume tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIRE = "STRUCT<`$timestamp`: STRUCT<t: BIGINT, i: INT>>"
_CLUSTER = r"^Timestamp\((\d+),\s*(\d+)\)$"
_OBJECT = "STRUCT<`$timestamp`: STRUCT<t: BIGINT, i: INT>, time: BIGINT, inc: INT>"

# Token fields that stay text; all other fields are integers.
TEXT_TOKENS = ("log_file", "auto_position", "_data")


def _position(time: Column, inc: Column) -> Column:
    made = F.struct(time.cast("bigint").alias("time"), inc.cast("int").alias("inc"))
    return F.when(time.isNotNull() & inc.isNotNull(), made)


def position_to_json(time: Column, inc: Column) -> Column:
    """`{"$timestamp":{"t":…,"i":…}}`, the stored form of a position."""
    inner = F.struct(time.cast("bigint").alias("t"), inc.cast("int").alias("i"))
    return F.to_json(F.struct(inner.alias("$timestamp")))


def position_from_json(text: Column) -> Column:
    """STRUCT<time, inc> of the stored form; anything else gives NULL."""
    wire = F.from_json(text, _WIRE)["$timestamp"]
    return _position(wire["t"], wire["i"])


def cluster_time(text: Column) -> Column:
    """STRUCT<time, inc> of a change-stream time.

    Takes the driver text `Timestamp(t, i)`, the stored JSON form, and plain
    `{"time":…,"inc":…}` or `[t, i]` values.
    """
    driver_time = F.regexp_extract(text, _CLUSTER, 1).try_cast("bigint")
    driver_inc = F.regexp_extract(text, _CLUSTER, 2).try_cast("int")
    json = F.from_json(F.when(text.startswith("{"), text), _OBJECT)
    pair = F.from_json(F.when(text.startswith("["), text), "ARRAY<BIGINT>")
    return F.coalesce(
        _position(driver_time, driver_inc),
        _position(json["$timestamp"]["t"], json["$timestamp"]["i"]),
        _position(json["time"], json["inc"]),
        _position(F.try_element_at(pair, F.lit(1)), F.try_element_at(pair, F.lit(2))),
    )


def decode_token(key: Column, value: Column) -> Column:
    """STRUCT<text, number>: the typed value of one stored token field."""
    is_text = key.isin(*TEXT_TOKENS)
    return F.struct(
        F.when(is_text, value.cast("string")).alias("text"),
        F.when(~is_text, value.cast("string").try_cast("bigint")).alias("number"),
    )
