"""Text and byte conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_text(value: Column) -> Column:
    """UTF-8 text of bytes, or the text form of anything else."""
    return value.cast("string")


def to_bytes(value: Column) -> Column:
    """UTF-8 bytes of text."""
    return F.encode(value.cast("string"), "UTF-8")


def b64_encode(value: Column) -> Column:
    """Base64 on one line (the built-in wraps long values)."""
    # Byte searches: `translate` looks every character up by itself.
    return F.replace(F.replace(F.base64(value), F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(""))


def b64_decode(text: Column) -> Column:
    """Bytes of base64 text. Foreign characters are skipped, broken padding gives NULL."""
    foreign = "[^A-Za-z0-9+/=]"
    # Replacing costs many times what searching does, also where there is nothing to replace.
    clean = F.when(text.rlike(foreign), F.regexp_replace(text, foreign, "")).otherwise(text)
    return F.when(F.length(clean) % 4 == 0, F.try_to_binary(clean, F.lit("base64")))
