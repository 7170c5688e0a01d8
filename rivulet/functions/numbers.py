"""Text to number conversions that give a default instead of failing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number syntaxes accepted. Casting alone would accept more
# (`1.5d`) and less (`1_000`).
_INT = r"^\s*[+-]?\d+(_\d+)*\s*$"
_FLOAT = r"^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
_SPECIAL = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
_DIGITS = r"^[+\-\s]?\d+$"


_BLANKS = " \t\n\r\x0b\f"


def _bare(text: Column, dropped: str) -> Column:
    """Text without the given characters; blanks can only surround a number."""
    return F.translate(text, _BLANKS + dropped, "")


def _float(text: Column) -> Column:
    word = F.lower(_bare(text, "+"))
    special = (
        F.when(word.endswith("nan"), F.lit(float("nan")))
        .when(word.startswith("-"), F.lit(float("-inf")))
        .otherwise(F.lit(float("inf")))
    )
    return F.when(text.rlike(_FLOAT), _bare(text, "_").try_cast("double")).when(
        text.rlike(_SPECIAL), special
    )


def to_int(value: Column, default: int | None = None) -> Column:
    """BIGINT from text; surrounding blanks are fine, `2.0` and `` give the default."""
    text = value.cast("string")
    number = F.when(text.rlike(_INT), _bare(text, "_").try_cast("bigint"))
    return F.coalesce(number, F.lit(default).cast("bigint"))


def to_float(value: Column, default: float | None = None) -> Column:
    """DOUBLE from text, including `1e5`, `nan` and `inf`."""
    return F.coalesce(_float(value.cast("string")), F.lit(default).cast("double"))


def to_number(value: Column, default: float | None = None) -> Column:
    """STRUCT<is_int, int_value, value> from text.

    An optional sign and digits make an integer, a text with a point a float, and
    anything else (also `1e5` and NULL) the default. `int_value` keeps integers
    beyond 2**53 exact.
    """
    text = value.cast("string")
    is_int = F.coalesce(text.rlike(_DIGITS), F.lit(False))
    whole = _bare(text, "+")
    number = (
        F.when(is_int, whole.try_cast("double"))
        .when(text.contains("."), _float(text))
        .otherwise(F.lit(None).cast("double"))
    )
    return F.struct(
        is_int.alias("is_int"),
        F.when(is_int, whole.try_cast("decimal(38,0)")).alias("int_value"),
        F.coalesce(number, F.lit(default).cast("double")).alias("value"),
    )
