"""Digests under which rows, and keys, are equal as by `<=>`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

# Times in full, so that rows differing in microseconds only get different digests.
_EXACT = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def exact_digest(image: str, types: StructType, columns: list[str] | None = None) -> Column:
    """Digest of a struct column, or of some of its fields; NULL where the struct is.

    0.0 and -0.0 are the same, NULL fields count as values.
    """
    fields = []
    for name in columns or types.fieldNames():
        value, kind = F.col(image)[name], types[name].dataType
        if isinstance(kind, DoubleType | FloatType):
            value = F.when(value == 0, F.lit(0.0).cast(kind)).otherwise(value)
        fields.append(value.alias(name))
    same = F.when(F.col(image).isNotNull(), F.struct(*fields))
    return F.sha2(F.to_json(same, _EXACT), 256)
