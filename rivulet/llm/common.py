"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.util import stage

WORD = r"[^\x20\x09-\x0D]+"
_SPACE = " \t\n\x0b\x0c\r"
# Rows and bytes that a broadcast may have, as they are counted before it.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 100 << 20
# Text that a Python task works on at a time; one longer text is worked on as a whole.
PART_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text; a null text gives an empty array."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, r"[\x20\x09-\x0D]+", -1)
    )


def text_key(column: str) -> Column:
    """Digest that tells texts apart; a null text has that of the empty one."""
    return F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary"))


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """`docs` without the rows whose (doc_id, text_key) is in the staged frame `gone`."""
    return docs.alias("d").join(
        small(gone).alias("g"),
        F.col("d.doc_id").cast("long").eqNullSafe(F.col("g.doc_id"))
        & (text_key("d.text") == F.col("g.text_key")),
        "left_anti",
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also when `body` reads it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def width(df: DataFrame) -> Column:
    """Bytes of a row: a word a column, and the contents of texts and nested values."""
    size = F.lit(8 * (1 + len(df.columns))).cast("long")
    for field in df.schema:
        kind, value = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, T.ArrayType | T.MapType | T.StructType):
            value = F.to_json(F.struct(value))
        elif not isinstance(kind, T.StringType | T.BinaryType):
            continue
        size = size + F.coalesce(F.octet_length(value), F.lit(0))
    return size


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """The frame with a broadcast hint if it has at most `rows` rows of together at most `size`
    bytes, else as it is.

    Give it a staged frame, whose rows are cheap to count and measure.
    """
    n, held = df.agg(F.count(F.lit(1)), F.sum(width(df))).first()
    return F.broadcast(df) if n <= rows and (held or 0) <= size else df


def parts(batch: pa.RecordBatch, size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most about `size` bytes of text, or with one text."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    upto, low = np.cumsum(lengths), 0
    while low < len(lengths):
        done = int(upto[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(upto, done + size, "right")))
        yield batch.slice(low, high - low)
        low = high


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str):
    """mapInArrow with a function from a part of a batch to a batch; `df` has `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(fn, parts(batch))

    return df.mapInArrow(run, schema)


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """The staged frame with `at`, a unique number that ascends in the order of columns.

    A range shuffle lays the rows out, so no key's rows need one task: rows that are equal
    in `order` are told apart by their place in `df`, which must be read from storage. `at`
    is the range partition's number times 2**33 plus the place in it.
    """
    keys = [*(F.col(c) for c in order), F.col("_tie")]
    told = df.withColumn("_tie", F.monotonically_increasing_id())
    sorted_ = told.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    return stage(sorted_.withColumn("at", F.monotonically_increasing_id()), "ordered")
