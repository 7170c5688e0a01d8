"""Messages that a stream could not apply, kept and counted per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.apply_rows import rejected_rows
from rivulet.operators.ordered import small
from rivulet.sinks.commits import exists

_WHERE = ["topic", "partition", "offset"]
_SCHEMA = "topic STRING, partition INT, offset BIGINT, target STRING, reason STRING, fields ARRAY<STRING>, value STRING"


def _found(rows: DataFrame, target: str | None, reason: F.Column, fields: F.Column) -> DataFrame:
    return rows.select(
        *(F.col(f"m_{c}").alias(c) for c in _WHERE), F.lit(target).cast("string").alias("target"),
        reason.alias("reason"), F.sort_array(fields).alias("fields"),
    )


def malformed(routed: DataFrame) -> DataFrame:
    """Messages without a type: no JSON, or none of an envelope."""
    none = F.array().cast("array<string>")
    return _found(routed.where("action = 'malformed'"), None, F.lit("malformed"), none)


def misfits(routed: DataFrame, columns: dict[str, str], keys: list[str], target: str | None) -> DataFrame:
    """Changes with values that do not fit: `bad_key` ones are left out by the replay,
    `bad_value` ones are applied with NULL in their place."""
    rows = rejected_rows(routed, columns)
    in_key = F.arrays_overlap("bad", F.array(*(F.lit(k) for k in keys)))
    reason = F.when(in_key, "bad_key").otherwise("bad_value")
    return _found(rows, target, reason, F.col("bad"))


class RejectStore:
    """Rejected messages of a stream: place, target, reason, fields and the text itself.

    A batch is one folder, written before its targets commit; a batch that is replayed
    writes the same folder again, so every message is in it once a target and reason.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def save(self, batch: int, messages: DataFrame, found: DataFrame) -> None:
        """`found` has no texts; `messages` is the batch, which is read for them once."""
        found = found.persist()
        try:
            texts = messages.select(*_WHERE, F.col("value").cast("string").alias("value"))
            kept = texts.join(small(found), _WHERE)
            columns = ["topic", "partition", "offset", "target", "reason", "fields", "value"]
            kept.select(*columns).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        finally:
            found.unpersist()

    def read(self) -> DataFrame:
        """All rejects, with their `batch`."""
        schema = f"{_SCHEMA}, batch BIGINT"
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def counts(self) -> DataFrame:
        """(batch, target, reason, messages)."""
        return self.read().groupBy("batch", "target", "reason").agg(F.count("*").alias("messages"))
