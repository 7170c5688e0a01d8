"""State that micro-batches leave behind, one folder per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.sinks.commits import exists


class BatchStore:
    """Small keyed state (table positions, consumer progress), saved whole per batch.

    Reading what held before a batch makes a replayed batch give the same result again.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark = spark
        self.path = path
        self.schema = schema

    def _all(self) -> DataFrame | None:
        if not exists(self.spark, self.path):
            return None
        return self.spark.read.schema(f"{self.schema}, batch BIGINT").parquet(self.path)

    def before(self, batch: int | None = None) -> DataFrame | None:
        """State after the last batch, or after the last one before `batch`."""
        saved = self._all()
        if saved is None:
            return None
        if batch is not None:
            saved = saved.where(F.col("batch") < batch)
        last = saved.agg(F.max("batch")).first()[0]
        return None if last is None else saved.where(F.col("batch") == last).drop("batch")

    def save(self, batch: int, state: DataFrame) -> None:
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")


def drain(query: StreamingQuery) -> None:
    """Wait until everything available is processed, then stop."""
    try:
        query.awaitTermination()
    finally:
        query.stop()
