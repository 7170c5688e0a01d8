"""A snapshot taken chunk by chunk while the log of its table goes on.

A chunk is a range of the key. The log's position is noted before a chunk is read (low) and
after it (high). A row of a chunk whose key changed between the two may or may not show that
change, so it gives way to the log; every other row is exact as of `high`. Chunks need no
locks and no single moment, and a run that stops goes on with the first chunk not yet noted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.sinks.commits import exists, names
from rivulet.util import null_safe

_MARK = "low BIGINT, high BIGINT, chunk INT"


class ChunkedSnapshot:
    """A snapshot of a table under `path`, a folder that all executors share.

    `read` gives the table as it is now, `position` the number of the last change that the
    table shows. Both are asked again for each chunk. Changes up to `position` must be
    visible to a read that starts later. `key` is a numeric or time column; chunks are cut
    at its approximate quantiles, noted once so that a restart cuts alike. Rows whose key is
    NULL belong to the last chunk. An empty table has one empty chunk.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        read: Callable[[], DataFrame],
        position: Callable[[], int],
        chunks: int,
    ) -> None:
        if chunks < 1:
            raise ValueError("a snapshot needs at least one chunk")
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.read, self.position, self.chunks = read, position, chunks

    def _cuts(self) -> list:
        """Greatest keys of all chunks but the last, `chunks` - 1 of them at most."""
        place = f"{self.path}/cuts"
        if not exists(self.spark, f"{place}/_SUCCESS"):
            at = [k / self.chunks for k in range(1, self.chunks)]
            found = self.read().agg(
                (F.percentile_approx(self.key, at) if at else F.array()).alias("cut")
            )
            found = found.select(F.explode_outer(F.array_distinct("cut")).alias("cut"))
            found.where("cut is not null").coalesce(1).write.mode("overwrite").parquet(place)
        return sorted(r["cut"] for r in self.spark.read.parquet(place).collect())

    def _range(self, cuts: list, chunk: int) -> Column:
        key = F.col(self.key)
        if chunk == len(cuts):
            return key.isNull() | (key > F.lit(cuts[-1])) if cuts else F.lit(True)
        below = key <= F.lit(cuts[chunk])
        return below & (key > F.lit(cuts[chunk - 1])) if chunk else below

    def _noted(self) -> set[int]:
        found = names(self.spark, f"{self.path}/marks")
        return {
            int(n.partition("=")[2]) for n in found
            if n.startswith("chunk=") and exists(self.spark, f"{self.path}/marks/{n}/_SUCCESS")
        }

    def run(self, most: int | None = None) -> bool:
        """Take the chunks that are missing, `most` of them at most; true if all are there.

        A chunk counts once its positions are noted, after its rows; rows of a chunk that
        failed before are written again.
        """
        cuts, noted = self._cuts(), self._noted()
        missing = [k for k in range(len(cuts) + 1) if k not in noted]
        for chunk in missing[:most]:
            low = self.position()
            rows = self.read().where(self._range(cuts, chunk))
            held = rows.select(F.struct("*").alias("row"))
            held.write.mode("overwrite").parquet(f"{self.path}/rows/chunk={chunk}")
            high = self.position()
            if high < low:
                raise ValueError(f"the log's position went back, from {low} to {high}")
            mark = self.spark.range(1).select(
                F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high")
            )
            mark.write.mode("overwrite").parquet(f"{self.path}/marks/chunk={chunk}")
        return most is None or len(missing) <= most

    def marks(self) -> DataFrame:
        """(low, high, chunk) of the chunks that are there."""
        noted = sorted(self._noted())
        if not noted:
            return self.spark.createDataFrame([], _MARK)
        marks = self.spark.read.schema(_MARK).parquet(f"{self.path}/marks")
        return marks.where(F.col("chunk").isin(noted))

    def follow(self, changes: DataFrame) -> DataFrame:
        """Chunks and log as one change frame, for a keyed apply in replace modes.

        `changes` is (seq, op, row[, old]), numbered like `position`. A chunk's rows are
        inserts at its `high`, without those whose key the log touches, as old or new key,
        after `low` and up to `high`; the log follows from the least `low`. Of a key there
        is so at most one row at one number. Chunks that are missing are left out, and the
        changes of their keys are kept, so the result grows as chunks arrive.

        Rows and changes are shuffled by key once; the rows hold a key once, so a key with
        many changes is streamed past one row, and adaptive execution may split it.
        """
        noted = self._noted()
        if not noted:
            return changes.where(F.lit(False))
        marks = self.marks()
        first, last = marks.agg(F.min("low"), F.max("high")).first()
        columns = changes.schema["row"].dataType.names
        taken = self.spark.read.option("basePath", f"{self.path}/rows").parquet(
            *(f"{self.path}/rows/chunk={k}" for k in sorted(noted))
        )
        rows = taken.join(F.broadcast(marks), "chunk").select(
            F.col("high").alias("seq"),
            F.lit("insert").alias("op"),
            F.struct(*(F.col("row")[c].alias(c) for c in columns))
            .cast(changes.schema["row"].dataType).alias("row"),
            F.col("low").alias("_low"),
            F.col("row")[self.key].alias("_key"),
        )
        during = changes.where((F.col("seq") > first) & (F.col("seq") <= last))
        touched = during.select("seq", F.col("row")[self.key].alias("_key"))
        if "old" in changes.columns:
            moved = during.where(F.col("old").isNotNull())
            touched = touched.unionByName(moved.select("seq", F.col("old")[self.key].alias("_key")))
        windows = rows.select("_key", "_low", F.col("seq").alias("_high"))
        hit = null_safe(touched, windows, ["_key"]) & (touched["seq"] > windows["_low"])
        stale = (
            touched.join(windows, hit & (touched["seq"] <= windows["_high"]))
            .select(windows["_key"]).distinct()
        )
        exact = rows.join(stale, null_safe(rows, stale, ["_key"]), "left_anti")
        return exact.drop("_low", "_key").unionByName(
            changes.where(F.col("seq") > first), allowMissingColumns=True
        )
