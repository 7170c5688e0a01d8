"""Progress of readers and consumers as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.ordered import small


def consumer_progress(messages: DataFrame) -> DataFrame:
    """Next offset to read per topic and partition."""
    return messages.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset")
    )


def progress_tokens(progress: DataFrame) -> DataFrame:
    """(token, next_offset) with the token key `topic.partition`."""
    return progress.select(
        F.concat_ws(".", "topic", F.col("partition").cast("string")).alias("token"), "next_offset"
    )


def resume_after(messages: DataFrame, tokens: DataFrame) -> DataFrame:
    """Messages not yet consumed; a partition without a token starts at 0.

    `tokens` has one row per topic partition.
    """
    stored = tokens.select(
        F.col("token").alias("_token"), F.col("next_offset").alias("_next")
    )
    key = F.concat_ws(".", F.col("topic"), F.col("partition").cast("string"))
    joined = messages.join(small(stored), key == F.col("_token"), "left")
    return joined.where(F.col("offset") >= F.coalesce("_next", F.lit(0))).select(*messages.columns)


def starting_offsets(tokens: DataFrame) -> str:
    """The message source's `startingOffsets` JSON for stored tokens (one per partition)."""
    import json

    result: dict[str, dict[str, int]] = {}
    for row in tokens.toLocalIterator():
        topic, _, partition = row["token"].rpartition(".")
        result.setdefault(topic, {})[partition] = row["next_offset"]
    return json.dumps(result, sort_keys=True)


def table_position(
    rows: DataFrame, keys: list[str], seq: Column, ts: str = "ts", offset: str = "offset"
) -> DataFrame:
    """Last (time, inc) per table; the last row of an event has inc 0."""
    made = F.struct(
        F.col(ts).alias("time"), F.coalesce(F.col(offset), F.lit(0)).cast("int").alias("inc")
    )
    last = rows.groupBy(*keys).agg(F.max_by(made, seq).alias("_p"))
    return last.select(*keys, "_p.time", "_p.inc")


def document_position(log: DataFrame, keys: list[str], seq: Column) -> DataFrame:
    """Last cluster time per collection."""
    last = log.groupBy(*keys).agg(F.max_by("clusterTime", seq).alias("_p"))
    return last.select(*keys, "_p.time", "_p.inc")


def start_time(positions: DataFrame) -> DataFrame:
    """Where a reader without a token starts: the least position over all tables."""
    return positions.agg(F.min(F.struct("time", "inc")).alias("_p")).select("_p.time", "_p.inc")


def log_position(log: DataFrame, seq: str = "seq") -> DataFrame:
    """Highest log file seen, and the position of the last event."""
    return log.agg(
        F.max("log_file").alias("log_file"), F.max_by("log_pos", seq).alias("log_pos")
    )


def snapshot_counts(envelopes: DataFrame) -> DataFrame:
    """Rows per table in a snapshot."""
    inserts = envelopes.where(F.col("type") == "bootstrap-insert")
    return inserts.groupBy("database", "table").agg(F.count(F.lit(1)).alias("n_rows"))
