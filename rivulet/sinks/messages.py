"""Message-log sinks for batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# How messages are sent.
BROKER_OPTIONS = {
    "kafka.compression.type": "snappy",
    "kafka.acks": "all",
    "kafka.max.request.size": str(10 * 1024 * 1024),
}


def with_topic(df: DataFrame, topic: str | None) -> DataFrame:
    """Messages with a fixed topic, or their own where none is given."""
    own = F.col("topic") if "topic" in df.columns else F.lit(None).cast("string")
    return df.withColumn("topic", F.coalesce(F.lit(topic).cast("string"), own))


def write_broker(
    df: DataFrame, servers: str, topic: str | None = None, checkpoint: str | None = None
) -> StreamingQuery | None:
    """Send (topic, value) messages to a broker; needs Spark's Kafka connector."""
    named = with_topic(df, topic)
    options = {"kafka.bootstrap.servers": servers, **BROKER_OPTIONS}
    if df.isStreaming:
        return (
            named.writeStream.format("kafka")
            .options(**options)
            .option("checkpointLocation", checkpoint)
            .start()
        )
    named.write.format("kafka").options(**options).save()
    return None


def write_files(
    df: DataFrame, path: str, topic: str | None = None, checkpoint: str | None = None
) -> StreamingQuery | None:
    """Append messages to a folder of JSON lines, one sub-folder per topic."""
    named = with_topic(df, topic)
    if df.isStreaming:
        return (
            named.writeStream.format("json")
            .partitionBy("topic")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    named.write.mode("append").partitionBy("topic").json(path)
    return None
