"""Message logs: a broker's topics, or a folder of JSON-line files of messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.progress import resume_after, starting_offsets
from rivulet.schemas import MESSAGE

# Fixed value: messages buffered between reader and writer.
BUFFER_MESSAGES = 20_000


def topic_list(topics: str | list[str] | tuple[str, ...]) -> list[str]:
    """Topics given as a list or as comma-separated text."""
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    return [n.strip() for n in names if n.strip()]


def broker_options(
    servers: str,
    topics: str | list[str],
    earliest: bool = True,
    tokens: DataFrame | None = None,
    per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the broker source. Stored tokens decide where a reader starts; without
    them it starts at the earliest or the latest message. `per_trigger` bounds the messages
    of a micro-batch, such as to BUFFER_MESSAGES; by default there is no bound."""
    start = starting_offsets(tokens) if tokens is not None else None
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topic_list(topics)),
        "startingOffsets": start or ("earliest" if earliest else "latest"),
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_broker(
    spark: SparkSession, servers: str, topics: str | list[str], streaming: bool = True, **kwargs
) -> DataFrame:
    """Messages of a broker; needs Spark's Kafka connector on the class path."""
    options = broker_options(servers, topics, **kwargs)
    if not streaming:
        options.pop("maxOffsetsPerTrigger", None)
        if options["startingOffsets"] == "latest":
            raise ValueError("a batch read cannot start at the latest message")
    reader = spark.readStream if streaming else spark.read
    raw = reader.format("kafka").options(**options).load()
    return raw.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def read_files(
    spark: SparkSession,
    path: str,
    topics: str | list[str] | None = None,
    tokens: DataFrame | None = None,
    streaming: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of a folder partitioned by topic; a topic filter prunes whole folders.

    A batch read skips what the stored tokens cover; a stream resumes by its checkpoint.
    """
    reader = (spark.readStream if streaming else spark.read).schema(MESSAGE)
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    messages = reader.json(path)
    if topics:
        messages = messages.where(F.col("topic").isin(*topic_list(topics)))
    if tokens is not None and not streaming:
        messages = resume_after(messages, tokens)
    return messages
