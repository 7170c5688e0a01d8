"""A message log with offsets, as a data source for batches and streams.

A log is a folder: `data/<append>/` holds Parquet files of messages in the order of (topic,
partition, offset), `segments/` one JSON file an append, with a row for every topic partition
of every file: the file, its messages, the first and the last offset. An append is there once
its segments are, as one file. Readers plan by segments and open only files that they need;
a task reads a few of them, cut by offset, so a hot partition is read by many tasks.

The folder must be reachable from every executor, by a path or by a URI that pyarrow opens.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from rivulet.operators.progress import starting_offsets
from rivulet.schemas import MESSAGE
from rivulet.sinks.commits import exists, remove
from rivulet.sources.messages import topic_list

FORMAT = "rivulet-log"
_SEGMENT = "topic STRING, `partition` INT, file STRING, n BIGINT, first BIGINT, last BIGINT"
# Messages a file holds and, about, a task reads.
FILE_MESSAGES = 1_000_000
# What a task holds of a file: buffered bytes a column, and decoded bytes a batch, about.
_BUFFER_BYTES, _BATCH_BYTES = 1 << 20, 8 << 20
# Offsets to read next, by topic and partition; a partition not named starts at 0.
Offsets = dict[str, dict[str, int]]


class MessageLog:
    """Appending to a log, and how far it goes."""

    def __init__(self, spark: SparkSession, path: str, file_messages: int = FILE_MESSAGES):
        self.spark, self.path, self.file_messages = spark, path.rstrip("/"), file_messages

    def segments(self) -> DataFrame:
        if not exists(self.spark, f"{self.path}/segments"):
            return self.spark.createDataFrame([], _SEGMENT)
        return self.spark.read.schema(_SEGMENT).json(f"{self.path}/segments")

    def ends(self) -> DataFrame:
        """Next offset to be written, as tokens."""
        token = F.concat_ws(".", "topic", F.col("partition").cast("string")).alias("token")
        return self.segments().groupBy(token).agg((F.max("last") + 1).alias("next_offset"))

    def append(self, messages: DataFrame, name: str | None = None) -> bool:
        """Add messages with their offsets, all or none; false if `name` was added before.

        One writer at a time. Offsets may have gaps. A message without topic, partition or
        offset, or one whose offset lies before its partition's end, raises ValueError and
        nothing is added. A failed append leaves files that no reader looks at, which the
        append of the same name removes. Other columns are left out.
        """
        name = name or uuid.uuid4().hex
        noted = f"{self.path}/segments/append={name}"
        if exists(self.spark, f"{noted}/_SUCCESS"):
            return False
        folder = f"{self.path}/data/{name}"
        for left in (folder, noted):
            if exists(self.spark, left):
                remove(self.spark, left)
        place = ["topic", "partition", "offset"]
        rows = messages.select(
            F.col("topic").cast("string"), F.col("partition").cast("int"),
            F.col("offset").cast("bigint"), F.col("value").cast("string"),
        )
        # Plain values in pages of about 1 MB, however long they are: what a reader holds.
        rows.repartitionByRange(*place).sortWithinPartitions(*place).write.options(
            **{
                "maxRecordsPerFile": self.file_messages,
                "parquet.enable.dictionary#value": "false",
                "parquet.page.size.row.check.min": "1",
            }
        ).parquet(folder)
        written = self.spark.read.schema(MESSAGE).parquet(folder)
        found = written.groupBy(
            "topic", "partition",
            F.concat(F.lit(f"data/{name}/"), F.col("_metadata.file_name")).alias("file"),
        ).agg(
            F.count(F.lit(1)).alias("n"), F.min("offset").alias("first"),
            F.max("offset").alias("last"), F.count("offset").alias("placed"),
        ).persist()
        try:
            if not found.where("topic is null or partition is null or placed < n").isEmpty():
                raise ValueError("messages need a topic, a partition and an offset")
            token = F.concat_ws(".", "topic", F.col("partition").cast("string")).alias("token")
            starts = found.groupBy(token).agg(F.min("first").alias("first"))
            early = starts.join(self.ends(), "token").where("first < next_offset")
            if not early.isEmpty():
                raise ValueError("offsets before the end of their partition")
            # One row for a file and partition: the description of an append, one small file.
            found.drop("placed").coalesce(1).write.json(noted)
        finally:
            found.unpersist()
        return True


@dataclass
class Pieces(InputPartition):
    """What a task reads: ranges [low, high) of offsets in files."""

    pieces: list[tuple[str, str, int, int, int]]


class _Plan:
    """The segments of a log as readers see them; they are read once each."""

    def __init__(self, options: dict[str, str]):
        self.filesystem, self.root = _filesystem(options["path"])
        topics = options.get("topics")
        self.topics = set(topic_list(topics)) if topics else None
        self.start = options.get("startingoffsets", "earliest")
        self.anchor = options.get("anchor")
        self.begun: Offsets | None = None
        self.task_messages = int(options.get("taskmessages", FILE_MESSAGES))
        self.read_files: set[str] = set()
        # By topic and partition: (last, first, messages, file) in the order of offsets.
        self.segments: dict[tuple[str, str], list[tuple[int, int, int, str]]] = {}

    def refresh(self) -> None:
        listed = self.filesystem.get_file_info(
            fs.FileSelector(f"{self.root}/segments", recursive=True, allow_not_found=True)
        )
        whole = {i.path.rsplit("/", 1)[0] for i in listed if i.base_name == "_SUCCESS"}
        for info in listed:
            if not info.base_name.endswith(".json") or info.path in self.read_files:
                continue
            if info.path.rsplit("/", 1)[0] not in whole:
                continue
            with self.filesystem.open_input_stream(info.path) as f:
                for line in f.read().decode().splitlines():
                    s = json.loads(line)
                    if self.topics is None or s["topic"] in self.topics:
                        held = self.segments.setdefault((s["topic"], str(s["partition"])), [])
                        held.append((s["last"], s["first"], s["n"], s["file"]))
                        held.sort()
            self.read_files.add(info.path)

    def ends(self) -> Offsets:
        self.refresh()
        return nested({place: held[-1][0] + 1 for place, held in self.segments.items()})

    def starts(self) -> Offsets:
        """Where a new reader begins; with an anchor, where the first one began."""
        if self.begun is None:
            self.begun = self.noted("start")
        if self.begun is None:
            if self.start == "latest":
                self.begun = self.ends()
            else:
                self.begun = {} if self.start == "earliest" else nested(flat(json.loads(self.start)))
            self.note("next", self.begun)
            self.note("start", self.begun)
        return self.begun

    def noted(self, name: str) -> Offsets | None:
        if self.anchor is None:
            return None
        filesystem, folder = _filesystem(self.anchor)
        if filesystem.get_file_info(f"{folder}/{name}").type == fs.FileType.NotFound:
            return None
        with filesystem.open_input_stream(f"{folder}/{name}") as f:
            return json.loads(f.read())

    def note(self, name: str, offsets: Offsets) -> None:
        """Keep offsets in the anchor; after a failure they are as before, or not there."""
        if self.anchor is None:
            return
        filesystem, folder = _filesystem(self.anchor)
        filesystem.create_dir(folder, recursive=True)
        with filesystem.open_output_stream(f"{folder}/{name}.new") as f:
            f.write(json.dumps(offsets).encode())
        if filesystem.get_file_info(f"{folder}/{name}").type != fs.FileType.NotFound:
            filesystem.delete_file(f"{folder}/{name}")
        filesystem.move(f"{folder}/{name}.new", f"{folder}/{name}")

    def tasks(self, start: Offsets, end: Offsets) -> list[Pieces]:
        """Segments between two offsets, a task about `task_messages` messages."""
        self.refresh()
        low, tasks, room = flat(start), [], 0
        for place, high in flat(end).items():
            held, after = self.segments.get(place, []), low.get(place, 0)
            for last, first, n, file in held[bisect_right(held, after, key=lambda s: s[0] + 1) :]:
                if first >= high:
                    break
                if not tasks or n > room:
                    tasks.append(Pieces([]))
                    room = self.task_messages
                tasks[-1].pieces.append((file, place[0], int(place[1]), max(first, after), min(last + 1, high)))
                room -= n
        return tasks

    def bounded(self, start: Offsets, end: Offsets, messages: int) -> Offsets:
        """An end at most so many offsets after the start, shared by the partitions that wait;
        every one of them goes on."""
        low, high = flat(start), flat(end)
        waiting = {p: h - low.get(p, 0) for p, h in high.items() if h > low.get(p, 0)}
        for place, _ in sorted(waiting.items(), key=lambda p: (p[1], p[0])):
            share = max(1, messages // len(waiting))
            taken = min(share, waiting.pop(place))
            high[place] = low.get(place, 0) + taken
            messages -= taken
        return nested(high)


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def flat(offsets: Offsets) -> dict[tuple[str, str], int]:
    return {(t, p): n for t, parts in offsets.items() for p, n in parts.items()}


def nested(places: dict[tuple[str, str], int]) -> Offsets:
    """Offsets in one order, since Spark compares them as text."""
    made: Offsets = {}
    for (topic, partition), n in sorted(places.items()):
        made.setdefault(topic, {})[partition] = n
    return made


def later(one: Offsets, other: Offsets) -> Offsets:
    a, b = flat(one), flat(other)
    return nested({p: max(a.get(p, 0), b.get(p, 0)) for p in a.keys() | b.keys()})


def _read(root: str, task: Pieces) -> Iterator[pa.RecordBatch]:
    """Messages of the pieces, decoded page by page: a reader that takes whole row groups, or
    some ahead, needs memory by the size of files."""
    filesystem, folder = _filesystem(root)
    columns = ["topic", "partition", "offset", "value"]
    for file, topic, partition, low, high in task.pieces:
        bounds = {"topic": (topic, topic), "partition": (partition, partition), "offset": (low, high - 1)}
        with filesystem.open_input_file(f"{folder}/{file}") as f:
            data = pq.ParquetFile(f, buffer_size=_BUFFER_BYTES)
            for at in range(data.num_row_groups):
                group = data.metadata.row_group(at)
                if not _may_hold(group, bounds):
                    continue
                rows = max(1, min(8192, _BATCH_BYTES * group.num_rows // max(1, group.total_byte_size)))
                for batch in data.iter_batches(rows, [at], columns, use_threads=False):
                    held = batch.filter(_within(batch, bounds))
                    if held.num_rows:
                        yield held


def _may_hold(group: pq.RowGroupMetaData, bounds: dict[str, tuple]) -> bool:
    """Whether a row group's statistics leave room for rows within bounds, both included."""
    for column in map(group.column, range(group.num_columns)):
        if column.path_in_schema in bounds and column.is_stats_set and column.statistics.has_min_max:
            low, high = bounds[column.path_in_schema]
            if column.statistics.max < low or column.statistics.min > high:
                return False
    return True


def _within(batch: pa.RecordBatch, bounds: dict[str, tuple]) -> pa.Array:
    tests = [
        pc.and_(pc.greater_equal(batch[name], low), pc.less_equal(batch[name], high))
        for name, (low, high) in bounds.items()
    ]
    return reduce(pc.and_, tests)


class _BatchReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[Pieces]:
        plan = _Plan(self.options)
        return plan.tasks(plan.starts(), plan.ends())

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        # Spark reads an empty plan as one partition of None.
        return _read(self.options["path"], partition) if partition else iter(())


class _StreamReader(DataSourceStreamReader):
    """Spark asks for the end of a batch without telling its start, so a bounded reader notes
    the end of every batch it plans. A restarted query plans a batch that was not committed
    before it asks for a new end; so the note is then where the next batch starts. Where it
    is missing, the batch takes all there is."""

    def __init__(self, options: dict[str, str]):
        self.options, self.bound = options, int(options.get("maxmessages", 0))
        self.plan: _Plan | None = None
        self.at: Offsets | None = None

    def _planned(self) -> _Plan:
        if self.plan is None:
            self.plan = _Plan(self.options)
        return self.plan

    def initialOffset(self) -> Offsets:
        return self._planned().starts()

    def latestOffset(self) -> Offsets:
        plan = self._planned()
        end = later(plan.ends(), plan.starts())
        if self.bound and self.at is None:
            self.at = plan.noted("next")
        if self.bound and self.at is not None:
            end = plan.bounded(self.at, end, self.bound)
        return end

    def partitions(self, start: Offsets, end: Offsets) -> list[Pieces]:
        self.at = end
        if self.bound:
            self._planned().note("next", end)
        return self._planned().tasks(start, end)

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        return _read(self.options["path"], partition)


class MessageLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE

    def reader(self, schema) -> _BatchReader:
        return _BatchReader(_lower(self.options))

    def streamReader(self, schema) -> _StreamReader:
        return _StreamReader(_lower(self.options))


def _lower(options) -> dict[str, str]:
    return {k.lower(): v for k, v in options.items()}


def read_log(
    spark: SparkSession,
    path: str,
    topics: str | list[str] | None = None,
    earliest: bool = True,
    tokens: DataFrame | None = None,
    streaming: bool = False,
    per_trigger: int | None = None,
    anchor: str | None = None,
    task_messages: int = FILE_MESSAGES,
) -> DataFrame:
    """Messages of a log. Stored tokens (one row a partition) decide where a reader starts;
    without them it starts at the earliest or, as a stream, at the latest message. Partitions
    without a token, or not there yet, start at 0. Restarted streams go on by their checkpoint.

    Give a stream that starts at the latest message an `anchor`, a new folder beside its
    checkpoint: it keeps where that was, should the stream stop before its first message.
    `per_trigger` (with an anchor) bounds the messages of a batch by offsets, at least one of
    every partition that waits. It is for streams that keep running: with `availableNow` Spark
    asks for one end, so a bounded run ends after one batch and the next run goes on. An empty
    or missing log has no messages.
    """
    spark.dataSource.register(MessageLogSource)
    start = starting_offsets(tokens) if tokens is not None else None
    if start is None and not earliest and not streaming:
        raise ValueError("a batch read cannot start at the latest message")
    if per_trigger and not anchor:
        raise ValueError("a bound of messages needs an anchor")
    options = {
        "path": path.rstrip("/"), "startingOffsets": start or ("earliest" if earliest else "latest"),
        "taskMessages": str(task_messages),
    }
    if topics:
        options["topics"] = ",".join(topic_list(topics))
    if per_trigger:
        options["maxMessages"] = str(per_trigger)
    if anchor:
        options["anchor"] = anchor.rstrip("/")
    return (spark.readStream if streaming else spark.read).format(FORMAT).options(**options).load()
