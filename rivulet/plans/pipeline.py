"""Composing a source and a sink into one job."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.apply_docs import (
    apply_documents,
    document_changes,
    row_changes_as_documents,
)
from rivulet.operators.apply_rows import Modes, apply_changes, changes_from
from rivulet.operators.envelope import (
    decode_documents,
    decode_rows,
    encode_messages,
    snapshot_envelopes,
)
from rivulet.operators.gates import gate_alignment, gate_offsets, gate_rows
from rivulet.operators.routing import (
    keep_tables,
    resolve_document_target,
    resolve_row_target,
    route_documents,
    route_rows,
)
from rivulet.sinks.tables import BucketedTable
from rivulet.sources.messages import topic_list
from rivulet.streaming.apply import apply_tables_stream

STORES = ("relational", "document", "messages")


@dataclass(frozen=True)
class Pipeline:
    """A checked pair of ends with normalised tables and topics."""

    source: str
    sink: str
    tables: list[str] = field(default_factory=list)
    topics: list[str] = field(default_factory=list)

    @property
    def topic(self) -> str | None:
        """The one topic everything goes to, or None for one topic per table."""
        return self.topics[0] if self.topics and self.sink == "messages" else None

    def messages(self, envelopes: DataFrame) -> DataFrame:
        """Producer: (topic, value) messages of the wanted tables' envelopes."""
        if self.sink != "messages":
            raise ValueError("this pipeline reads messages")
        nested = "ns" in envelopes.columns
        wanted = (
            keep_tables(envelopes, self.tables, "ns.db", "ns.coll")
            if nested
            else keep_tables(envelopes, self.tables)
        )
        return encode_messages(wanted, self.topic)

    def _of_topics(self, messages: DataFrame) -> DataFrame:
        if self.source != "messages":
            raise ValueError("this pipeline writes messages")
        return messages.where(F.col("topic").isin(*self.topics))

    def routed_rows(self, messages: DataFrame, forced: bool = False) -> DataFrame:
        """Consumer: relational envelopes with their action and target."""
        database, table = self._default_target()
        routed = route_rows(decode_rows(self._of_topics(messages)))
        return resolve_row_target(routed, database, table, forced)

    def routed_documents(self, messages: DataFrame) -> DataFrame:
        """Consumer: document envelopes with their action and target."""
        database, table = self._default_target()
        routed = route_documents(decode_documents(self._of_topics(messages)))
        return resolve_document_target(routed, database or "", table or "")

    def _default_target(self) -> tuple[str | None, str | None]:
        if not self.tables:
            return None, None
        database, table = self.tables[0].split(".")
        return database, table

    def apply_rows(
        self,
        messages: DataFrame,
        target: str,
        columns: dict[str, str],
        keys: list[str],
        base: DataFrame | None = None,
        modes: Modes = Modes(),
        seq: Column | None = None,
        forced: bool = False,
    ) -> DataFrame:
        """The target table after the messages; tables are resolved one by one."""
        routed = self.routed_rows(messages, forced).where(F.col("target") == target)
        order = F.col("m_offset") if seq is None else seq
        return apply_changes(base, changes_from(routed, columns, order, keys), keys, modes)

    def apply_documents(
        self,
        messages: DataFrame,
        target: str,
        base: DataFrame | None = None,
        seq: Column | None = None,
        row_keys: list[str] | None = None,
    ) -> DataFrame:
        """The target collection after the messages; with `row_keys` the messages are
        relational and a row's key becomes its `_id`."""
        order = F.col("m_offset") if seq is None else seq
        if row_keys:
            routed = self.routed_rows(messages).where(F.col("target") == target)
            return apply_documents(base, row_changes_as_documents(routed, row_keys, order))
        routed = self.routed_documents(messages).where(F.col("target") == target)
        return apply_documents(base, document_changes(routed, order))


    def start(
        self,
        messages: DataFrame,
        targets: dict[str, tuple[BucketedTable, dict[str, str]]],
        checkpoint: str,
        forced: bool = False,
        **options,
    ) -> StreamingQuery:
        """Run the relational consumer as a stream: `db.table` -> (target, columns).

        All targets are fed from one decoding. With `forced` everything goes to the one
        target. `options` are those of `apply_tables_stream`: modes, seq, progress, repair,
        trigger, rejects and group.
        """
        if forced and len(targets) != 1:
            raise ValueError("a forced target must be the only one")
        wanted = {None: next(iter(targets.values()))} if forced else dict(targets)
        return apply_tables_stream(self._of_topics(messages), wanted, checkpoint, **options)


def build_pipeline(
    source: str,
    sink: str,
    tables: str | list[str] | None = None,
    topics: str | list[str] | None = None,
) -> Pipeline:
    """Check a source and sink pair; exactly one end must be a message log.

    Writing messages needs tables; topics then default to one per table. Reading messages
    needs topics; one `db.table` may name the target of messages that carry none.
    """
    for end in (source, sink):
        if end not in STORES:
            raise ValueError(f"unknown store {end!r}, use one of {STORES}")
    if (source == "messages") == (sink == "messages"):
        raise ValueError("exactly one of source and sink must be messages")
    names = topic_list(topics) if topics else []
    if sink == "messages":
        if not tables:
            raise ValueError("writing messages needs tables")
        return Pipeline(source, sink, topic_list(tables), names)
    if not names:
        raise ValueError("reading messages needs topics")
    if tables and not isinstance(tables, str):
        raise ValueError("the target must be one text like schema.table")
    return Pipeline(source, sink, [tables] if tables else [], names)


def full_then_incremental(snapshot: DataFrame, log: DataFrame) -> DataFrame:
    """Snapshot envelopes (phases 0-2) followed by log envelopes (phase 3)."""
    return snapshot.unionByName(log.withColumn("phase", F.lit(3)), allowMissingColumns=True)


def read_tables(
    snapshots: dict[str, DataFrame],
    log: DataFrame,
    snapshot_ts: int,
    positions: DataFrame | None = None,
    executed: DataFrame | None = None,
    bootstrap: bool = True,
    resume: bool = True,
) -> DataFrame:
    """Full and incremental read of `db.table` -> current rows.

    Tables without a stored position are new: their snapshot comes first (unless
    `bootstrap` is off), then the log of all tables, gated by the positions (unless
    `resume` is off). New tables start at the snapshot time, and when other tables were
    followed before, their changes wait for the first transaction outside `executed`, the
    snapshot's GTID set. `positions` are (database, table, time, inc), one row per table.
    """
    known = set()
    if positions is not None and resume:
        known = {
            f"{r[0]}.{r[1]}" for r in positions.select("database", "table").distinct().collect()
        }
    new = [name for name in snapshots if name not in known]
    followed = keep_tables(log, list(snapshots))
    if resume:
        spark = log.sparkSession
        schema = "database STRING, `table` STRING, time BIGINT, inc INT"
        start = spark.createDataFrame(
            [(*name.split("."), snapshot_ts, 0) for name in new] if bootstrap else [], schema
        )
        if positions is not None:
            start = start.unionByName(positions.select("database", "table", "time", "inc"))
        if executed is not None and known and new:
            is_new = F.concat_ws(".", "database", "table").isin(*new)
            followed = gate_alignment(followed, executed, is_new)
        followed = gate_rows(followed, ["database", "table"], positions=start)
        if "row_no" in followed.columns:
            followed = gate_offsets(followed, ["database", "table"], start)
    parts = [
        snapshot_envelopes(snapshots[name], *name.split("."), snapshot_ts)
        for name in (new if bootstrap else [])
    ]
    whole = followed.withColumn("phase", F.lit(3))
    for part in parts:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
