"""Applying a stream of messages to a target table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.apply_docs import apply_documents, document_changes
from rivulet.operators.apply_rows import Modes, apply_changes, changes_from
from rivulet.operators.envelope import decode_documents, decode_rows, table_key
from rivulet.operators.progress import consumer_progress, progress_tokens
from rivulet.operators.routing import route_documents, route_rows
from rivulet.sinks.groups import TableGroup
from rivulet.sinks.tables import BucketedTable
from rivulet.streaming.rejects import RejectStore, malformed, misfits
from rivulet.streaming.store import BatchStore


def progress_store(spark, path: str) -> BatchStore:
    return BatchStore(spark, path, "token STRING, next_offset BIGINT")


def _save_progress(store: BatchStore | None, batch: DataFrame, batch_id: int) -> None:
    if store is None:
        return
    now = progress_tokens(consumer_progress(batch))
    known = store.before(batch_id)
    if known is not None:
        now = now.unionByName(known).groupBy("token").agg(
            F.max("next_offset").alias("next_offset")
        )
    store.save(batch_id, now)


def _start(
    messages: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    return (
        messages.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _replayed(
    keys: list[str], routed: DataFrame, columns: dict[str, str], order: Column, modes: Modes
) -> tuple[DataFrame, DataFrame, Callable[[DataFrame], DataFrame]]:
    """The changes of a table, kept, and what a target takes: touched keys and the change."""
    # Kept, so that messages are parsed once; lost blocks are parsed again.
    changes = changes_from(routed, columns, order, keys).persist()
    touched = changes.select(*[F.col("row")[k].alias(k) for k in keys])
    if modes.match == "row" or modes.umode == "native":
        moved = changes.where(F.col("old").isNotNull())
        touched = touched.unionByName(moved.select(*[F.col("old")[k].alias(k) for k in keys]))
    return changes, touched, lambda base: apply_changes(base, changes, keys, modes)


def _replay_on(
    target: BucketedTable,
    routed: DataFrame,
    columns: dict[str, str],
    order: Column,
    modes: Modes,
    batch_id: int,
) -> None:
    changes, touched, change = _replayed(target.keys, routed, columns, order, modes)
    try:
        target.apply(batch_id, touched, change)
    finally:
        changes.unpersist()


def _replay_together(
    group: TableGroup,
    chosen: dict[str, tuple[BucketedTable, DataFrame, dict[str, str]]],
    order: Column,
    modes: Modes,
    batch_id: int,
    save: Callable[[], None],
) -> None:
    made = {
        name: _replayed(target.keys, routed, columns, order, modes)
        for name, (target, routed, columns) in chosen.items()
    }
    try:
        group.apply(batch_id, {name: parts[1:] for name, parts in made.items()}, save)
    finally:
        for changes, *_ in made.values():
            changes.unpersist()


def apply_rows_stream(
    messages: DataFrame,
    target: BucketedTable,
    columns: dict[str, str],
    checkpoint: str,
    modes: Modes = Modes(imode="replace", umode="replace", match="key"),
    seq: Column | None = None,
    progress: BatchStore | None = None,
    repair: Callable[[DataFrame], DataFrame] | None = None,
    table: str | None = None,
    trigger: dict | None = None,
    rejects: RejectStore | None = None,
) -> StreamingQuery:
    """Replay relational messages onto a table, batch by batch.

    With `table` (`db.table`) only its messages are applied; without it, all are, whatever
    table they name. `apply_tables_stream` says what the other parameters mean.
    """
    return apply_tables_stream(
        messages, {table: (target, columns)}, checkpoint, modes, seq, progress, repair, trigger, rejects
    )


def apply_tables_stream(
    messages: DataFrame,
    targets: dict[str | None, tuple[BucketedTable, dict[str, str]]],
    checkpoint: str,
    modes: Modes = Modes(imode="replace", umode="replace", match="key"),
    seq: Column | None = None,
    progress: BatchStore | None = None,
    repair: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
    rejects: RejectStore | None = None,
    group: TableGroup | None = None,
) -> StreamingQuery:
    """Replay relational messages onto the tables they name, batch by batch.

    `targets` maps `db.table` to its target and columns; messages of other tables are left
    out, and the name None takes all messages. `seq` orders the changes of a key within a
    batch (the message offset by default: give it if a key's messages come from several
    partitions) and `repair` may fix payloads. Progress is saved after all targets have
    committed, and a target skips a batch it already holds, so nothing is lost or applied
    twice. `rejects` keeps the messages that are malformed or hold values that do not fit,
    before the targets commit. `trigger` holds options of Spark's trigger, such as
    {"processingTime": "5 seconds"} to run until stopped; by default the stream ends when
    it is drained. With a `group` of the same targets a batch shows in all of them and in the
    group's progress, or in none; without one, targets commit one after the other.
    """
    if group is not None and group.tables != {n: t for n, (t, _) in targets.items()}:
        raise ValueError("the group must hold the targets")
    order = F.col("m_offset") if seq is None else seq

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        envelopes = decode_rows(batch)
        envelopes = repair(envelopes) if repair else envelopes
        shared = len(targets) > 1 or rejects is not None
        routed = route_rows(envelopes)
        routed = routed.persist() if shared else routed
        own = table_key(F.col("database"), F.col("table"))
        chosen = {n: routed if n is None else routed.where(own == F.lit(n)) for n in targets}
        try:
            if rejects is not None:
                found = malformed(routed)
                for name, (target, columns) in targets.items():
                    found = found.unionByName(misfits(chosen[name], columns, target.keys, name))
                rejects.save(batch_id, batch, found)
            if group is not None:
                members = {n: (t, chosen[n], columns) for n, (t, columns) in targets.items()}
                _replay_together(
                    group, members, order, modes, batch_id,
                    lambda: _save_progress(group.progress, batch, batch_id),
                )
            else:
                for name, (target, columns) in targets.items():
                    _replay_on(target, chosen[name], columns, order, modes, batch_id)
        finally:
            if shared:
                routed.unpersist()
        _save_progress(progress, batch, batch_id)

    return _start(messages, on_batch, checkpoint, trigger)


def apply_documents_stream(
    messages: DataFrame,
    target: BucketedTable,
    checkpoint: str,
    seq: Column | None = None,
    progress: BatchStore | None = None,
    trigger: dict | None = None,
    rejects: RejectStore | None = None,
) -> StreamingQuery:
    """Replay document messages onto a collection, batch by batch; by default until drained.

    `rejects` keeps the malformed messages, before the collection commits.
    """
    order = F.col("m_offset") if seq is None else seq

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        routed = route_documents(decode_documents(batch))
        changes = document_changes(routed, order).persist()
        try:
            if rejects is not None:
                rejects.save(batch_id, batch, malformed(routed))
            target.apply(
                batch_id, changes.select("_id"), lambda base: apply_documents(base, changes)
            )
        finally:
            changes.unpersist()
        _save_progress(progress, batch, batch_id)

    return _start(messages, on_batch, checkpoint, trigger)
