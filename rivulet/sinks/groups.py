"""Several target tables, and progress, that change together batch by batch."""

from __future__ import annotations

from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

from rivulet.sinks.commits import Manifest
from rivulet.sinks.tables import BucketedTable

if TYPE_CHECKING:
    from rivulet.streaming.store import BatchStore

Change = tuple[DataFrame, Callable[[DataFrame], DataFrame]]


class TableGroup:
    """Tables whose batches become current by one manifest: of a batch that fails, no table
    shows anything; of a committed one, all show it, also where a table's own record was not
    written yet. A table keeps to its group however it is opened later, and belongs to one.

    A table that a group's batch does not name stays as it is. `progress` is saved before the
    manifest and read up to its batch, so it never runs ahead. One writer at a time. Readers
    of several tables that begin during a commit may see one batch in one and the next in the
    other; `last_batch` tells where the group is.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        tables: dict[str, BucketedTable],
        progress: BatchStore | None = None,
    ) -> None:
        self.tables, self.progress = tables, progress
        self.manifest = Manifest(spark, path)
        for name, table in tables.items():
            table.log.share(self.manifest, name)

    def last_batch(self) -> int | None:
        return self.manifest.last_batch()

    def position(self) -> DataFrame | None:
        """Progress as of the last committed batch."""
        last = self.last_batch()
        return None if self.progress is None or last is None else self.progress.before(last + 1)

    def _catch_up(self) -> None:
        """Write the records that a failure after the manifest left out."""
        for table in self.tables.values():
            late = table.log.unwritten()
            if late is not None:
                table.commit(late)

    def apply(
        self, batch: int, changes: dict[str, Change], save: Callable[[], None] | None = None
    ) -> bool:
        """Apply every table's change (see `BucketedTable.apply`) or none; `save` keeps the
        progress of the batch. False when the batch is already in."""
        self._catch_up()
        last = self.last_batch()
        if last is not None and batch <= last:
            return False
        made = {n: self.tables[n].prepare(batch, keys, change) for n, (keys, change) in changes.items()}
        records = {n: r for n, r in made.items() if r is not None}
        if save is not None:
            save()
        self.manifest.commit(batch, records)
        for name, record in records.items():
            self.tables[name].commit(record)
        self.manifest.expire()
        return True
