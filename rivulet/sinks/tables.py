"""Target tables that change batch by batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.sinks.commits import CommitLog, Record, Run, State, bucket_column, bucket_of, exists, remove, size
from rivulet.util import null_safe, stage

_DEFINITION = "buckets INT, keys ARRAY<STRING>, columns STRING, levels ARRAY<STRING>"


def _free_name(name: str, columns: set[str]) -> str:
    """The name, with a prefix if it is a column."""
    while name in columns:
        name = f"_c{name}"
    return name


class BucketedTable:
    """A keyed table of parquet files that takes changes as sorted runs.

    A batch writes the rows it changed, and marks for keys it removed, as one run; a commit
    record then makes it current, so a batch costs what it changes, not what the table
    holds. Reading merges runs over the base by key, the newest row winning; the base is
    only anti-joined with the keys of the runs, so it is not shuffled while these are few.
    Runs of like size are merged when there are `FAN` of them. The base is cut into hash
    buckets, and one is rewritten when its waiting changes reach `RATIO` of its rows: a row
    is rewritten a bounded number of times on average.

    Buckets split one by one as the table grows (linear hashing): at over `bucket_rows`
    rows a bucket on average the next one in turn is split, and its rows alone move. The
    number of buckets is in the commit record, and it is where the next split takes place.

    A failed batch leaves the table as it was, and a batch that is replayed after its
    commit is skipped. Files that a batch replaced stay for `keep` further batches, for
    readers that began before, and are then removed. One writer at a time.

    The first number of buckets, the keys, the schema and the names of columns that the
    table adds are stored when it is first written; a table that is opened again keeps
    them, and other keys or columns are refused. Added names clash with no column.
    """

    FAN = 8
    RATIO = 0.5
    # Changes of a bucket that wait at least, and rows of one file of a run at most.
    LEAST, FILE_ROWS = 10_000, 2_000_000
    # Bytes of all runs up to which their keys are broadcast to the base.
    BROADCAST = 32 << 20

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str,
        keys: list[str],
        buckets: int = 64,
        bucket_rows: int = 2_000_000,
        keep: int = 2,
    ) -> None:
        self.spark = spark
        self.base, self.runs = f"{path}/base", f"{path}/runs"
        self.definition = f"{path}/definition"
        self.schema = schema
        self.keys = keys
        self.buckets, self.bucket_rows, self.keep = buckets, bucket_rows, keep
        self.columns = spark.createDataFrame([], schema).columns
        taken = {c.lower() for c in self.columns}
        self.levels = [_free_name(n, taken) for n in ("bucket", "v", "gone")]
        self._open()
        self.log = CommitLog(spark, f"{path}/commits", self.buckets)

    def _described(self) -> str:
        return self.spark.createDataFrame([], self.schema).schema.json()

    def _open(self) -> bool:
        """Take over the stored definition, if there is one."""
        if not exists(self.spark, self.definition):
            return False
        stored = self.spark.read.schema(_DEFINITION).parquet(self.definition).first()
        if stored is None:
            return False
        if list(stored["keys"]) != list(self.keys) or stored["columns"] != self._described():
            raise ValueError(f"the table at {self.definition} has other keys or columns")
        self.buckets = stored["buckets"]
        self.levels = list(stored["levels"])
        return True

    def _define(self) -> None:
        if not self._open():
            row = (self.buckets, self.keys, self._described(), self.levels)
            self.spark.createDataFrame([row], _DEFINITION).coalesce(1).write.mode(
                "overwrite"
            ).parquet(self.definition)
        self.log.buckets = self.buckets

    def _bucket(self, count: int) -> F.Column:
        return bucket_column(F.xxhash64(*self.keys), self.buckets, count)

    def last_batch(self) -> int | None:
        return self.log.state().batch

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The current rows, of some buckets or of all."""
        return self._rows(self.log.state(), buckets)

    def _folder(self, bucket: int, version: int) -> str:
        return f"{self.base}/v={version}/{self.levels[0]}={bucket}"

    def _rows(self, state: State, buckets: list[int] | None = None) -> DataFrame:
        chosen = state.base if buckets is None else {b: state.base[b] for b in buckets if b in state.base}
        paths = [self._folder(b, version) for b, (version, rows) in chosen.items() if rows]
        read = self.spark.read.schema(self.schema)
        held = read.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        runs = state.live()
        if not runs:
            return held
        _, version, gone = self.levels
        image = F.struct(*self.columns, gone)
        newest = (
            self._changes(state, runs, buckets).groupBy(*self.keys)
            .agg(F.max_by(image, version).alias("_row")).select("_row.*")
        )
        keys = newest.select(*self.keys)
        few = sum(r.size for r in runs.values()) <= self.BROADCAST
        keys = F.broadcast(keys) if few else keys
        rest = held.join(keys, null_safe(held, keys, self.keys), "left_anti")
        return rest.unionByName(newest.where(~F.col(gone)).drop(gone))

    def _changes(self, state: State, runs: dict[int, Run], buckets: list[int] | None = None) -> DataFrame:
        """Rows of runs that their bucket's base does not hold yet, of all or some buckets."""
        level, version, gone = self.levels
        schema = f"{self.schema}, `{gone}` BOOLEAN, `{version}` BIGINT, `{level}` INT"
        parts = []
        for at, run in runs.items():
            rows = self.spark.read.schema(schema).parquet(f"{self.runs}/v={at}")
            if buckets is not None:  # files are sorted by the bucket of that time
                then = {bucket_of(b, self.buckets, run.buckets) for b in buckets}
                rows = rows.where(F.col(level).isin(*then))
            parts.append(rows)
        rows = reduce(DataFrame.unionByName, parts).withColumn(level, self._bucket(state.buckets))
        if buckets is not None:
            rows = rows.where(F.col(level).isin(*buckets))
        oldest = min(runs)
        known = [(b, v) for b, (v, _) in state.base.items() if v >= 0]
        if known:
            bases = self.spark.createDataFrame(known, f"`{level}` INT, _since BIGINT")
            rows = rows.join(F.broadcast(bases), level, "left")
            rows = rows.where(F.col(version) >= F.coalesce("_since", F.lit(oldest - 1))).drop("_since")
        return rows

    def apply(
        self, batch: int, key_rows: DataFrame, change: Callable[[DataFrame], DataFrame]
    ) -> bool:
        """Replace the rows of `key_rows` (a frame of key columns) by `change(these rows)`;
        False when the batch is already in. `change` may return rows of these keys only."""
        states = self._write(batch, key_rows, change)
        if states is None:
            return False
        self.log.commit(*states)
        self.log.expire()
        return True

    def commit(self, record: Record) -> None:
        self.log.write(record)
        self.log.expire()

    def prepare(
        self, batch: int, key_rows: DataFrame, change: Callable[[DataFrame], DataFrame]
    ) -> Record | None:
        """Write a batch's files and give the record that makes them current; None when the
        batch is already in. Without its record a batch leaves the table as it was."""
        states = self._write(batch, key_rows, change)
        return None if states is None else self.log.record(*states)

    def _write(
        self, batch: int, key_rows: DataFrame, change: Callable[[DataFrame], DataFrame]
    ) -> tuple[State, State] | None:
        """Write a batch's files and give the states before and after it."""
        before = self.log.state()
        if before.batch is not None and batch <= before.batch:
            return None
        self._define()
        level, version, gone = self.levels
        keys = stage(key_rows.select(*self.keys).distinct(), "batch-keys")
        touched = [r[0] for r in keys.select(self._bucket(before.buckets)).distinct().collect()]
        state = replace(
            before, batch=batch, base=dict(before.base), runs=dict(before.runs), trash=list(before.trash)
        )
        if touched:
            held = self._rows(before, touched)
            held = held.join(keys, null_safe(held, keys, self.keys), "left_semi")
            rows = stage(change(held).select(*self.columns), "batch-rows")
            absent = keys.join(rows, null_safe(keys, rows, self.keys), "left_anti")
            written = rows.withColumn(gone, F.lit(False)).unionByName(
                absent.withColumn(gone, F.lit(True)), allowMissingColumns=True
            ).withColumn(version, F.lit(batch).cast("bigint"))
            self._grow(before, state, rows.count())
            self._write_run(state, written)
        self._clean(before, state)
        return before, state

    def _grow(self, before: State, state: State, more: int) -> None:
        """Rewrite the buckets that split, and those with many waiting changes."""
        wanted = -(-(before.rows() + more) // self.bucket_rows)
        state.buckets = max(before.buckets, wanted)
        split = range(before.buckets, state.buckets)
        parents = {bucket_of(b, self.buckets, before.buckets) for b in split}
        waiting = before.waiting()
        heavy = {
            b for b, n in waiting.items()
            if n >= max(self.LEAST, self.RATIO * before.base.get(b, (-1, 0))[1])
        }
        moved = parents | heavy
        done = {b: (state.batch, 0) for b in [*moved, *split]}
        # buckets without rows split without a file
        full = [b for b in moved if b in waiting or before.base.get(b, (-1, 0))[1]]
        if full:
            level = self.levels[0]
            path = f"{self.base}/v={state.batch}"
            rows = self._rows(before, full).withColumn(level, self._bucket(state.buckets))
            rows.repartition(level).write.mode("overwrite").partitionBy(level).parquet(path)
            written = self.spark.read.schema(f"{self.schema}, `{level}` INT").parquet(path)
            for bucket, n in written.groupBy(level).count().collect():
                done[bucket] = (state.batch, n)
        for bucket in moved:
            at, n = before.base.get(bucket, (-1, 0))
            if n:
                state.trash.append((self._folder(bucket, at), state.batch))
        state.base |= done

    def _write_run(self, state: State, rows: DataFrame) -> None:
        """Write the batch's run, merged with the runs of its size where there are enough."""
        level, version, gone = self.levels
        merged: dict[int, Run] = {}
        tier = 0
        live = state.live()
        while len(same := {at: r for at, r in live.items() if r.tier == tier}) >= self.FAN - 1:
            merged |= same
            tier += 1
        if merged:
            image = F.struct(*self.columns, gone, version)
            both = rows.unionByName(self._changes(state, merged).drop(level))
            newest = both.groupBy(*self.keys).agg(F.max_by(image, version).alias("_row"))
            rows = newest.select("_row.*")
        path = f"{self.runs}/v={state.batch}"
        rows = stage(rows.withColumn(level, self._bucket(state.buckets)), "run")
        parts = {r[0]: r[1] for r in rows.groupBy(level).count().collect()}
        files = -(-sum(parts.values()) // self.FILE_ROWS) or 1
        spread = rows.repartitionByRange(files, level) if files > 1 else rows.coalesce(1)
        spread.sortWithinPartitions(level).write.mode("overwrite").parquet(path)
        state.runs[state.batch] = Run(tier, state.buckets, parts, size(self.spark, path))
        for at in [at for at in state.runs if at in merged or at not in state.live()]:
            del state.runs[at]
            state.trash.append((f"{self.runs}/v={at}", state.batch))

    def _clean(self, before: State, state: State) -> None:
        """Remove files that were replaced `keep` batches ago; no committed state reads them."""
        for path, at in before.trash:
            if state.batch - at > self.keep:
                remove(self.spark, path)
                state.trash.remove((path, at))


def merge_statement(
    target: str, source: str, columns: list[str], keys: list[str], dmode: str = "native"
) -> str:
    """MERGE INTO for a table format that supports it; `source` holds the last change per
    key with an `op` column. This is the replace mode."""
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    drop = "WHEN MATCHED AND s.op = 'delete' THEN DELETE " if dmode == "native" else ""
    return (
        f"MERGE INTO {target} t USING {source} s ON {on} {drop}"
        f"WHEN MATCHED AND s.op <> 'delete' THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED AND s.op <> 'delete' THEN INSERT ({names}) VALUES ({values})"
    )


def jdbc_overwrite(
    df: DataFrame, url: str, table: str, batch_rows: int = 50_000, **options: str
) -> None:
    """Replace a database table's rows, keeping its definition."""
    (
        df.write.format("jdbc")
        .mode("overwrite")
        .option("url", url)
        .option("dbtable", table)
        .option("truncate", "true")
        .option("batchsize", batch_rows)
        .options(**options)
        .save()
    )


def jdbc_append(
    df: DataFrame, url: str, table: str, batch_rows: int = 50_000, **options: str
) -> None:
    """Append rows, such as net changes for a staging table, to a database table."""
    (
        df.write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_rows)
        .options(**options)
        .save()
    )
