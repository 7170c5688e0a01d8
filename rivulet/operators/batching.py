"""Commit batches and statement runs of an ordered log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.ordered import GROUP_CAP, segments

# Rows between forced commits, and rows in one write transaction.
BUFFER_ROWS = 20_000
STATEMENT_ROWS = 50_000


def commit_boundary(commit: Column, kind: Column) -> Column:
    """Whether a relational envelope ends a batch."""
    return F.coalesce(commit, F.lit(False)) | (kind == "bootstrap-complete")


def document_boundary(kind: Column) -> Column:
    """Whether a document envelope ends a batch: everything but snapshot inserts does."""
    return ~kind.isin("bootstrap-start", "bootstrap-insert")


def commit_batches(
    log: DataFrame,
    boundary: Column,
    seq: str = "seq",
    buffer_rows: int = BUFFER_ROWS,
    cap: int = GROUP_CAP,
) -> DataFrame:
    """Assign rows to commit batches (`batch`, `part`).

    `batch` counts the boundaries before a row; a batch is cut into parts of
    `buffer_rows` rows.
    """
    flag = F.coalesce(boundary, F.lit(False))
    cut = segments(log, seq, flag, lambda before, _: before, cap)
    return cut.select(
        *log.columns,
        F.col("segment").alias("batch"),
        F.floor(F.col("position") / buffer_rows).cast("bigint").alias("part"),
    )


def assign_statements(
    log: DataFrame,
    statement: Column,
    seq: str = "seq",
    max_rows: int = STATEMENT_ROWS,
    merges: Column | None = None,
    cap: int = GROUP_CAP,
) -> DataFrame:
    """Assign rows to statement runs (`run`, `part`): neighbours with the same statement
    share a run, cut into parts of `max_rows`. Where `merges` is false a row always opens
    its own run (documents merge inserts only)."""
    can_merge = F.lit(True) if merges is None else F.coalesce(merges, F.lit(False))
    value = F.struct(statement.alias("s"), can_merge.alias("m"))

    def opens(before: Column, now: Column) -> Column:
        return ~(before["s"].eqNullSafe(now["s"]) & before["m"] & now["m"])

    cut = segments(log, seq, value, opens, cap)
    return cut.select(
        *log.columns,
        F.col("segment").alias("run"),
        F.floor(F.col("position") / max_rows).cast("bigint").alias("part"),
    )


def statement_runs(
    log: DataFrame,
    statement: Column,
    seq: str = "seq",
    max_rows: int = STATEMENT_ROWS,
    merges: Column | None = None,
    cap: int = GROUP_CAP,
) -> DataFrame:
    """One row per write batch: (run, part, statement, first_seq, last_seq, n_rows)."""
    named = log.select(seq, statement.alias("statement"), (
        F.lit(True) if merges is None else merges
    ).alias("_merges"))
    assigned = assign_statements(
        named, F.col("statement"), seq, max_rows, F.col("_merges"), cap
    )
    return assigned.groupBy("run", "part").agg(
        F.first("statement").alias("statement"),
        F.min(seq).alias("first_seq"),
        F.max(seq).alias("last_seq"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def latest_per_key(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Newest row per key, combined before the shuffle so that a hot key is cheap."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_row"))
    return newest.select(*keys, "_row.*")
