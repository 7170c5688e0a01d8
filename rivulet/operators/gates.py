"""Gates that drop stale, replayed or unaligned changes of a batch log.

`positions` frames hold the stored position of a table as (table_key, time, inc) and
have one row per table. A table without a stored position accepts everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.gtid import covered
from rivulet.operators.ordered import GROUP_CAP, join_on_keys, running, small
from rivulet.util import stage


def _with_position(df: DataFrame, keys: list[str], positions: DataFrame | None) -> DataFrame:
    if positions is None:
        return df.withColumn("_time", F.lit(None).cast("bigint")).withColumn(
            "_inc", F.lit(None).cast("int")
        )
    stored = positions.select(
        *keys, F.col("time").cast("bigint").alias("_time"), F.col("inc").cast("int").alias("_inc")
    )
    return join_on_keys(df, small(stored), keys)


def _not_before(value: Column, bound: Column) -> Column:
    return bound.isNull() | (value >= bound)


def gate_rows(
    log: DataFrame,
    keys: list[str],
    ts: str = "ts",
    seq: str = "seq",
    positions: DataFrame | None = None,
    cap: int = GROUP_CAP,
) -> DataFrame:
    """Drop changes older than the last accepted time of their table.

    An equal time passes. The last accepted time is the greatest time before the change
    in `seq` order, or the stored one. `keys` name the table.
    """
    seen = running(log, keys, seq, {"_seen": ("max", F.col(ts))}, cap=cap)
    gated = _with_position(seen, keys, positions).where(
        _not_before(F.col(ts), F.col("_seen")) & _not_before(F.col(ts), F.col("_time"))
    )
    return gated.select(*log.columns)


def gate_offsets(
    rows: DataFrame, keys: list[str], positions: DataFrame, ts: str = "ts", row_no: str = "row_no"
) -> DataFrame:
    """Drop rows of a replayed multi-row event that come before the stored row.

    (ts, row number) is compared with the stored (time, inc) field by field.
    """
    time, inc = F.col("_time"), F.col("_inc")
    later = (F.col(ts) > time) | ((F.col(ts) == time) & (F.col(row_no) >= inc))
    gated = _with_position(rows, keys, positions).where(time.isNull() | later)
    return gated.select(*rows.columns)


def gate_documents(
    log: DataFrame,
    keys: list[str],
    cluster_time: str = "clusterTime",
    seq: str = "seq",
    positions: DataFrame | None = None,
    cap: int = GROUP_CAP,
) -> DataFrame:
    """Drop changes whose (time, inc) is before the last accepted one of their collection."""
    now = F.struct(F.col(cluster_time)["time"].alias("time"), F.col(cluster_time)["inc"].alias("inc"))
    seen = running(log, keys, seq, {"_seen": ("max", now)}, cap=cap)
    stored = F.when(
        F.col("_time").isNotNull(), F.struct(F.col("_time").alias("time"), F.col("_inc").alias("inc"))
    )
    gated = _with_position(seen, keys, positions).where(
        _not_before(now, F.col("_seen")) & _not_before(now, stored)
    )
    return gated.select(*log.columns)


def gate_alignment(
    log: DataFrame,
    intervals: DataFrame,
    is_new_table: Column,
    sid: str = "sid",
    gno: str = "gno",
    seq: str = "seq",
    server: str | None = None,
    cap: int = GROUP_CAP,
) -> DataFrame:
    """Drop rows of new tables before the log has passed the snapshot.

    The log is aligned from its first transaction that the snapshot's GTID set does not
    contain; `server` names the log a row belongs to (one log when not given). Finding
    that transaction is one minimum per log, so no ordering of the log is needed.
    """
    keys = [server] if server else ["_log"]
    base = log if server else log.withColumn("_log", F.lit(0))
    flagged = covered(base, intervals, sid, gno, cap=cap)
    first = stage(
        flagged.where(~F.col("covered")).groupBy(*keys).agg(F.min(seq).alias("_aligned")),
        "aligned",
    )
    joined = join_on_keys(base.withColumn("_new", is_new_table), small(first), keys)
    kept = joined.where(~F.col("_new") | (F.col(seq) >= F.col("_aligned")))
    return kept.select(*log.columns)
