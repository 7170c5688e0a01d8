"""GTID sets as (sid, lo, hi) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.ordered import BROADCAST_ROWS, GROUP_CAP, running

# Intervals per sid up to which every transaction may be compared with all of them.
SPANS_PER_SID = 64


def set_entries(text: Column) -> Column:
    """ARRAY<STRUCT<sid, lo, hi>> of `sid:lo-hi[:lo-hi],sid:n`; blanks are ignored."""
    clean = F.regexp_replace(text, r"\s", "")
    per_sid = F.filter(F.split(clean, ","), lambda s: s != "")

    def intervals(entry: Column) -> Column:
        parts = F.split(entry, ":")
        sid = F.element_at(parts, 1)

        def one(span: Column) -> Column:
            ends = F.split(span, "-")
            return F.struct(
                sid.alias("sid"),
                F.element_at(ends, 1).cast("bigint").alias("lo"),
                F.element_at(ends, -1).cast("bigint").alias("hi"),
            )

        return F.transform(F.slice(parts, 2, F.size(parts)), one)

    return F.flatten(F.transform(per_sid, intervals))


def parse_sets(df: DataFrame, column: str) -> DataFrame:
    """Explode a GTID-set text column into (sid, lo, hi) rows; other columns are kept."""
    kept = [c for c in df.columns if c != column]
    exploded = df.select(*kept, F.explode(set_entries(F.col(column))).alias("_i"))
    return exploded.select(*kept, "_i.sid", "_i.lo", "_i.hi")


def covered(
    df: DataFrame,
    intervals: DataFrame,
    sid: str = "sid",
    gno: str = "gno",
    cap: int = GROUP_CAP,
    spans_per_sid: int = SPANS_PER_SID,
) -> DataFrame:
    """Add `covered`: whether the transaction (sid, gno) lies in an interval of the set.

    Intervals may overlap and repeat. A set with few intervals per sid is broadcast with
    one row per sid, whose intervals are searched; any other is merged with the
    transactions in (sid, gno) order, where the greatest interval end so far decides. Both
    keep every row once.
    """
    spans = intervals.select(
        F.col("sid").alias("_sid"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi")
    )
    sizes = spans.groupBy("_sid").agg(F.count(F.lit(1)).alias("_n"))
    total, most = sizes.agg(F.sum("_n"), F.max("_n")).first()
    if (total or 0) <= BROADCAST_ROWS and (most or 0) <= spans_per_sid:
        lists = spans.groupBy("_sid").agg(
            F.collect_list(F.struct("_lo", "_hi")).alias("_spans")
        )
        joined = df.join(F.broadcast(lists), F.col(sid) == F.col("_sid"), "left")
        number = F.col(gno)
        inside = F.exists("_spans", lambda s: number.between(s["_lo"], s["_hi"]))
        return joined.select(*df.columns, F.coalesce(inside, F.lit(False)).alias("covered"))

    # An interval start sorts before a transaction with the same number.
    starts = spans.select(
        F.col("_sid").alias("_k"), (F.col("_lo") * 2).alias("_at"), F.col("_hi").alias("_end")
    )
    rows = df.withColumns(
        {
            "_k": F.col(sid),
            "_at": F.col(gno) * 2 + 1,
            "_end": F.lit(None).cast("bigint"),
            "_is_row": F.lit(True),
        }
    )
    merged = rows.unionByName(starts, allowMissingColumns=True)
    seen = running(merged, ["_k"], "_at", {"_reach": ("max", F.col("_end"))}, inclusive=True, cap=cap)
    return seen.where(F.col("_is_row")).select(
        *df.columns, F.coalesce(F.col(gno) <= F.col("_reach"), F.lit(False)).alias("covered")
    )


def sets_contain(own: DataFrame, others: DataFrame, by: list[str]) -> DataFrame:
    """Compare pairs of GTID sets: is every sid of the other set in the own set with the
    same intervals? (Sids only the own set has do not matter.)

    Both frames are (by…, sid, lo, hi). Gives (by…, is_equal) for every id found in
    either frame. Intervals are matched one by one, so no set is gathered in one place:
    a sid agrees when no interval of it is missing on either side.
    """
    keys = [*by, "sid"]
    sides = own.select(*keys, "lo", "hi", F.lit(1).alias("_own"), F.lit(0).alias("_other")).unionByName(
        others.select(*keys, "lo", "hi", F.lit(0).alias("_own"), F.lit(1).alias("_other"))
    )
    spans = sides.groupBy(*keys, "lo", "hi").agg(
        F.max("_own").alias("_own"), F.max("_other").alias("_other")
    )
    per_sid = spans.groupBy(*keys).agg(
        F.max("_other").alias("_asked"),
        F.max((F.col("_own") != F.col("_other")).cast("int")).alias("_differs"),
    )
    bad = F.max(((F.col("_asked") == 1) & (F.col("_differs") == 1)).cast("int"))
    return per_sid.groupBy(*by).agg((bad == 0).alias("is_equal"))


def compact(df: DataFrame, sid: str = "sid", gno: str = "gno", cap: int = GROUP_CAP) -> DataFrame:
    """GTID set (sid, lo, hi) of executed transactions: runs of consecutive numbers."""
    known = df.select(F.col(sid).alias("sid"), F.col(gno).alias("gno")).distinct()
    ranked = running(
        known, ["sid"], "gno", {"_n": ("sum", F.lit(1))}, inclusive=True, cap=cap
    )
    # Consecutive numbers share the difference between the number and its rank.
    runs = ranked.groupBy("sid", (F.col("gno") - F.col("_n")).alias("_run"))
    return runs.agg(F.min("gno").alias("lo"), F.max("gno").alias("hi")).drop("_run")
