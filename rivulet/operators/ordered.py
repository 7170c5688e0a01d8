"""Order-dependent operators that stay parallel when one group holds most rows.

A window over (group ORDER BY seq) is one task per group, so a group above `cap` rows
is first cut into slices along `seq`: every slice is scanned on its own, one summary
row per slice is combined along the order, and its result is joined back. Groups at or
below `cap` keep the plain window. `seq` must be a non-null number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.util import null_safe, stage

# Rows of one group that a single task may sort.
GROUP_CAP = 2_000_000
# Largest frame that is broadcast, in rows; it is counted first.
BROADCAST_ROWS = 200_000
MAX_SLICES = 10_000

SLICE = "_slice"


def check_batch(df: DataFrame, what: str) -> None:
    if df.isStreaming:
        raise ValueError(f"{what} needs a batch frame; use rivulet.streaming for streams")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame, marked for broadcast when counting shows that it is small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


@dataclass
class HotGroups:
    """Groups above the cap. There are at most (all rows / cap) of them."""

    frame: DataFrame
    groups: int
    rows: int

    def hint(self, rows_per_group: int = 1) -> Callable[[DataFrame], DataFrame]:
        fits = self.groups * rows_per_group <= BROADCAST_ROWS
        return F.broadcast if fits else (lambda df: df)


# Hot groups up to which their keys are listed in the plan; more are kept in a table.
_LISTED = 1_000
# Estimated bytes up to which all rows are counted before any group is.
_COUNT_FIRST = 1 << 28


def _has_few_rows(df: DataFrame, cap: int) -> bool:
    """Whether a frame that looks small has at most `cap` rows, as its count shows."""
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) < _COUNT_FIRST and df.count() <= cap


def hot_groups(df: DataFrame, keys: list[str], cap: int = GROUP_CAP) -> HotGroups | None:
    """Groups of more than `cap` rows, or None; only the key columns are read.

    The counts combine before the shuffle, so finding a hot group is not slowed by it. A
    frame that is small as a whole is counted without any shuffle.
    """
    if _has_few_rows(df, cap):
        return None
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > cap)
    found = sizes.limit(_LISTED + 1).collect()
    if not found:
        return None
    if len(found) <= _LISTED:
        named = df.sparkSession.createDataFrame(found, sizes.schema)
        return HotGroups(named.select(*keys), len(found), sum(r["_n"] for r in found))
    sizes = stage(sizes, "hot-groups")
    groups, rows = sizes.agg(F.count(F.lit(1)), F.sum("_n")).first()
    return HotGroups(sizes.select(*keys), groups, rows)


def _bounds(df: DataFrame, seq: str, slices: int) -> list[float]:
    probabilities = [i / slices for i in range(1, slices)]
    return sorted(set(df.approxQuantile(seq, probabilities, 1 / (4 * slices))))


def _bucket(df: DataFrame, seq: str, bounds: list[float]) -> DataFrame:
    splits = [float("-inf"), *bounds, float("inf")]
    return Bucketizer(splits=splits, inputCol=seq, outputCol=SLICE).transform(df)


@dataclass
class Sliced:
    """A frame with a slice column; `hot` tells whether any group was cut."""

    frame: DataFrame
    hot: bool
    summary_rows: int = 0

    def summary_hint(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.summary_rows <= BROADCAST_ROWS else df


def slice_groups(
    df: DataFrame,
    keys: list[str],
    seq: str,
    cap: int = GROUP_CAP,
    max_slices: int = MAX_SLICES,
) -> Sliced:
    """Cut groups above `cap` rows into slices of about `cap` rows along `seq`.

    Rows of other groups get slice -1.
    """
    check_batch(df, "slicing a group")
    hot = hot_groups(df, keys, cap)
    if hot is None:
        return Sliced(df.withColumn(SLICE, F.lit(-1.0)), False)
    slices = max(2, min(max_slices, -(-hot.rows // cap)))
    if not keys:
        return Sliced(_bucket(df, seq, _bounds(df, seq, slices)), True, slices)
    flags = hot.hint()(hot.frame.select(*[F.col(k).alias(f"_h_{k}") for k in keys]))
    is_key = None
    for key in keys:
        term = df[key].eqNullSafe(flags[f"_h_{key}"])
        is_key = term if is_key is None else is_key & term
    bounds = _bounds(df.join(flags, is_key, "left_semi"), seq, slices)
    marked = df.join(flags.withColumn("_hot", F.lit(True)), is_key, "left")
    cut = _bucket(marked, seq, bounds).drop(*[f"_h_{k}" for k in keys])
    cut = cut.withColumn(SLICE, F.when(F.col("_hot"), F.col(SLICE)).otherwise(F.lit(-1.0)))
    return Sliced(cut.drop("_hot"), True, hot.groups * slices)


def _combine(kind: str, carry: Column, local: Column) -> Column:
    both = carry + local if kind == "sum" else F.greatest(carry, local)
    return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(both)


def running(
    df: DataFrame,
    keys: list[str],
    seq: str,
    values: dict[str, tuple[str, Column]],
    inclusive: bool = False,
    cap: int = GROUP_CAP,
    sliced: Sliced | None = None,
) -> DataFrame:
    """Add running `max` or `sum` columns per group in `seq` order.

    `values` maps a new column to (kind, expression). Without `inclusive` a row sees
    only the rows before it. A row that sees no value gets NULL, for sums too.
    """
    check_batch(df, "a running aggregate")
    cut = sliced or slice_groups(df, keys, seq, cap)
    last = Window.currentRow if inclusive else -1
    by = [*keys, SLICE] if cut.hot else keys
    local = Window.partitionBy(*by).orderBy(seq).rowsBetween(Window.unboundedPreceding, last)
    fns = {"max": F.max, "sum": F.sum}
    if not cut.hot:
        plain = cut.frame
        for name, (kind, value) in values.items():
            plain = plain.withColumn(name, fns[kind](value).over(local))
        return plain.drop(SLICE)

    totals = [fns[kind](value).alias(f"_t_{name}") for name, (kind, value) in values.items()]
    hot_rows = cut.frame.where(F.col(SLICE) >= 0)
    summary = hot_rows.groupBy(*keys, SLICE).agg(*totals)
    before = (
        Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = summary.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        F.col(SLICE).alias("_c_slice"),
        *[fns[kind](f"_t_{n}").over(before).alias(f"_c_{n}") for n, (kind, _) in values.items()],
    )
    carry = cut.summary_hint(carry)
    same = F.col(SLICE) == F.col("_c_slice")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_c_{key}"))
    joined = cut.frame
    for name, (kind, value) in values.items():
        joined = joined.withColumn(f"_l_{name}", fns[kind](value).over(local))
    joined = joined.join(carry, same, "left")
    for name, (kind, _) in values.items():
        joined = joined.withColumn(name, _combine(kind, F.col(f"_c_{name}"), F.col(f"_l_{name}")))
    extra = [f"_{p}_{n}" for n in values for p in ("l", "c")]
    return joined.drop(*extra, *[f"_c_{k}" for k in keys], "_c_slice", SLICE)


def segments(
    df: DataFrame,
    seq: str,
    value: Column,
    starts: Callable[[Column, Column], Column],
    cap: int = GROUP_CAP,
) -> DataFrame:
    """Number the segments of one totally ordered log.

    `starts(previous, current)` tells from the neighbouring values whether a row opens a
    new segment. Adds `segment` (0-based) and `position` (0-based, within the segment).
    """
    check_batch(df, "segmenting a log")
    cut = slice_groups(df.withColumn("_v", value), [], seq, cap)
    by_seq = Window.partitionBy(SLICE).orderBy(seq)
    so_far = by_seq.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The first row of a slice is resolved later, from the slice before it.
    scanned = (
        cut.frame.withColumn("_rn", F.row_number().over(by_seq).cast("bigint"))
        .withColumn("_prev", F.lag("_v").over(by_seq))
        .withColumn(
            "_open", (F.col("_rn") > 1) & F.coalesce(starts(F.col("_prev"), F.col("_v")), F.lit(False))
        )
        .withColumn("_opened", F.sum(F.col("_open").cast("bigint")).over(so_far))
        .withColumn("_at", F.max(F.when(F.col("_open"), F.col("_rn"))).over(so_far))
    )
    if not cut.hot:
        return scanned.select(
            *df.columns,
            F.col("_opened").alias("segment"),
            (F.col("_rn") - F.coalesce(F.col("_at"), F.lit(1))).alias("position"),
        )

    in_order = Window.orderBy(SLICE)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per slice, so these windows sort at most MAX_SLICES rows.
    summary = (
        scanned.groupBy(SLICE)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max("_opened").alias("_m"),
            F.max("_at").alias("_last"),
            F.min(F.struct(seq, "_v"))["_v"].alias("_first_v"),
            F.max(F.struct(seq, "_v"))["_v"].alias("_last_v"),
        )
        .withColumn("_rows_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_prev_v", F.lag("_last_v").over(in_order))
        .withColumn(
            "_first_open",
            (F.col("_rows_before") > 0)
            & F.coalesce(starts(F.col("_prev_v"), F.col("_first_v")), F.lit(False)),
        )
        .withColumn("_new", F.col("_m") + F.col("_first_open").cast("bigint"))
        .withColumn("_segments_before", F.coalesce(F.sum("_new").over(before), F.lit(0)))
        .withColumn(
            "_open_row",
            F.col("_rows_before") + F.coalesce("_last", F.when(F.col("_first_open"), F.lit(1))),
        )
        .withColumn("_open_before", F.coalesce(F.max("_open_row").over(before), F.lit(1)))
        .select(
            F.col(SLICE).alias("_c_slice"),
            "_rows_before",
            "_segments_before",
            "_first_open",
            "_open_before",
        )
    )
    joined = scanned.join(F.broadcast(summary), F.col(SLICE) == F.col("_c_slice"))
    opened_at = F.coalesce(
        F.col("_rows_before") + F.col("_at"),
        F.when(F.col("_first_open"), F.col("_rows_before") + 1),
        F.col("_open_before"),
    )
    return joined.select(
        *df.columns,
        (
            F.col("_segments_before") + F.col("_first_open").cast("bigint") + F.col("_opened")
        ).alias("segment"),
        (F.col("_rows_before") + F.col("_rn") - opened_at).alias("position"),
    )


def join_on_keys(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left"
) -> DataFrame:
    """Join on NULL-safe keys, keeping the left frame's key columns."""
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_r_{key}")
    condition = None
    for key in keys:
        term = F.col(key).eqNullSafe(F.col(f"_r_{key}"))
        condition = term if condition is None else condition & term
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


__all__ = [
    "BROADCAST_ROWS",
    "GROUP_CAP",
    "hot_groups",
    "join_on_keys",
    "null_safe",
    "running",
    "segments",
    "slice_groups",
    "small",
]
