"""Applying a relational change log to a table.

A change frame has `seq` (BIGINT, unique per key), `op` (insert, update, delete), `row`
(STRUCT of the table's columns; for a delete the deleted row) and, for updates that match
on the before image, `old` (STRUCT, the full before image). A base frame has the table's
columns, one row per key; None stands for an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.digests import exact_digest
from rivulet.operators.key_moves import replay_moves
from rivulet.operators.ordered import (
    BROADCAST_ROWS,
    GROUP_CAP,
    SLICE,
    HotGroups,
    hot_groups,
    join_on_keys,
    running,
    slice_groups,
)
from rivulet.operators.routing import bad_fields, overlay, project
from rivulet.util import null_safe, stage

# Changes of one key that may be gathered in one array, and the most slices that the log
# of larger keys is cut into.
FOLD_CAP = 100_000
FOLD_SLICES = 200_000

_BASE_SEQ = -(2**62)


@dataclass(frozen=True)
class Modes:
    """How changes meet existing rows.

    imode: native (a live key is an error), ignore, replace. umode: native, replace.
    dmode: native, ignore. match: whether a native update or delete must match the whole
    row or only the key.
    """

    imode: str = "native"
    umode: str = "native"
    dmode: str = "native"
    match: str = "row"

    def __post_init__(self) -> None:
        allowed = {
            "imode": ("native", "ignore", "replace"),
            "umode": ("native", "replace"),
            "dmode": ("native", "ignore"),
            "match": ("row", "key"),
        }
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}")


def changes_from(
    routed: DataFrame, columns: dict[str, str], seq: Column, keys: list[str] | None = None
) -> DataFrame:
    """Change frame of routed envelopes for a table with these columns and types.

    Fields missing from an update's `old` are taken from its after image. Values that do
    not fit their type are NULL; with `keys`, changes whose key holds such a value are left
    out, so that they do not meet under a NULL key. `rejected_rows` lists both kinds.
    """
    images = routed.where(F.col("action").isin("insert", "update", "delete"))
    if keys:
        held = {k: columns[k] for k in keys}
        bad = F.size(bad_fields(F.col("data"), held)) > 0
        if "old" in routed.columns:
            changed = F.size(bad_fields(F.col("old"), held)) > 0
            bad = bad | ((F.col("action") == "update") & changed)
        images = images.where(~bad)
    old = F.when(
        F.col("action") == "update",
        F.struct(*project(overlay(F.col("data"), F.col("old")), columns)),
    )
    return images.select(
        seq.cast("bigint").alias("seq"),
        F.col("action").alias("op"),
        F.struct(*project(F.col("data"), columns)).alias("row"),
        old.alias("old"),
    )


def rejected_rows(routed: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Envelopes with values that do not fit their column's type, and `bad`, the names."""
    images = routed.where(F.col("action").isin("insert", "update", "delete"))
    bad = F.array_union(bad_fields(F.col("data"), columns), bad_fields(F.col("old"), columns))
    return images.withColumn("bad", bad).where(F.size("bad") > 0)


def _key_columns(keys: list[str], image: str = "row") -> list[Column]:
    return [F.col(image)[k].alias(k) for k in keys]


def _columns(changes: DataFrame) -> list[str]:
    return changes.schema["row"].dataType.fieldNames()


def _drop_deletes(changes: DataFrame, dmode: str) -> DataFrame:
    return changes.where(F.col("op") != "delete") if dmode == "ignore" else changes


def _keyed(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Changes with their key columns in front of seq, op, row and old."""
    return changes.select(*_key_columns(keys), *[c for c in changes.columns if c not in keys])


def latest_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Last change per key as (keys…, op, row), combined before the shuffle."""
    last = _keyed(changes, keys).groupBy(*keys).agg(
        F.max_by(F.struct("op", "row"), "seq").alias("_last")
    )
    return last.select(*keys, "_last.op", "_last.row")


def apply_replace(
    base: DataFrame | None, changes: DataFrame, keys: list[str], dmode: str = "native"
) -> DataFrame:
    """Last change per key wins.

    With a base the net changes are written down first: the log is read once, and since
    the base is only anti-joined with them, a small batch is broadcast and the base is
    never shuffled.
    """
    last = latest_changes(_drop_deletes(changes, dmode), keys)
    if base is not None:
        last = stage(last, "net-changes")
    live = last.where(F.col("op") != "delete").select("row.*")
    if base is None:
        return live
    changed = last.select(*keys)
    untouched = base.join(changed, null_safe(base, changed, keys), "left_anti")
    return untouched.select(*live.columns).unionByName(live)


def apply_ignore(
    base: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    dmode: str = "native",
    cap: int = GROUP_CAP,
) -> DataFrame:
    """An insert on a live key is ignored; updates and deletes act on the key.

    An insert takes effect if the insert or delete before it was a delete, or there was
    none. The row then follows from three values per key: the last delete, the last
    insert that took effect, and the last update.
    """
    log = _keyed(_drop_deletes(changes, dmode), keys).select(*keys, "seq", "op", "row")
    op, seq = F.col("op"), F.col("seq")
    is_delete = op == "delete"
    mark = F.when(op.isin("insert", "delete"), F.struct("seq", is_delete.alias("dead")))
    marked = running(log, keys, "seq", {"_before": ("max", mark)}, cap=cap)
    born = (op == "insert") & F.coalesce(F.col("_before")["dead"], F.lit(True))
    image = F.struct("seq", "row")
    per_key = marked.groupBy(*keys).agg(
        F.max(F.when(is_delete, seq)).alias("_dead"),
        F.max_by(F.when(born, image), F.when(born, seq)).alias("_i"),
        F.max_by(F.when(op == "update", image), F.when(op == "update", seq)).alias("_u"),
    )
    alive = F.col("_i.seq").isNotNull() & (F.col("_dead").isNull() | (F.col("_i.seq") > F.col("_dead")))
    newest = F.when(F.col("_u.seq") > F.col("_i.seq"), F.col("_u.row")).otherwise(F.col("_i.row"))
    reborn = F.when(alive, newest)
    if base is None:
        done = per_key.select(reborn.alias("_row"))
    else:
        held = F.struct(*_columns(changes)).cast(changes.schema["row"].dataType)
        both = join_on_keys(base.select(*keys, held.alias("_base")), per_key, keys, "full")
        never_dead = F.col("_base").isNotNull() & F.col("_dead").isNull()
        done = both.select(
            F.when(never_dead, F.coalesce("_u.row", "_base")).otherwise(reborn).alias("_row")
        )
    return done.where(F.col("_row").isNotNull()).select("_row.*")


def duplicate_inserts(
    base: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    upserts: bool = False,
    cap: int = GROUP_CAP,
) -> DataFrame:
    """Inserts whose key is live at that point: (keys…, seq) of every offending change.

    A key is live from an insert to the next delete; with `upserts` an update makes it
    live too.
    """
    log = _keyed(changes, keys).select(*keys, "seq", "op")
    if not upserts:
        log = log.where(F.col("op") != "update")
    if base is not None:
        held = base.select(
            *keys, F.lit(_BASE_SEQ).cast("bigint").alias("seq"), F.lit("insert").alias("op")
        )
        log = held.unionByName(log)
    seen = running(log, keys, "seq", {"_before": ("max", F.struct("seq", "op"))}, cap=cap)
    bad = (
        (F.col("op") == "insert")
        & F.col("_before").isNotNull()
        & (F.col("_before")["op"] != "delete")
    )
    return seen.where(bad).select(*keys, "seq")


def _moved(keys: list[str]) -> Column:
    """Whether a change is an update that changes the key."""
    moved = F.lit(False)
    for key in keys:
        moved = moved | ~F.col("old")[key].eqNullSafe(F.col("row")[key])
    return (F.col("op") == "update") & F.col("old").isNotNull() & moved


def _moves_keys(changes: DataFrame, keys: list[str]) -> bool:
    return "old" in changes.columns and not changes.where(_moved(keys)).isEmpty()


def _step(modes: Modes):
    """State transition of one key for `F.aggregate`."""

    def step(state: Column, change: Column) -> Column:
        live = state["live"]
        put = F.struct(F.lit(True).alias("live"), change["row"].alias("row"))
        gone = F.struct(F.lit(False).alias("live"), F.when(F.lit(False), change["row"]).alias("row"))
        op = change["op"]
        if modes.imode == "native":
            error = F.raise_error(F.concat(F.lit("duplicate key: "), F.to_json(change["row"])))
            inserted = F.when(live, error).otherwise(put)
        elif modes.imode == "ignore":
            inserted = F.when(live, state).otherwise(put)
        else:
            inserted = put
        if modes.umode == "replace":
            updated = put
        else:
            hit = live if modes.match == "key" else live & state["row"].eqNullSafe(change["old"])
            updated = F.when(hit, put).otherwise(state)
        if modes.match == "key":
            deleted = gone
        else:
            hit = live & state["row"].eqNullSafe(change["row"])
            deleted = F.when(hit, gone).otherwise(state)
        return F.when(op == "insert", inserted).when(op == "update", updated).otherwise(deleted)

    return step


def _fold(base: DataFrame | None, log: DataFrame, keys: list[str], modes: Modes) -> DataFrame:
    """Replay each key's changes in order; `log` holds no key above the fold cap."""
    columns = log.schema["row"].dataType.fieldNames()
    per_key = log.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("seq", "op", "row", "old"))).alias("_log")
    )
    if base is None:
        none = F.lit(None).cast(log.schema["row"].dataType)
        both = per_key.withColumn("_base", none)
    else:
        held = F.struct(*columns).cast(log.schema["row"].dataType)
        both = join_on_keys(base.select(*keys, held.alias("_base")), per_key, keys, "full")
    start = F.struct(F.col("_base").isNotNull().alias("live"), F.col("_base").alias("row"))
    empty = F.array().cast(per_key.schema["_log"].dataType)
    end = F.aggregate(F.coalesce("_log", empty), start, _step(modes))
    # In a generator, so that the filter below does not fold every log a second time.
    states = both.select(F.inline(F.array(end)))
    return states.where(F.col("live")).select("row.*")


# Hot keys. Each change is a function on the state of its key, written as rows
# (need -> give). Functions compose, so a key's log is cut into slices, every slice is
# composed on its own, and the results are composed again until one is left.
# The three special states. Other states are digests of rows.
_ABSENT, _ANY_LIVE, _ERROR = "", "*", "!"

def _entries(log: DataFrame, keys: list[str], modes: Modes) -> DataFrame:
    """(keys…, at, need, give, give_seq) rows of a keyed change log."""

    def entry(need: Column, give: Column) -> Column:
        return F.struct(need.alias("need"), give.alias("give"))

    absent, live, error = F.lit(_ABSENT), F.lit(_ANY_LIVE), F.lit(_ERROR)
    types = log.schema["row"].dataType
    row = exact_digest("row", types)
    always = F.array(entry(absent, row), entry(live, row))
    inserts = {
        "native": F.array(entry(absent, row), entry(live, error)),
        "ignore": F.array(entry(absent, row)),
        "replace": always,
    }[modes.imode]
    by_key = modes.match == "key"
    if modes.umode == "replace":
        updates = always
    else:
        updates = F.array(entry(live if by_key else exact_digest("old", types), row))
    deletes = F.array(entry(live if by_key else row, absent))
    made = (
        F.when(F.col("op") == "insert", inserts)
        .when(F.col("op") == "update", updates)
        .otherwise(deletes)
    )
    return log.select(
        *keys, F.col("seq").alias("at"), F.explode(made).alias("_e"), F.col("seq").alias("give_seq")
    ).select(*keys, "at", "_e.need", "_e.give", "give_seq")


def _look(after: dict, give: str, give_seq: int) -> tuple[str, int]:
    if give == _ERROR:
        return give, give_seq
    if give == _ABSENT:
        return after.get(give, (give, give_seq))
    return after.get(give) or after.get(_ANY_LIVE) or (give, give_seq)


def _compose(pdf: pd.DataFrame) -> dict:
    """Compose the functions of one slice, last first."""
    after: dict[str, tuple[str, int]] = {}
    ordered = pdf.sort_values("at", ascending=False, kind="stable")
    block: dict[str, tuple[str, int]] = {}
    current = None

    def close() -> None:
        if _ANY_LIVE in block:
            absent = after.get(_ABSENT)
            after.clear()
            if absent:
                after[_ABSENT] = absent
        after.update(block)
        block.clear()

    columns = (ordered[c].to_numpy() for c in ("at", "need", "give", "give_seq"))
    for at, need, give, give_seq in zip(*columns, strict=True):
        if at != current:
            close()
            current = at
        block[need] = _look(after, give, int(give_seq))
    close()
    return after


def _compose_groups(entries: DataFrame, keys: list[str], at: str | None) -> DataFrame:
    """Compose per (keys, slice) or, without `at`, per key."""
    by = [*keys, at] if at else keys
    schema = entries.select(*keys, "at", "need", "give", "give_seq").schema

    def one(names: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        made = _compose(pdf)
        out = pd.DataFrame(
            {
                "need": list(made),
                "give": [g for g, _ in made.values()],
                "give_seq": [s for _, s in made.values()],
            }
        )
        out["at"] = int(names[-1]) if at else 0
        for key, value in zip(keys, names, strict=False):
            out[key] = value
        return out[[*keys, "at", "need", "give", "give_seq"]]

    return entries.groupBy(*by).applyInPandas(one, schema)


def _reachable(entries: DataFrame, start: DataFrame, keys: list[str]) -> DataFrame:
    """Entries whose state some earlier slice, or the base, can produce."""
    states = (
        entries.select(*keys, F.col("give").alias("need"))
        .unionByName(start.select(*keys, F.col("value").alias("need")))
        .distinct()
    )
    special = entries.where(F.col("need").isin(_ABSENT, _ANY_LIVE))
    rows = entries.where(~F.col("need").isin(_ABSENT, _ANY_LIVE))
    return special.unionByName(join_on_keys(rows, states, [*keys, "need"], "left_semi"))


def _advance(state: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    """Send each key's state (keys…, value, value_seq) through one function per key."""
    moves = entries.select(*[F.col(k).alias(f"_e_{k}") for k in keys], "need", "give", "give_seq")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_e_{key}"))
    live = ~F.col("value").isin(_ABSENT, _ERROR)
    exact = F.col("need") == F.col("value")
    hits = state.join(moves, same & (exact | (live & (F.col("need") == _ANY_LIVE))), "left")
    best = hits.groupBy(*keys, "value", "value_seq").agg(
        F.max_by(F.struct("give", "give_seq"), exact.cast("int")).alias("_to")
    )
    return best.select(
        *keys,
        F.coalesce("_to.give", "value").alias("value"),
        F.when(F.col("_to").isNull(), F.col("value_seq"))
        .otherwise(F.col("_to.give_seq"))
        .alias("value_seq"),
    )


# Slices a state is sent through before it is written down.
_STEPS = 8


def _walk(state: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    """Send each key's state through its slices one after the other; every step reads one
    slice, so all steps together read the entries once."""
    slices = [r[0] for r in parts.select("at").distinct().orderBy("at").collect()]
    for i, at in enumerate(slices, 1):
        state = _advance(state, parts.where(F.col("at") == at), keys)
        if i % _STEPS == 0:
            state = stage(state, "hot-state")
    return state


def _replay_hot(
    base: DataFrame | None,
    log: DataFrame,
    keys: list[str],
    modes: Modes,
    hot: HotGroups,
    cap: int,
) -> DataFrame:
    """Replay keys with more than `cap` changes, spreading each over many tasks."""
    small = hot.groups <= BROADCAST_ROWS
    owners = hot.frame
    types = log.schema["row"].dataType
    columns = types.fieldNames()
    if base is None:
        held = None
        start = owners.withColumn("value", F.lit(_ABSENT))
    else:
        held = join_on_keys(base, hot.hint()(owners), keys, "left_semi").select(
            *keys, F.struct(*columns).cast(log.schema["row"].dataType).alias("row")
        )
        values = held.select(*keys, exact_digest("row", types).alias("value"))
        start = join_on_keys(owners, values, keys).withColumn(
            "value", F.coalesce("value", F.lit(_ABSENT))
        )
    state = stage(start.withColumn("value_seq", F.lit(_BASE_SEQ).cast("bigint")), "hot-state")
    entries = _entries(log, keys, modes)
    size = None
    while True:
        cut = slice_groups(entries, keys, "at", cap, FOLD_SLICES)
        if not cut.hot:
            state = _advance(state, _compose_groups(entries, keys, None), keys)
            break
        parts = stage(_compose_groups(cut.frame, keys, SLICE), "hot-slices")
        parts = stage(_reachable(parts, state, keys), "hot-reachable")
        before, size = size or entries.count(), parts.count()
        if size * 2 > before:
            # The log jumps back and forth so much that composing does not shrink it.
            state = _walk(state, parts, keys)
            break
        entries = parts
    state = stage(state, "hot-state")
    failed = state.where(F.col("value") == _ERROR).limit(1).collect()
    if failed:
        raise ValueError(f"duplicate key: {failed[0].asDict()}")
    final = state.where(F.col("value") != _ABSENT).select(*keys, F.col("value_seq").alias("seq"))
    rows = log.where(F.col("op") != "delete").select(*keys, "seq", "row")
    if held is not None:
        rows = rows.unionByName(held.withColumn("seq", F.lit(_BASE_SEQ).cast("bigint")))
    hint = F.broadcast if small else (lambda df: df)
    return join_on_keys(rows, hint(final), [*keys, "seq"], "left_semi").select("row.*")


def apply_fold(
    base: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    modes: Modes = Modes(),
    cap: int = FOLD_CAP,
) -> DataFrame:
    """Exact replay per key under any mix of modes.

    With the default modes this is the native form: an update or delete acts only if the
    current row equals its before image, NULLs included, and an insert on a live key
    fails the job. A native update that changes the key moves the row if the old one
    matches, and fails if the new key is live.
    """
    if "old" not in changes.columns:
        changes = changes.withColumn("old", F.lit(None).cast(changes.schema["row"].dataType))
    changes = _drop_deletes(changes, modes.dmode)
    if modes.umode == "native" and _moves_keys(changes, keys):
        moved, base, changes = replay_moves(
            base, changes, keys, modes.imode, modes.match, cap,
            lambda held, log: apply_fold(held, log, keys, modes, cap),
        )
        return moved.unionByName(_replay(base, changes, keys, modes, cap))
    return _replay(base, changes, keys, modes, cap)


def _replay(
    base: DataFrame | None, changes: DataFrame, keys: list[str], modes: Modes, cap: int
) -> DataFrame:
    log = _keyed(changes, keys)
    hot = hot_groups(log, keys, cap)
    if hot is None:
        return _fold(base, log, keys, modes)
    flags = hot.hint()(hot.frame)
    cold_base = None if base is None else join_on_keys(base, flags, keys, "left_anti")
    cold = _fold(cold_base, join_on_keys(log, flags, keys, "left_anti"), keys, modes)
    warm = _replay_hot(base, join_on_keys(log, flags, keys, "left_semi"), keys, modes, hot, cap)
    return cold.unionByName(warm)


def apply_changes(
    base: DataFrame | None, changes: DataFrame, keys: list[str], modes: Modes = Modes()
) -> DataFrame:
    """Apply a log under `modes` by the cheapest exact plan."""
    if modes.match == "key" and modes.imode == modes.umode == "replace":
        return apply_replace(base, changes, keys, modes.dmode)
    if modes.match == "key" and modes.imode == "ignore" and modes.umode == "native":
        if not _moves_keys(changes, keys):
            return apply_ignore(base, changes, keys, modes.dmode)
    return apply_fold(base, changes, keys, modes)


def bag_weights(base: DataFrame | None, changes: DataFrame) -> DataFrame:
    """Net number of copies (`weight`) of every distinct row of a table without a key."""
    columns = _columns(changes)

    def part(rows: DataFrame, image: str, weight: int) -> DataFrame:
        return rows.select(F.col(f"{image}.*"), F.lit(weight).cast("bigint").alias("weight"))

    op = F.col("op")
    parts = [
        part(changes.where(op.isin("insert", "update")), "row", 1),
        part(changes.where(op == "delete"), "row", -1),
    ]
    if "old" in changes.columns:
        parts.append(part(changes.where(op == "update"), "old", -1))
    if base is not None:
        parts.append(base.select(*columns, F.lit(1).cast("bigint").alias("weight")))
    merged = parts[0]
    for other in parts[1:]:
        merged = merged.unionByName(other)
    summed = merged.groupBy(*columns).agg(F.sum("weight").alias("weight"))
    return summed.where(F.col("weight") != 0)


def bag_violations(base: DataFrame | None, changes: DataFrame) -> DataFrame:
    """Rows removed more often than they exist: the log is not well formed."""
    return bag_weights(base, changes).where(F.col("weight") < 0)


def apply_bag(
    base: DataFrame | None,
    changes: DataFrame,
    dmode: str = "native",
    copies_per_task: int = 1_000_000,
) -> DataFrame:
    """Apply a well-formed log to a table without a key; duplicates are kept.

    Rows with many copies are spread by chunks of copies before they are written out.
    """
    columns = _columns(changes)
    weights = bag_weights(base, _drop_deletes(changes, dmode)).where(F.col("weight") > 0)
    many = F.col("weight") > copies_per_task
    plain = weights.where(~many).withColumn("_copies", F.col("weight"))
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("weight") - 1) / copies_per_task)))
    chunks = (
        weights.where(many)
        .withColumn("_chunk", chunk)
        .withColumn(
            "_copies",
            F.least(
                F.lit(copies_per_task), F.col("weight") - F.col("_chunk") * copies_per_task
            ).cast("bigint"),
        )
        .repartition(F.col("_chunk"), F.col("weight"))
        .drop("_chunk")
    )
    copies = plain.unionByName(chunks)
    one_each = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return copies.select(*columns, one_each.alias("_n")).select(*columns)
