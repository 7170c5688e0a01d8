"""Native replay of updates that change a row's key.

Such an update is one statement: it acts only if the old row matches, then removes it and
puts the new one, and fails if the new key is live. Whether it acts can depend on other
keys, so keys that updates move between are replayed together: they form the components of
a graph, and each component's changes are folded in order over a map of its live rows. All
other keys are left to the plain replay.

The changes of a small component are gathered in one array. Components of ordinary logs are
a few keys. The log of larger ones is cut in two by seq, and the halves are replayed one after
the other: within a half, moves tie fewer keys together, and what they do not tie is left to
the plain replay again. The halves are cut on until their components are small.

Nodes of the graph are 64-bit hashes of keys, which move in a fraction of the bytes of exact
digests. Keys of one hash are replayed together, which they may be: the fold tells keys apart
by their digests.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rivulet.operators.digests import exact_digest
from rivulet.operators.graph import components
from rivulet.util import stage

# Steps times live rows that folding one component may take; each step rebuilds the map.
FOLD_WORK = 200_000_000


def _without(rows: Column, key: Column) -> Column:
    return F.map_filter(rows, lambda k, _: k != key)


def _put(rows: Column, key: Column, row: Column) -> Column:
    return F.map_concat(_without(rows, key), F.map_from_arrays(F.array(key), F.array(row)))


def _step(imode: str, match: str):
    def fail(change: Column, rows: Column) -> Column:
        text = F.concat(F.lit("duplicate key: "), F.to_json(change["row"]))
        return F.when(F.raise_error(text).isNull(), rows)

    def step(rows: Column, c: Column) -> Column:
        live = F.map_contains_key(rows, c["key"])
        put = _put(rows, c["key"], c["row"])
        inserted = {
            "native": F.when(live, fail(c, rows)).otherwise(put),
            "ignore": F.when(live, rows).otherwise(put),
            "replace": put,
        }[imode]
        held_old = F.try_element_at(rows, c["old_key"])
        hit = F.map_contains_key(rows, c["old_key"])
        if match == "row":
            hit = hit & held_old.eqNullSafe(c["old"])
        moved = c["old_key"] != c["key"]
        updated = (
            F.when(~hit, rows)
            .when(moved & live, fail(c, rows))
            .otherwise(_put(_without(rows, c["old_key"]), c["key"], c["row"]))
        )
        gone = live
        if match == "row":
            gone = gone & F.try_element_at(rows, c["key"]).eqNullSafe(c["row"])
        deleted = F.when(gone, _without(rows, c["key"])).otherwise(rows)
        return (
            F.when(c["op"] == "insert", inserted)
            .when(c["op"] == "update", updated)
            .otherwise(deleted)
        )

    return step


def _by_halves(
    base: DataFrame | None,
    log: DataFrame,
    replay: Callable[[DataFrame | None, DataFrame], DataFrame],
) -> DataFrame:
    """Replay the first half of a log, by seq, and then the second one on its result."""
    mid, high = log.agg(F.percentile_approx("seq", 0.5), F.max("seq")).first()
    if mid == high:
        mid = log.where(F.col("seq") < high).agg(F.max("seq")).first()[0]
    first = stage(replay(base, log.where(F.col("seq") <= mid)), "moved-half")
    return stage(replay(first, log.where(F.col("seq") > mid)), "moved-half")


def _node(image: str, kind: StructType, keys: list[str], salt: int) -> Column:
    return F.xxhash64(exact_digest(image, kind, keys), F.lit(salt))


def _with_nodes(changes: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """Changes with the nodes of their key and, for moves, of the old key; and the salt."""
    kind = changes.schema["row"].dataType
    is_update = F.col("op") == "update"
    moved = F.lit(False)
    for key in keys:
        moved = moved | ~F.col("old")[key].eqNullSafe(F.col("row")[key])
    moves = is_update & F.col("old").isNotNull() & moved
    for salt in count():
        noded = changes.select(
            *changes.columns, _node("row", kind, keys, salt).alias("_n"),
            F.when(moves, _node("old", kind, keys, salt)).alias("_from"),
        )
        noded = stage(noded, "noded-log")
        # Two keys of one hash with a move between them would have no edge.
        if noded.where("_from = _n").isEmpty():
            return noded, salt


def replay_moves(
    base: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    imode: str,
    match: str,
    cap: int,
    replay: Callable[[DataFrame | None, DataFrame], DataFrame],
) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(rows of the moved keys, base of the other keys, changes of the other keys).

    `replay` applies changes to a base with the same modes; components that are too large to
    fold are given to it in halves.
    """
    kind = changes.schema["row"].dataType
    log, salt = _with_nodes(changes, keys)
    edges = log.where("_from is not null").select(F.col("_from").alias("x"), F.col("_n").alias("y"))
    owner = components(edges).select(F.col("node").alias("_n"), "root")
    # Joined once and kept; rows of keys that no move ties have no root.
    log = stage(log.drop("_from").join(owner, "_n", "left").drop("_n"), "rooted-log")
    own = log.where("root is not null")
    sizes = own.groupBy("root").agg(
        F.count("*").alias("n"), F.count_if(F.col("op") == "insert").alias("live"),
        (F.min("seq") < F.max("seq")).alias("cuts"),
    )
    marked = None
    if base is not None:
        image = F.struct(*kind.fieldNames()).cast(kind)
        marked = base.select(F.struct(*base.columns).alias("_b"), image.alias("row"))
        marked = marked.withColumn("_n", _node("row", kind, keys, salt))
        marked = stage(marked.join(owner, "_n", "left").drop("_n"), "rooted-base")
        held = marked.where("root is not null").groupBy("root").agg(F.count("*").alias("held"))
        live = F.col("live") + F.coalesce("held", F.lit(0))
        sizes = sizes.join(held, "root", "left").withColumn("live", live)
    large = F.col("cuts") & ((F.col("n") > cap) | (F.col("n") * F.col("live") > FOLD_WORK))
    large = stage(sizes.where(large).select("root"), "large-moves")
    tied = None if marked is None else marked.where("root is not null")
    halves = None
    if not large.isEmpty():
        many = stage(own.join(large, "root", "left_semi").select(*changes.columns), "large-log")
        own = own.join(large, "root", "left_anti")
        start = None
        if marked is not None:
            start = stage(tied.join(large, "root", "left_semi").select("_b.*"), "large-base")
            tied = tied.join(large, "root", "left_anti")
        halves = _by_halves(start, many, replay)
    # Digests are made behind the shuffle, which moves rows without them.
    key = exact_digest("row", kind, keys)
    is_update = F.col("op") == "update"
    old_key = F.when(is_update, F.coalesce(exact_digest("old", kind, keys), key))
    logs = own.repartition("root").groupBy("root").agg(
        F.sort_array(
            F.collect_list(
                F.struct("seq", "op", key.alias("key"), old_key.alias("old_key"), "row", "old")
            )
        ).alias("_log")
    )
    rows_type = f"map<string,{kind.simpleString()}>"
    empty = F.create_map().cast(rows_type)
    if base is None:
        start, rest = logs.withColumn("_rows", empty), None
    else:
        held = tied.repartition("root").groupBy("root").agg(
            F.map_from_entries(F.collect_list(F.struct(key, "row"))).cast(rows_type).alias("_rows")
        )
        start = logs.join(held, "root", "full").withColumn("_rows", F.coalesce("_rows", empty))
        rest = marked.where("root is null").select("_b.*")
    none = F.array().cast(logs.schema["_log"].dataType)
    end = F.aggregate(F.coalesce("_log", none), F.col("_rows"), _step(imode, match))
    done = start.select(F.explode(F.map_values(end)).alias("row")).select("row.*")
    if halves is not None:
        done = done.unionByName(halves.select(*done.columns))
    return done, rest, log.where("root is null").select(*changes.columns)
