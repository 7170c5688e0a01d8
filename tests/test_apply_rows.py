import itertools
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators.apply_rows import (
    Modes,
    apply_bag,
    apply_changes,
    apply_fold,
    apply_ignore,
    apply_replace,
    bag_violations,
    changes_from,
    duplicate_inserts,
)
from rivulet.operators.envelope import decode_rows
from rivulet.operators.routing import resolve_row_target, route_rows
from tests.fixtures import ACCOUNT_COLUMNS, DELETES, INSERTS, UPDATES, as_messages
from tests.replay import Duplicate, replay_rows

ROW = "STRUCT<k: BIGINT, s: STRING>"
CHANGE = f"seq BIGINT, op STRING, row {ROW}, old {ROW}"


def random_log(seed, size, keys=12, hot=0.0, states=("x", "y", None)):
    rng = random.Random(seed)
    log = []
    for seq in range(size):
        key = 0 if rng.random() < hot else rng.randrange(keys)
        op = rng.choices(["insert", "update", "delete"], [3, 5, 2])[0]
        row, old = (key, rng.choice(states)), (key, rng.choice(states))
        log.append((seq, op, row, old if op == "update" else None))
    rng.shuffle(log)
    return log


def good_log(seed, size, keys=6, hot=0.5):
    """A log every change of which matches, with ever new states."""
    rng = random.Random(seed)
    state, log = {}, []
    for seq in range(size):
        key = 0 if rng.random() < hot else rng.randrange(keys)
        row = (key, f"v{seq}")
        if key not in state:
            log.append((seq, "insert", row, None))
            state[key] = row
        elif rng.random() < 0.1:
            log.append((seq, "delete", state.pop(key), None))
        else:
            log.append((seq, "update", row, state[key]))
            state[key] = row
    return log, state


def frames(spark, base, log):
    held = spark.createDataFrame(list(base.values()), "k BIGINT, s STRING")
    return held, spark.createDataFrame(log, CHANGE)


def rows(df):
    return sorted((tuple(r) for r in df.select("k", "s").collect()), key=str)


BASE = {k: (k, "x" if k % 2 else None) for k in range(3, 20)}

ALL_MODES = [
    Modes(i, u, d, m)
    for i, u, d, m in itertools.product(
        ("ignore", "replace"), ("native", "replace"), ("native", "ignore"), ("row", "key")
    )
]


@pytest.mark.parametrize("modes", ALL_MODES[1::2], ids=str)
def test_every_mode_equals_the_sequential_replay(spark, modes):
    log = random_log(ALL_MODES.index(modes), 400)
    base, changes = frames(spark, BASE, log)
    want = sorted(replay_rows(BASE, log, modes).values(), key=str)
    assert rows(apply_changes(base, changes, ["k"], modes)) == want
    assert rows(apply_fold(base, changes, ["k"], modes)) == want


@pytest.mark.parametrize("modes", [Modes("ignore"), Modes("replace", match="key")], ids=str)
@pytest.mark.parametrize("cap", [60])
def test_hot_keys_equal_the_sequential_replay(spark, modes, cap):
    log = random_log(7, 900, keys=20, hot=0.4)
    base, changes = frames(spark, BASE, log)
    want = sorted(replay_rows(BASE, log, modes).values(), key=str)
    assert rows(apply_fold(base, changes, ["k"], modes, cap=cap)) == want


@pytest.mark.parametrize("cap", [64])
def test_hot_key_of_a_well_formed_log(spark, cap):
    log, state = good_log(3, 1500)
    _, changes = frames(spark, {}, log)
    got = apply_fold(None, changes, ["k"], Modes(), cap=cap)
    assert rows(got) == sorted(state.values(), key=str)


def test_hot_key_with_many_states_that_never_settle(spark):
    log = random_log(11, 600, keys=3, hot=0.6, states=[f"s{i}" for i in range(40)])
    base, changes = frames(spark, {}, log)
    modes = Modes("ignore")
    want = sorted(replay_rows({}, log, modes).values(), key=str)
    assert rows(apply_fold(None, changes, ["k"], modes, cap=30)) == want


@pytest.mark.parametrize("cap", [25, 1000])
def test_native_insert_on_a_live_key_fails(spark, cap):
    log, _ = good_log(5, 200, keys=2)
    log.append((500, "insert", (0, "a"), None))
    log.append((501, "insert", (0, "b"), None))
    with pytest.raises(Duplicate):
        replay_rows({}, log, Modes())
    _, changes = frames(spark, {}, log)
    with pytest.raises(Exception, match="duplicate key"):
        apply_fold(None, changes, ["k"], Modes(), cap=cap).collect()


def test_key_change_moves_the_row(spark):
    log = [
        (1, "insert", (1, "a"), None),
        (2, "update", (2, "b"), (1, "a")),
        (3, "update", (2, "c"), (2, "b")),
    ]
    _, changes = frames(spark, {}, log)
    assert rows(apply_fold(None, changes, ["k"])) == [(2, "c")]
    # The replacing form never removes the old key.
    replaced = apply_replace(None, changes, ["k"])
    assert rows(replaced) == [(1, "a"), (2, "c")]


@pytest.mark.parametrize("cap", [30, 10_000])
def test_ignore_mode_with_hot_keys(spark, cap):
    log = random_log(23, 800, hot=0.4)
    modes = Modes("ignore", match="key")
    want = sorted(replay_rows(BASE, log, modes).values(), key=str)
    base, changes = frames(spark, BASE, log)
    assert rows(apply_ignore(base, changes, ["k"], cap=cap)) == want
    want = sorted(replay_rows({}, log, modes).values(), key=str)
    assert rows(apply_ignore(None, changes, ["k"], cap=cap)) == want


@pytest.mark.parametrize("cap", [30, 10_000])
def test_duplicate_inserts(spark, cap):
    log = random_log(29, 600, hot=0.4)
    base, changes = frames(spark, BASE, log)
    live, want = set(BASE), []
    for seq, op, row, _ in sorted(log, key=lambda c: c[0]):
        if op == "insert":
            if row[0] in live:
                want.append((row[0], seq))
            live.add(row[0])
        elif op == "delete":
            live.discard(row[0])
    got = duplicate_inserts(base, changes, ["k"], cap=cap)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_bag_keeps_duplicates_and_reports_missing_rows(spark):
    base = spark.createDataFrame([(1, None)] * 5 + [(2, "b")] * 2, "k BIGINT, s STRING")
    log = [
        (1, "delete", (1, None), None),
        (2, "update", (1, "n"), (1, None)),
        (3, "insert", (2, "b"), None),
        (4, "delete", (9, "z"), None),
    ]
    changes = spark.createDataFrame(log, CHANGE)
    want = sorted([(1, None)] * 3 + [(1, "n")] + [(2, "b")] * 3, key=str)
    assert rows(apply_bag(base, changes)) == want
    assert rows(apply_bag(base, changes, copies_per_task=2)) == want
    assert [tuple(r) for r in bag_violations(base, changes).collect()] == [(9, "z", -1)]


def account_changes(spark, messages):
    routed = route_rows(decode_rows(as_messages(spark, messages)))
    one = resolve_row_target(routed, "reports", "Patron", forced=True)
    assert {r[0] for r in one.select("target").distinct().collect()} == {"reports.Patron"}
    return changes_from(one, ACCOUNT_COLUMNS, F.col("m_offset"))


def test_sample_messages_replayed_by_key(spark):
    changes = account_changes(spark, INSERTS + UPDATES + DELETES)
    got = apply_replace(None, changes, ["id"]).orderBy("id").collect()
    assert [int(r["id"]) for r in got] == [2, 4, 5, 6]
    five = got[2]
    assert int(five["sponsor_id"]) == 5
    assert str(five["changed_at"]) == "2031-03-06 15:05:05"


def test_sample_messages_replayed_by_before_image(spark):
    changes = account_changes(spark, INSERTS + UPDATES + DELETES)
    got = apply_fold(None, changes, ["id"]).orderBy("id").collect()
    # The delete of id 1 shows the row before its update, so it matches nothing.
    assert [int(r["id"]) for r in got] == [1, 2, 4, 5, 6]
    assert got[0]["name"] == "alder" and int(got[0]["sponsor_id"]) == 1


def test_hot_rows_that_differ_in_microseconds_only(spark):
    text = "2024-01-01 00:00:00.00000"
    log = [(0, "insert", (1, text + "1"), None), (1, "update", (1, text + "9"), (1, text + "2"))]
    log += [(2 + n, "delete", (1, text + "3"), None) for n in range(8)]
    changes = spark.createDataFrame(log, CHANGE)
    for kind in ("timestamp", "timestamp_ntz"):
        typed = changes.select(
            "seq", "op",
            *[
                F.when(F.col(i).isNotNull(), F.struct(F.col(i)["k"].alias("k"), F.col(i)["s"].cast(kind).alias("s"))).alias(i)
                for i in ("row", "old")
            ],
        )
        for cap in (3, 100):
            got = apply_fold(None, typed, ["k"], cap=cap).select("k", F.col("s").cast("string"))
            assert [tuple(r) for r in got.collect()] == [(1, text + "1")]


def test_modes_are_checked():
    with pytest.raises(ValueError, match="imode"):
        Modes(imode="upsert")
