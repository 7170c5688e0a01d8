"""Results that must not depend on caps, names or stored sizes."""

import math

import pytest
from pyspark.sql import functions as F

from rivulet.operators import apply_rows as A
from rivulet.operators.apply_rows import Modes
from rivulet.operators.gtid import covered
from rivulet.operators.ordered import running
from rivulet.sinks.tables import BucketedTable
from rivulet.sources.messages import broker_options, read_broker
from rivulet.util import scratch_dir

REPLACE = Modes(imode="replace", umode="replace", match="key")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_table_keeps_its_bucket_count(spark):
    path = scratch_dir(spark, "target")
    first = BucketedTable(spark, path, "id BIGINT, x STRING", ["id"], buckets=4)
    base = spark.range(40).select("id", F.lit("a").alias("x"))
    assert first.apply(0, base.select("id"), lambda _: base)
    again = BucketedTable(spark, path, "id BIGINT, x STRING", ["id"], buckets=6)
    assert again.buckets == 4
    new = spark.createDataFrame([(3, "b"), (7, "b")], "id BIGINT, x STRING")
    assert again.apply(1, new.select("id"), lambda old: old.join(new, "id", "left_anti").unionByName(new))
    assert rows(again.read()) == sorted([(k, "b" if k in (3, 7) else "a") for k in range(40)], key=str)
    with pytest.raises(ValueError, match="other keys or columns"):
        BucketedTable(spark, path, "id BIGINT, x STRING, y INT", ["id"])


def test_columns_named_like_the_folders_survive(spark):
    schema = "id BIGINT, v STRING, Bucket INT"
    table = BucketedTable(spark, scratch_dir(spark, "target"), schema, ["id"], buckets=3)
    data = spark.createDataFrame([(1, "x", 7), (2, "y", None), (3, None, 9)], schema)
    table.apply(0, data.select("id"), lambda _: data)
    assert rows(table.read()) == rows(data)


@pytest.mark.parametrize("spans", [64, 1])
def test_overlapping_intervals_keep_rows_once(spark, spans):
    sets = spark.createDataFrame([("a", 1, 10), ("a", 5, 20), ("a", 5, 20), ("b", 3, 3)], "sid string, lo bigint, hi bigint")
    df = spark.createDataFrame([("a", 7), ("a", 7), ("a", 15), ("a", 21), ("b", 3), ("c", 1), (None, 1)], "sid string, gno bigint")
    got = rows(covered(df, sets, spans_per_sid=spans))
    assert got == sorted([("a", 7, True)] * 2 + [("a", 15, True), ("a", 21, False), ("b", 3, True), ("c", 1, False), (None, 1, False)], key=str)


@pytest.mark.parametrize("cap", [2, 1000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_sum_of_nothing_is_null(spark, cap, inclusive):
    df = spark.createDataFrame([("g", k, None if k in (1, 4) else float(k)) for k in range(1, 9)], "k string, s bigint, x double")
    got = {r.s: r.t for r in running(df, ["k"], "s", {"t": ("sum", F.col("x"))}, inclusive, cap).collect()}
    want, seen = {}, None
    for k in range(1, 9):
        before = seen
        if k not in (1, 4):
            seen = (seen or 0) + k
        want[k] = seen if inclusive else before
    assert got == want


@pytest.mark.parametrize("cap", [2, 100_000])
def test_hot_and_cold_rows_are_equal_alike(spark, cap):
    row = "struct<k:bigint,x:double>"
    log = [(1, "insert", (1, 0.0), None), (2, "update", (1, 4.0), (1, -0.0)), (3, "update", (1, math.nan), (1, 4.0)), (4, "update", (1, 5.0), (1, math.nan))]
    changes = spark.createDataFrame(log, f"seq bigint, op string, row {row}, old {row}")
    assert rows(A.apply_fold(None, changes, ["k"], Modes(), cap)) == [(1, 5.0)]


def test_key_moves_in_ignore_mode(spark):
    row = "struct<k:bigint,x:bigint>"
    base = spark.createDataFrame([(1, 0), (2, 0)], "k bigint, x bigint")
    changes = spark.createDataFrame([(1, "update", (3, 5), (1, 0))], f"seq bigint, op string, row {row}, old {row}")
    assert rows(A.apply_changes(base, changes, ["k"], Modes(imode="ignore", match="key"))) == [(2, 0), (3, 5)]


def test_null_keys_meet_in_replace(spark):
    base = spark.createDataFrame([(None, "old"), (1, "one")], "k bigint, x string")
    changes = spark.createDataFrame([(1, "insert", (None, "new"))], "seq bigint, op string, row struct<k:bigint,x:string>")
    assert rows(A.apply_replace(base, changes, ["k"])) == sorted([(None, "new"), (1, "one")], key=str)


def test_bad_values_are_listed_and_bad_keys_do_not_merge(spark):
    data = [("insert", {"k": "x1", "n": "1"}), ("insert", {"k": "x2", "n": "2"}), ("insert", {"k": "3", "n": "bad"}), ("insert", {"k": "4", "n": None})]
    routed = spark.createDataFrame([(a, d, None, k) for k, (a, d) in enumerate(data)], "action string, data map<string,string>, old map<string,string>, m_offset bigint")
    columns = {"k": "bigint", "n": "int"}
    changes = A.changes_from(routed, columns, F.col("m_offset"), ["k"])
    assert rows(A.apply_changes(None, changes, ["k"], REPLACE)) == [(3, None), (4, None)]
    assert sorted((r.m_offset, r.bad) for r in A.rejected_rows(routed, columns).collect()) == [(0, ["k"]), (1, ["k"]), (2, ["n"])]


def test_binary_columns_hold_decoded_bytes(spark):
    routed = spark.createDataFrame([("insert", {"k": "1", "b": "aGVsbG8="}, None, 1), ("insert", {"k": "2", "b": "abc"}, None, 2)], "action string, data map<string,string>, old map<string,string>, m_offset bigint")
    columns = {"k": "bigint", "b": "binary"}
    changes = A.changes_from(routed, columns, F.col("m_offset"), ["k"])
    got = [(k, b if b is None else bytes(b)) for k, b in rows(A.apply_changes(None, changes, ["k"], REPLACE))]
    assert got == [(1, b"hello"), (2, None)]
    assert [r.bad for r in A.rejected_rows(routed, columns).collect()] == [["b"]]


def test_batch_reads_refuse_the_latest_message(spark):
    assert "maxOffsetsPerTrigger" not in broker_options("h:1", "t")
    assert broker_options("h:1", "t", per_trigger=5)["maxOffsetsPerTrigger"] == "5"
    with pytest.raises(ValueError, match="latest"):
        read_broker(spark, "h:1", "t", streaming=False, earliest=False)


ROW = "struct<k:bigint,s:string>"
CHANGE = f"seq bigint, op string, row {ROW}, old {ROW}"


@pytest.mark.parametrize("cap", [40, 100_000])
@pytest.mark.parametrize("modes", [Modes("ignore"), Modes("replace"), Modes("ignore", match="key"), Modes("replace", match="key", dmode="ignore"), Modes("ignore", umode="replace")])
def test_key_moves_equal_a_sequential_replay(spark, modes, cap):
    import random

    from tests.replay import Duplicate, replay_rows

    rng = random.Random(f"{modes}")
    base, log, state = {k: (k, "b") for k in range(0, 40, 2)}, [], {}
    for seq in range(400):
        key = rng.randrange(60)
        live = replay_rows(base, log, modes).get(key)
        op = rng.choice(["insert", "update", "move", "delete"])
        old = live if live and rng.random() < 0.7 else (key, rng.choice("xyz"))
        new = (key, rng.choice("abc"))
        if op == "move":
            op, new = "update", (key // 6 * 6 + rng.randrange(6), rng.choice("abc"))
        step = (seq, op, old if op == "delete" else new, old if op == "update" else None)
        try:
            replay_rows(base, [*log, step], modes)
        except Duplicate:
            continue
        log.append(step)
    assert sum(c[1] == "update" and c[3][0] != c[2][0] for c in log) > 20
    want = sorted(replay_rows(base, log, modes).values(), key=str)
    got = A.apply_changes(spark.createDataFrame(list(base.values()), "k bigint, s string"), spark.createDataFrame(log, CHANGE), ["k"], modes)
    if cap == 100_000:
        assert rows(got) == want
    else:
        got = A.apply_fold(spark.createDataFrame(list(base.values()), "k bigint, s string"), spark.createDataFrame(log, CHANGE), ["k"], modes, cap=max(cap, 120))
        assert rows(got) == want


def test_moves_onto_live_keys_and_unmatched_moves(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, s string")
    unmatched = spark.createDataFrame([(1, "update", (3, "c"), (1, "wrong"))], CHANGE)
    assert rows(A.apply_changes(base, unmatched, ["k"])) == [(1, "a"), (2, "b")]
    onto_live = spark.createDataFrame([(1, "update", (2, "c"), (1, "a"))], CHANGE)
    for modes in (Modes(), Modes("ignore"), Modes("replace")):
        with pytest.raises(Exception, match="duplicate key"):
            A.apply_changes(base, onto_live, ["k"], modes).collect()


@pytest.mark.parametrize("modes, cap, work", [(Modes("ignore"), 40, 200_000_000), (Modes("replace", match="key"), 1000, 90)])
def test_large_components_of_moves_are_replayed(spark, monkeypatch, modes, cap, work):
    import random

    from rivulet.operators import key_moves
    from tests.replay import Duplicate, replay_rows

    monkeypatch.setattr(key_moves, "FOLD_WORK", work)
    rng, log = random.Random(7), []
    base = {k: (k, "b") for k in [0, 1, 50, 51]}
    state = dict(base)
    while len(log) < 60:
        key, to = rng.choice(sorted(state)), rng.randrange(8)
        move = (len(log), "update", (to, rng.choice("abc")), state[key] if rng.random() < 0.8 else (key, "?"))
        try:
            state = replay_rows(state, [move], modes)
        except Duplicate:
            continue
        log.append(move)
    want = sorted(replay_rows(base, log, modes).values(), key=str)
    got = A.apply_fold(spark.createDataFrame(list(base.values()), "k bigint, s string"), spark.createDataFrame(log, CHANGE), ["k"], modes, cap=cap)
    assert rows(got) == want


def test_large_component_still_fails_on_a_live_key(spark):
    log = [(k, "update", (k + 1, "a"), (k, "a")) for k in range(1, 30)] + [(40, "update", (99, "a"), (30, "a"))]
    base = spark.createDataFrame([(1, "a"), (99, "b")], "k bigint, s string")
    with pytest.raises(Exception, match="duplicate key"):
        A.apply_fold(base, spark.createDataFrame(log, CHANGE), ["k"], Modes(), cap=20).collect()
