import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators.gates import gate_alignment, gate_documents, gate_offsets, gate_rows
from rivulet.operators.gtid import compact, covered, parse_sets, sets_contain
from tests.replay import replay_gate


def late_log(seed, size=1500):
    rng = random.Random(seed)
    return [
        (seq, "hot" if rng.random() < 0.5 else rng.choice("abc"), seq * 10 - rng.choice([0, 0, 5, 300]))
        for seq in range(size)
    ]


@pytest.mark.parametrize("cap", [100, 100_000])
@pytest.mark.parametrize("stored", [None, {"hot": 4000, "a": 10**9}])
def test_row_gate_equals_the_sequential_gate(spark, cap, stored):
    events = late_log(3)
    log = spark.createDataFrame(events, "seq BIGINT, tbl STRING, ts BIGINT")
    positions = None
    if stored:
        positions = spark.createDataFrame(
            [(k, v, 0) for k, v in stored.items()], "tbl STRING, time BIGINT, inc INT"
        )
    got = gate_rows(log, ["tbl"], positions=positions, cap=cap)
    assert sorted(tuple(r) for r in got.collect()) == replay_gate(events, stored)


def test_document_gate_compares_time_then_increment(spark):
    rng = random.Random(8)
    events = [(s, rng.choice("ab"), (s // 7 - rng.choice([0, 1]), rng.randrange(3))) for s in range(600)]
    log = spark.createDataFrame(
        [(s, t, p) for s, t, p in events], "seq BIGINT, coll STRING, clusterTime STRUCT<time: BIGINT, inc: INT>"
    )
    got = gate_documents(log, ["coll"], cap=80)
    assert sorted(r["seq"] for r in got.collect()) == [s for s, _, _ in replay_gate(events)]


def test_offset_gate(spark):
    rows = [("t", ts, n) for ts in (1, 2, 3) for n in (1, 2, 3)] + [("u", 1, 1)]
    log = spark.createDataFrame(rows, "tbl STRING, ts BIGINT, row_no INT")
    positions = spark.createDataFrame([("t", 2, 2)], "tbl STRING, time BIGINT, inc INT")
    got = sorted(tuple(r) for r in gate_offsets(log, ["tbl"], positions).collect())
    assert got == [("t", 2, 2), ("t", 2, 3), ("t", 3, 1), ("t", 3, 2), ("t", 3, 3), ("u", 1, 1)]


def test_gtid_set_texts(spark):
    text = "a:1-5:11-18,\n b:7, c : 2-3"
    got = parse_sets(spark.createDataFrame([(1, text)], "id INT, s STRING"), "s")
    assert sorted(tuple(r)[1:] for r in got.collect()) == [
        ("a", 1, 5), ("a", 11, 18), ("b", 7, 7), ("c", 2, 3),
    ]


def test_gtid_sets_compare_one_way(spark):
    own = "s1:1-10,s2:1-5:7-9,s3:1"
    cases = [own, "s1:1-10", "s1:1-11", "s2:1-5", "s9:1", "s2:1-5:7-9,s3:1", "s1:2-10"]
    frame = spark.createDataFrame([(i, own, c) for i, c in enumerate(cases)], "id INT, a STRING, b STRING")
    left = parse_sets(frame.select("id", "a"), "a")
    right = parse_sets(frame.select("id", "b"), "b")
    got = {r["id"]: r["is_equal"] for r in sets_contain(left, right, ["id"]).collect()}
    assert [got[i] for i in range(len(cases))] == [True, True, False, False, False, True, False]


@pytest.mark.parametrize("spans_per_sid", [64, 0])
def test_covered_by_broadcast_and_by_merge(spark, spans_per_sid):
    rng = random.Random(4)
    spans, have = [], set()
    for sid in ("a", "b"):
        at = 1
        while at < 900:
            hi = at + rng.randrange(20)
            spans.append((sid, at, hi))
            have.update((sid, n) for n in range(at, hi + 1))
            at = hi + 2 + rng.randrange(20)
    rows = [(i, rng.choice("abc"), rng.randrange(1000)) for i in range(1200)]
    log = spark.createDataFrame(rows, "seq BIGINT, sid STRING, gno BIGINT")
    intervals = spark.createDataFrame(spans, "sid STRING, lo BIGINT, hi BIGINT")
    got = covered(log, intervals, cap=100, spans_per_sid=spans_per_sid)
    assert sorted((r["seq"], r["covered"]) for r in got.collect()) == [
        (i, (s, n) in have) for i, s, n in rows
    ]


def test_executed_set_of_a_log(spark):
    numbers = [n for n in range(1, 400) if n % 17]
    rows = [("a", n) for n in numbers] + [("a", numbers[0]), ("b", 5)]
    log = spark.createDataFrame(rows, "sid STRING, gno BIGINT")
    got = sorted(tuple(r) for r in compact(log, cap=50).select("sid", "lo", "hi").collect())
    want, low = [], 1
    for stop in [*range(17, 400, 17), 400]:
        want.append(("a", low, stop - 1))
        low = stop + 1
    assert got == [*want, ("b", 5, 5)]


def test_alignment_gate(spark):
    rows = [(i, "s", i, i % 2 == 0) for i in range(1, 21)]
    log = spark.createDataFrame(rows, "seq BIGINT, sid STRING, gno BIGINT, fresh BOOLEAN")
    snapshot = spark.createDataFrame([("s", 1, 9), ("s", 13, 14)], "sid STRING, lo BIGINT, hi BIGINT")
    got = sorted(r["seq"] for r in gate_alignment(log, snapshot, F.col("fresh")).collect())
    assert got == [n for n in range(1, 21) if n % 2 or n >= 10]
    nothing = snapshot.limit(0)
    assert gate_alignment(log, nothing, F.col("fresh")).count() == 20
