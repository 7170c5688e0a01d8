"""Replays over keys of every awkward type: one digest, NULLs as a key like any other."""

import datetime as dt
import math
import random

import pytest

from rivulet.operators import apply_rows as A
from rivulet.operators.apply_rows import Modes
from tests.replay import Duplicate, replay_rows

START = dt.datetime(2024, 5, 1)
MICROS = [START + dt.timedelta(microseconds=n) for n in (1, 5, 8, 9, 3000, 3001, 5001, 5002)]
KEYS = {"timestamp": MICROS, "timestamp_ntz": MICROS, "double": [0.0, -0.0, math.inf, 1.5, 1e300], "bigint": [1, 2, 3, 4, 5]}
MODES = [
    Modes(), Modes(match="key"), Modes("ignore"), Modes("ignore", match="key"),
    Modes("replace", "replace", match="key"), Modes("replace", "replace"),
]




def log_of(keys, seed, modes, moves):
    """A log without duplicate-key errors, with moves between keys where they are wanted."""
    rng, log, state = random.Random(seed), [], {}
    for seq in range(60):
        op = rng.choice(["insert", "update", "update", "delete"])
        key = rng.choice(keys)
        row = (key, rng.randrange(3))
        old = None
        if op == "update":
            from_ = rng.choice(keys) if moves and rng.random() < 0.5 else key
            held = state.get(from_)
            old = (from_, held[1] if held and rng.random() < 0.8 else 9)
        elif op == "delete" and key in state and rng.random() < 0.7:
            row = (key, state[key][1])
        try:
            state = replay_rows(state, [(seq, op, row, old)], modes)
        except Duplicate:
            continue
        log.append((seq, op, row, old))
    return log


def got(spark, base, log, kind, modes, cap):
    row = f"struct<k:{kind},v:bigint>"
    changes = spark.createDataFrame(log, f"seq bigint, op string, row {row}, old {row}").coalesce(2)
    start = spark.createDataFrame(base, f"k {kind}, v bigint").coalesce(1)
    if cap:
        out = A.apply_fold(start, changes, ["k"], modes, cap)
    else:
        out = A.apply_changes(start, changes, ["k"], modes)
    return sorted((str(None if k is None else k + 0 if isinstance(k, float) else k), v) for k, v in map(tuple, out.collect()))


def want(base, log, modes):
    end = replay_rows({r[0]: r for r in base}, log, modes)
    return sorted((str(None if k is None else k + 0 if isinstance(k, float) else k), v) for k, v in end.values())


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("modes", MODES, ids=lambda m: f"{m.imode}-{m.umode}-{m.match}")
def test_awkward_keys(spark, kind, modes):
    keys = [*KEYS[kind], None]
    moves = modes.umode == "native"
    base = [(None, 1), (keys[0], 2)]
    first = {r[0]: r for r in base}
    log = [c for c in log_of(keys, len(kind), modes, moves)]
    kept = []
    for change in log:
        try:
            first = replay_rows(first, [change], modes)
        except Duplicate:
            continue
        kept.append(change)
    assert got(spark, base, kept, kind, modes, None) == want(base, kept, modes)


@pytest.mark.parametrize("cap", [2, 100_000])
def test_moves_by_a_microsecond(spark, cap):
    k1, k5, k8, k9, k3000, k3001, k5001, k5002 = MICROS
    base = [(k1, 1), (k8, 7), (k3000, 3), (k3001, 4)]
    log = [
        (1, "update", (k5, 1), (k1, 1)), (2, "update", (k9, 7), (k8, 7)),
        (3, "update", (k5001, 3), (k3000, 3)), (4, "insert", (k5002, 6), None),
    ]
    assert got(spark, base, log, "timestamp", Modes(), cap) == want(base, log, Modes())


@pytest.mark.parametrize("modes", [Modes(match="key"), Modes("ignore", match="key"), Modes("replace", "replace", match="key")], ids=["fold", "ignore", "replace"])
@pytest.mark.parametrize("cap", [None, 2])
def test_null_key_takes_updates(spark, modes, cap):
    log = [(n, "update", (None, n), (None, n - 1)) for n in range(2, 9)] + [(20, "insert", (4, 4), None)]
    assert got(spark, [(None, 1)], log, "bigint", modes, cap) == [("4", 4), ("None", 8)]
