import random

import pytest

from rivulet.operators.apply_rows import Modes, apply_changes
from rivulet.sources.chunks import ChunkedSnapshot

KEYED = Modes(imode="replace", umode="replace", match="key")
CHANGE = "seq BIGINT, op STRING, row STRUCT<k: BIGINT, v: BIGINT>, old STRUCT<k: BIGINT, v: BIGINT>"


def make_log(seed, size):
    """Changes of 12 keys and of the NULL key; updates carry an old row of any key."""
    rng = random.Random(seed)
    log = []
    for seq in range(1, size + 1):
        op = rng.choices(["insert", "update", "delete"], [3, 4, 2])[0]
        key = rng.choice([None, *range(12)])
        old = (rng.choice([key, rng.randrange(12)]), 0) if op == "update" else None
        log.append((seq, op, (key, seq * 10), old))
    return log


def replay(state, log, upto):
    state = dict(state)
    for seq, op, (k, v), _ in log:
        if seq <= upto:
            if op == "delete":
                state.pop(k, None)
            else:
                state[k] = v
    return state


class Source:
    """A table that shows its log up to `now`, and moves on whenever it is asked."""

    def __init__(self, spark, base, log, seed):
        self.spark, self.base, self.log, self.now = spark, base, log, 2
        self.rng = random.Random(seed)

    def position(self):
        return self.now

    def read(self):
        self.now += self.rng.randrange(4)
        rows = list(replay(self.base, self.log, self.now).items())
        self.now += self.rng.randrange(4)
        return self.spark.createDataFrame(rows, "k BIGINT, v BIGINT")


def state_of(frame):
    rows = [(r["k"], r["v"]) for r in frame.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chunks_and_log_equal_the_replay(spark, tmp_path, seed):
    base = {k: -k for k in range(0, 24, 2)} | {None: -1}
    log = make_log(seed, 60)
    changes = spark.createDataFrame(log, CHANGE)
    source = Source(spark, base, log, seed)

    def snapshot():
        return ChunkedSnapshot(spark, str(tmp_path / "s"), "k", source.read, source.position, 4)

    assert not snapshot().run(1)  # stopped between chunks
    assert snapshot().marks().count() == 1
    assert snapshot().run()
    taken = [(r["low"], r["high"]) for r in snapshot().marks().orderBy("chunk").collect()]
    assert snapshot().run() and len(taken) == 4  # nothing is read again
    assert [(r["low"], r["high"]) for r in snapshot().marks().orderBy("chunk").collect()] == taken
    whole = snapshot().follow(changes)
    end = taken[-1][1]
    for upto in (end, end + 5, 60):  # exact at every moment after the last chunk
        found = apply_changes(None, whole.where(f"seq <= {upto}"), ["k"], KEYED)
        assert state_of(found) == replay(base, log, upto)
    assert whole.groupBy("seq", "row.k").count().where("count > 1").isEmpty()


def test_a_failed_chunk_is_read_again(spark, tmp_path):
    base, log = {k: -k for k in range(12)}, make_log(7, 40)
    source = Source(spark, base, log, 7)
    calls = iter([True, True, True, False])

    def failing():
        if not next(calls):
            raise OSError("no position")  # rows are there, their mark is not
        return source.position()

    with pytest.raises(OSError):
        ChunkedSnapshot(spark, str(tmp_path / "s"), "k", source.read, failing, 3).run()
    again = ChunkedSnapshot(spark, str(tmp_path / "s"), "k", source.read, source.position, 3)
    assert again.marks().count() == 1
    changes = spark.createDataFrame(log, CHANGE)
    assert set(r["op"] for r in again.follow(changes).where("row.v <= 0").collect()) <= {"insert"}
    assert again.run()
    found = apply_changes(None, again.follow(changes), ["k"], KEYED)
    assert state_of(found) == replay(base, log, 40)


def test_edge_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "k BIGINT, v BIGINT")
    log = spark.createDataFrame([(1, "insert", (5, 6), None)], CHANGE)
    none = ChunkedSnapshot(spark, str(tmp_path / "a"), "k", lambda: empty, lambda: 0, 4)
    assert none.follow(log).isEmpty() and none.run()
    assert state_of(apply_changes(None, none.follow(log), ["k"], KEYED)) == {5: 6}
    wide = spark.createDataFrame([(1, 2, 3), (1, 2, 3)], "chunk BIGINT, v BIGINT, k BIGINT")
    odd = ChunkedSnapshot(spark, str(tmp_path / "b"), "k", lambda: wide, lambda: 0, 1)
    assert odd.run()  # own columns named like ours, and rows that repeat
    assert [(r["seq"], r["row"]) for r in odd.follow(log).where("row.k = 3").collect()] == [(0, (3, 2))] * 2
    with pytest.raises(ValueError, match="at least one"):
        ChunkedSnapshot(spark, str(tmp_path / "c"), "k", lambda: empty, lambda: 0, 0)
    back = iter([5, 4])
    with pytest.raises(ValueError, match="went back"):
        ChunkedSnapshot(spark, str(tmp_path / "d"), "k", lambda: empty, lambda: next(back), 1).run()
