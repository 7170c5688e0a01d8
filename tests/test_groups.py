import json

import pytest

from rivulet.operators.apply_rows import Modes
from rivulet.schemas import MESSAGE
from rivulet.sinks.groups import TableGroup
from rivulet.sinks.tables import BucketedTable
from rivulet.streaming.apply import apply_tables_stream, progress_store
from rivulet.streaming.store import drain

DDL = "k BIGINT, s STRING"


def opened(spark, home, names=("a", "b")):
    return {n: BucketedTable(spark, f"{home}/{n}", DDL, ["k"], buckets=2) for n in names}


def group_of(spark, home):
    return TableGroup(spark, f"{home}/group", opened(spark, home), progress_store(spark, f"{home}/progress"))


def rows(table):
    return sorted(tuple(r) for r in table.read().collect())


def change(spark, *made):
    new = spark.createDataFrame(list(made), DDL)
    return new.select("k"), lambda base: new


def save(spark, group, batch):
    token = spark.createDataFrame([("t.0", batch)], "token string, next_offset long")
    return lambda: group.progress.save(batch, token)


def test_a_failed_batch_shows_nowhere_and_a_committed_one_everywhere(spark, tmp_path, monkeypatch):
    home = str(tmp_path)
    group = group_of(spark, home)
    assert group.position() is None and group.last_batch() is None
    both = {"a": change(spark, (1, "x")), "b": change(spark, (2, "y"))}
    assert group.apply(0, both, save(spark, group, 0))
    assert not group.apply(0, both, save(spark, group, 0))
    assert [rows(t) for t in opened(spark, home).values()] == [[(1, "x")], [(2, "y")]]

    more = {"a": change(spark, (1, "xx")), "b": change(spark, (3, "z"))}
    real = BucketedTable.prepare

    def no_b(self, *args):
        if self.runs.endswith("/b/runs"):
            raise OSError("prepare b")
        return real(self, *args)

    with monkeypatch.context() as m:
        m.setattr(BucketedTable, "prepare", no_b)
        with pytest.raises(OSError, match="prepare b"):
            group.apply(1, more, save(spark, group, 1))
    assert [rows(t) for t in opened(spark, home).values()] == [[(1, "x")], [(2, "y")]]
    assert [r["next_offset"] for r in group_of(spark, home).position().collect()] == [0]

    written = BucketedTable.commit

    def no_b_record(self, record):
        if self.runs.endswith("/b/runs"):
            raise OSError("record b")
        written(self, record)

    with monkeypatch.context() as m:
        m.setattr(BucketedTable, "commit", no_b_record)
        with pytest.raises(OSError, match="record b"):
            group.apply(1, more, save(spark, group, 1))
    want = [[(1, "xx")], [(2, "y"), (3, "z")]]
    assert [rows(t) for t in opened(spark, home).values()] == want
    assert [r["next_offset"] for r in group_of(spark, home).position().collect()] == [1]

    again = group_of(spark, home)
    assert again.last_batch() == 1 and not again.apply(1, more)
    assert again.apply(2, {"a": change(spark, (9, "n"))}) and again.manifest.batches() == [2]
    assert [rows(t) for t in opened(spark, home).values()] == [[(1, "xx"), (9, "n")], want[1]]
    assert again.apply(3, {"b": change(spark, (2, "v"))})
    assert rows(again.tables["b"]) == [(2, "v"), (3, "z")]
    with pytest.raises(ValueError, match="another manifest"):
        TableGroup(spark, f"{home}/other", opened(spark, home))


def test_stream_into_a_group(spark, tmp_path):
    home = str(tmp_path)
    made = [
        ("t", 0, n, json.dumps({"type": "insert", "database": "d", "table": "ab"[n % 2], "ts": n, "data": {"k": str(n), "s": f"v{n}"}}))
        for n in range(10)
    ]
    spark.createDataFrame(made, MESSAGE).write.parquet(f"{home}/log")
    group = TableGroup(
        spark, f"{home}/group", {f"d.{n}": t for n, t in opened(spark, home).items()}, progress_store(spark, f"{home}/progress")
    )
    targets = {n: (t, {"k": "bigint", "s": "string"}) for n, t in group.tables.items()}
    stream = spark.readStream.schema(MESSAGE).parquet(f"{home}/log")
    modes = Modes(imode="replace", umode="replace", match="key")
    drain(apply_tables_stream(stream, targets, f"{home}/checkpoint", modes, group=group))
    assert rows(group.tables["d.a"]) == [(n, f"v{n}") for n in range(0, 10, 2)]
    assert rows(group.tables["d.b"]) == [(n, f"v{n}") for n in range(1, 10, 2)]
    assert [tuple(r) for r in group.position().collect()] == [("t.0", 10)] and group.last_batch() == 0
    with pytest.raises(ValueError, match="group must hold"):
        apply_tables_stream(stream, {"d.a": targets["d.a"]}, f"{home}/c2", modes, group=group)
