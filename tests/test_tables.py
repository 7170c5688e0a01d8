"""The log-structured target table: cost, merging, splitting, expiry, lost batches."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rivulet.sinks.commits import CommitLog, Run, State, bucket_of
from rivulet.sinks.tables import BucketedTable
from rivulet.util import scratch_dir

DDL = "k BIGINT, s STRING, gone INT"


class Small(BucketedTable):
    FAN, LEAST, FILE_ROWS = 3, 6, 10


def size(path):
    found = {}
    for folder, _, files in os.walk(path):
        for f in files:
            found[f"{folder}/{f}"] = os.path.getsize(f"{folder}/{f}")
    return found


def put(table, spark, batch, rows, removed=()):
    frame = spark.createDataFrame([(k, s, None) for k, s in rows.items()], DDL)
    keys = spark.createDataFrame([(k,) for k in [*rows, *removed]], "k BIGINT")
    return table.apply(batch, keys, lambda _: frame)


def held(table, buckets=None):
    return {r["k"]: r["s"] for r in table.read(buckets).collect()}


def test_one_row_batch_on_a_million_rows_writes_one_row(spark):
    path = scratch_dir(spark, "target")
    table = BucketedTable(spark, path, DDL, ["k"], buckets=8, bucket_rows=100_000)
    rows = spark.range(1_000_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"), F.lit(1).alias("gone"))
    assert table.apply(0, rows.select("k"), lambda _: rows)
    assert put(table, spark, 1, {5: "first"})
    before = size(path)
    assert put(table, spark, 2, {7: "x"}, [8, -1])
    new = {f: n for f, n in size(path).items() if f not in before}
    assert sum(before.values()) > 5_000_000 and sum(new.values()) < 30_000, new
    assert not any("/base/" in f for f in new)
    got = table.read()
    assert got.count() == 999_999 and got.where("k in (5, 7, 8)").count() == 2
    # the base is not shuffled for a few changes
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_grows_by_single_splits_and_stays_balanced(spark):
    table = BucketedTable(spark, scratch_dir(spark, "target"), DDL, ["k"], buckets=2, bucket_rows=1_000)
    counts, all_rows = [], 0
    for batch, n in enumerate([1_000, 1_500, 2_500, 20_000, 75_000, 100]):
        rows = spark.range(all_rows, all_rows + n).select(F.col("id").alias("k"), F.lit("a").alias("s"), F.lit(1).alias("gone"))
        table.apply(batch, rows.select("k"), lambda _, rows=rows: rows)
        all_rows += n
        counts.append(table.log.state().buckets)
    assert counts == [2, 3, 5, 25, 100, 101] and table.read().count() == all_rows
    # all rows in their buckets, and the largest one within twice the aim
    sizes = table.read().groupBy(table._bucket(101)).count().collect()
    assert max(r["count"] for r in sizes) <= 2 * 1_000 and len(sizes) == 101
    again = BucketedTable(spark, table.base.removesuffix("/base"), DDL, ["k"], buckets=7)
    assert again.buckets == 2 and again.read([3]).count() == {r[0]: r[1] for r in sizes}[3]


@pytest.mark.parametrize("seed", [1])
def test_equals_a_dictionary_over_many_batches(spark, seed):
    rng, model = random.Random(seed), {}
    path = scratch_dir(spark, "target")
    table = Small(spark, path, DDL, ["k"], buckets=2, bucket_rows=12, keep=1)
    for batch in range(16):
        n = rng.choice([1, 1, 2, 9])
        keys = rng.sample([None, *range(60)], n)
        removed = {k for k in keys if rng.random() < 0.3}
        rows = {k: f"{batch}" for k in keys if k not in removed}
        assert put(table, spark, batch, rows, removed)
        model = {k: s for k, s in (model | rows).items() if k not in removed}
        if batch % 3 == 2:
            assert held(table) == model
        if batch == 10:  # a replay changes nothing, an opened table goes on
            assert not put(table, spark, batch, {1: "again"})
            table = Small(spark, path, DDL, ["k"], keep=1)
    state = table.log.state()
    assert held(table) == model and state.buckets > 2
    both = {}
    for b in range(state.buckets):
        both |= held(table, [b])
    assert both == model
    # merged runs and rewritten buckets leave no files behind
    folders = {f.split("/runs/")[1].split("/")[0] for f in size(f"{path}/runs") if f.endswith(".parquet")}
    waiting = {p.split("/")[-1] for p, _ in state.trash if "/runs/" in p}
    assert folders - waiting == {f"v={at}" for at in state.runs}
    assert len(os.listdir(f"{path}/commits")) < 33 and len(state.runs) <= 8


def test_a_reader_keeps_its_files_for_some_batches(spark):
    table = Small(spark, scratch_dir(spark, "target"), DDL, ["k"], buckets=1, keep=4)
    for batch in range(3):
        put(table, spark, batch, {k: f"{batch}" for k in range(8)})
    old = table.read()
    for batch in range(3, 6):
        put(table, spark, batch, {k: f"{batch}" for k in range(8)})
    assert {r["s"] for r in old.collect()} == {"2"} and set(held(table).values()) == {"5"}


def test_a_batch_that_fails_before_its_commit_is_not_there(spark, monkeypatch):
    table = Small(spark, scratch_dir(spark, "target"), DDL, ["k"], buckets=1, bucket_rows=4)
    put(table, spark, 0, {k: "a" for k in range(9)})

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", stop)
        with pytest.raises(RuntimeError):
            put(table, spark, 1, {k: "b" for k in range(20)}, [30])
    assert table.last_batch() == 0 and set(held(table).values()) == {"a"}
    assert put(table, spark, 1, {k: "c" for k in range(20)})
    assert set(held(table).values()) == {"c"} and len(held(table)) == 20


def test_commit_log_reads_the_same_state_at_any_length(spark):
    log, state = CommitLog(spark, scratch_dir(spark, "commits"), 4), State(None, 4)
    for batch in range(40):
        runs = {at: r for at, r in state.runs.items() if at > batch - 3} | {batch: Run(0, 4 + batch, {batch % 4: 5})}
        base = state.base | ({batch % 5: (batch, 10)} if batch % 2 else {})
        trash = [t for t in state.trash if t[1] > batch - 2] + [(f"f{batch}", batch)]
        after = State(batch, 4 + batch, base, runs, trash)
        log.commit(state, after)
        log.expire()
        state = after
        if batch % 7 == 0 or batch > 36:
            assert log.state() == state
    assert len(log._records()) <= 32


def test_linear_hashing_moves_rows_of_the_split_bucket_only():
    for first in (1, 3, 8):
        for count in range(first, 6 * first):
            for h in (*range(0, 500), -7, -(2**62)):
                old, new = bucket_of(h, first, count), bucket_of(h, first, count + 1)
                assert 0 <= old < count and (new == old or (new == count and old == bucket_of(count, first, count)))
