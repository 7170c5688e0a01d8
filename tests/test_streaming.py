import json
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators.apply_rows import Modes
from rivulet.operators.envelope import encode_messages
from rivulet.operators.gates import gate_offsets
from rivulet.operators.progress import consumer_progress, progress_tokens, resume_after, starting_offsets
from rivulet.sinks.messages import write_files
from rivulet.sinks.tables import BucketedTable, merge_statement
from rivulet.sources.messages import broker_options, read_files, topic_list
from rivulet.streaming import (
    BatchStore,
    apply_documents_stream,
    apply_rows_stream,
    drain,
    gate_stream,
)
from rivulet.streaming.apply import progress_store
from rivulet.streaming.gate import position_store
from tests.fixtures import as_messages
from tests.replay import replay_documents, replay_gate, replay_rows

COLUMNS = {"k": "bigint", "s": "string"}
DDL = "k BIGINT, s STRING"


def row_log(seed, size):
    rng = random.Random(seed)
    log = []
    for seq in range(size):
        op = rng.choices(["insert", "update", "delete"], [3, 5, 2])[0]
        row = (rng.randrange(15), rng.choice(["x", "y", None]))
        old = (row[0], rng.choice(["x", "y", None])) if op == "update" else None
        log.append((seq, op, row, old))
    return log


def envelope(op, row, old):
    value = {"type": op, "database": "d", "table": "t", "data": dict(zip("ks", row, strict=True))}
    if old:
        value["old"] = dict(zip("ks", old, strict=True))
    return value


def append(spark, path, log):
    sent = as_messages(spark, [envelope(op, row, old) for _, op, row, old in log], "d-t")
    first = log[0][0]
    write_files(sent.withColumn("offset", F.col("offset") + first).coalesce(1), path)


@pytest.mark.parametrize(
    "modes", [Modes("replace", "replace", match="key"), Modes("ignore")], ids=["keyed", "native"]
)
def test_stream_equals_the_replay_over_restarts(spark, tmp_path, modes):
    home, log = str(tmp_path), row_log(3, 300)
    target = BucketedTable(spark, f"{home}/target", DDL, ["k"], buckets=4)
    progress = progress_store(spark, f"{home}/progress")
    for part in (log[:90], log[90:100], log[100:]):
        append(spark, f"{home}/log", part)
        stream = read_files(spark, f"{home}/log", "d-t", streaming=True, files_per_trigger=1)
        query = apply_rows_stream(
            stream, target, COLUMNS, f"{home}/checkpoint", modes, progress=progress
        )
        drain(query)
    want = sorted(replay_rows({}, log, modes).values(), key=str)
    assert sorted((tuple(r) for r in target.read().select("k", "s").collect()), key=str) == want
    assert target.last_batch() == 2
    assert [tuple(r) for r in progress.before().select("token", "next_offset").collect()] == [("d-t.0", 300)]
    # Nothing new: a further run changes nothing.
    drain(apply_rows_stream(stream, target, COLUMNS, f"{home}/checkpoint", modes))
    assert target.last_batch() == 2


def test_replayed_batch_is_skipped_and_failed_batch_leaves_no_trace(spark, tmp_path):
    target = BucketedTable(spark, str(tmp_path / "t"), DDL, ["k"], buckets=4)
    rows = spark.createDataFrame([(n, "a") for n in range(20)], DDL)
    assert target.read().count() == 0
    assert target.apply(0, rows.select("k"), lambda base: base.unionByName(rows))
    assert not target.apply(0, rows.select("k"), lambda base: base.unionByName(rows))
    assert target.read().count() == 20
    one = rows.where("k = 3")
    changed = one.withColumn("s", F.lit("b"))

    def failing(base):
        rest = base.where("k <> 3").unionByName(changed)
        return rest.withColumn("s", F.when(F.col("k") == 3, F.raise_error(F.lit("stop"))).otherwise("z"))

    with pytest.raises(Exception, match="stop"):
        target.apply(1, one.select("k"), failing)
    assert target.read().where("s = 'a'").count() == 20
    assert target.apply(1, one.select("k"), lambda base: base.where("k <> 3").unionByName(changed))
    assert {r["k"] for r in target.read().where("s = 'b'").collect()} == {3}
    assert target.apply(2, rows.select("k"), lambda base: base.limit(0))
    assert target.read().count() == 0
    assert target.apply(3, rows.limit(0).select("k"), lambda base: base)
    assert target.last_batch() == 3


def test_small_batch_touches_few_buckets(spark, tmp_path):
    target = BucketedTable(spark, str(tmp_path / "t"), DDL, ["k"], buckets=16)
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("s"))
    target.apply(0, rows.select("k"), lambda base: base.unionByName(rows))
    seen = []
    one = rows.where("k = 7")
    target.apply(1, one.select("k"), lambda base: seen.append(base.count()) or base)
    assert 0 < seen[0] < 60 and target.read().count() == 200


def test_document_stream(spark, tmp_path):
    home, rng, log = str(tmp_path), random.Random(5), []
    for seq in range(200):
        op = rng.choices(["insert", "replace", "delete"], [2, 5, 1])[0]
        doc = None if op == "delete" else {rng.choice("abc"): rng.choice(["1", None])}
        log.append((seq, op, f"d{rng.randrange(9)}", doc))
    target = BucketedTable(spark, f"{home}/target", "_id STRING, doc MAP<STRING,STRING>", ["_id"], 4)
    for part in (log[:120], log[120:]):
        sent = [
            {"operationType": op, "ns": {"db": "d", "coll": "c"}, "documentKey": {"_id": key}, "fullDocument": doc}
            for _, op, key, doc in part
        ]
        rows = as_messages(spark, sent, "d-c").withColumn("offset", F.col("offset") + part[0][0])
        write_files(rows.coalesce(1), f"{home}/log")
        stream = read_files(spark, f"{home}/log", streaming=True)
        drain(apply_documents_stream(stream, target, f"{home}/checkpoint"))
    got = {r["_id"]: r["doc"] for r in target.read().collect()}
    assert got == replay_documents({}, log)


def test_stream_gate_carries_positions_over_restarts(spark, tmp_path):
    home, rng = str(tmp_path), random.Random(9)
    events = [(s, rng.choice("ab"), s * 10 - rng.choice([0, 0, 400])) for s in range(300)]
    for part in (events[:100], events[100:210], events[210:]):
        frame = spark.createDataFrame(part, "seq BIGINT, tbl STRING, ts BIGINT")
        frame.write.mode("append").parquet(f"{home}/log")
        stream = spark.readStream.schema(frame.schema).parquet(f"{home}/log")
        drain(gate_stream(stream, ["tbl"], f"{home}/state", f"{home}/out", f"{home}/checkpoint"))
    got = spark.read.schema(frame.schema).parquet(f"{home}/out").select("seq", "tbl", "ts")
    assert sorted(tuple(r) for r in got.collect()) == replay_gate(events)
    last = position_store(spark, f"{home}/state", ["tbl"]).before()
    want = {t: max(ts for _, x, ts in events if x == t) for t in "ab"}
    assert {r["tbl"]: r["time"] for r in last.collect()} == want


def test_gate_that_keeps_running_and_starts_again(spark, tmp_path):
    rng = random.Random(4)
    events = [(seq, rng.choice("ab"), rng.randrange(60)) for seq in range(60)]
    home = str(tmp_path)
    for low, trigger in ((0, {"processingTime": "0 seconds"}), (40, {"processingTime": "1 second"})):
        query = None
        for at in range(low, min(low + 40, 60), 20):
            frame = spark.createDataFrame(events[at : at + 20], "seq BIGINT, tbl STRING, ts BIGINT")
            frame.coalesce(1).write.mode("append").parquet(f"{home}/log")
            if query is None:
                stream = spark.readStream.schema(frame.schema).parquet(f"{home}/log")
                query = gate_stream(
                    stream, ["tbl"], f"{home}/state", f"{home}/out", f"{home}/cp", trigger=trigger
                )
            query.processAllAvailable()
        assert query.isActive
        query.stop()
    got = spark.read.schema(frame.schema).parquet(f"{home}/out").select("seq", "tbl", "ts")
    assert sorted(tuple(r) for r in got.collect()) == replay_gate(events)


def test_batch_store_reads_what_held_before_a_batch(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "s"), "k STRING, v INT")
    assert store.before() is None
    for batch in (0, 1, 3):
        store.save(batch, spark.createDataFrame([("a", batch)], "k STRING, v INT"))
    assert store.before(0) is None
    assert [r["v"] for r in store.before(3).collect()] == [1]
    assert [r["v"] for r in store.before().collect()] == [3]


def test_message_sink_as_a_stream(spark, tmp_path):
    home = str(tmp_path)
    spark.createDataFrame([("x", "1"), ("y", "2")], "topic STRING, data STRING").write.json(f"{home}/in")
    stream = spark.readStream.schema("topic STRING, data STRING").json(f"{home}/in")
    drain(write_files(encode_messages(stream), f"{home}/out", checkpoint=f"{home}/cp"))
    got = read_files(spark, f"{home}/out")
    assert {(r["topic"], r["value"]) for r in got.collect()} == {
        ("x", '{"topic":"x","data":"1"}'), ("y", '{"topic":"y","data":"2"}'),
    }
    plan = read_files(spark, f"{home}/out", topics="x")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan


def test_resume_from_tokens(spark):
    rows = [("a.b", 0, n, "v") for n in range(4)] + [("c", 1, n, "v") for n in range(3)]
    messages = spark.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT, value STRING")
    tokens = progress_tokens(consumer_progress(messages.where("topic = 'a.b' and offset < 2")))
    left = resume_after(messages, tokens)
    assert sorted((r["topic"], r["offset"]) for r in left.collect()) == [
        ("a.b", 2), ("a.b", 3), ("c", 0), ("c", 1), ("c", 2),
    ]
    assert json.loads(starting_offsets(tokens)) == {"a.b": {"0": 2}}
    options = broker_options("h:1", "a.b, c", tokens=tokens)
    assert options["subscribe"] == "a.b,c" and json.loads(options["startingOffsets"]) == {"a.b": {"0": 2}}
    assert broker_options("h:1", ["a"], earliest=False)["startingOffsets"] == "latest"
    assert topic_list("a, b,") == ["a", "b"]


def test_merge_statement_parses(spark):
    text = merge_statement("db.t", "changes", ["k", "s"], ["k"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "MergeIntoTable" in plan and "delete" in text
    assert "DELETE" not in merge_statement("db.t", "changes", ["k"], ["k"], dmode="ignore")


def test_offset_gate_works_on_streams(spark, tmp_path):
    home = str(tmp_path)
    rows = spark.createDataFrame([("t", 2, n) for n in (1, 2, 3)], "tbl STRING, ts BIGINT, row_no INT")
    rows.write.parquet(f"{home}/in")
    positions = spark.createDataFrame([("t", 2, 2)], "tbl STRING, time BIGINT, inc INT")
    stream = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
    query = (
        gate_offsets(stream, ["tbl"], positions)
        .writeStream.option("checkpointLocation", f"{home}/cp")
        .trigger(availableNow=True)
        .start(f"{home}/out", format="parquet")
    )
    drain(query)
    assert sorted(r["row_no"] for r in spark.read.parquet(f"{home}/out").collect()) == [2, 3]
