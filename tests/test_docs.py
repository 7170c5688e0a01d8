import json
import random

from pyspark.sql import functions as F

from rivulet.operators.apply_docs import (
    apply_documents,
    document_changes,
    inserts_on_live_documents,
    row_changes_as_documents,
)
from rivulet.operators.envelope import decode_documents, decode_rows
from rivulet.operators.routing import resolve_document_target, route_documents, route_rows
from tests.fixtures import DELETES, INSERTS, UPDATES, as_messages
from tests.replay import replay_documents

CHANGE = "seq BIGINT, op STRING, _id STRING, doc MAP<STRING,STRING>"


def documents(df):
    return {r["_id"]: r["doc"] for r in df.collect()}


def random_log(seed, size=800):
    rng = random.Random(seed)
    log = []
    for seq in range(size):
        key = "hot" if rng.random() < 0.4 else f"d{rng.randrange(30)}"
        op = rng.choices(["insert", "update", "delete"], [2, 6, 1])[0]
        doc = {f: rng.choice([None, "1", "2"]) for f in rng.sample(["", "a", "b", "touch", "delete"], 2)}
        if rng.random() < 0.05:
            doc = rng.choice([None, {}])
        log.append((seq, op, key, None if op == "delete" else doc))
    rng.shuffle(log)
    return log


def test_documents_equal_the_sequential_replay(spark):
    log = random_log(2)
    changes = spark.createDataFrame(log, CHANGE)
    assert documents(apply_documents(None, changes)) == replay_documents({}, log)
    held = {f"d{n}": {"a": "old", "keep": None} for n in range(20, 45)}
    base = spark.createDataFrame(list(held.items()), "_id STRING, doc MAP<STRING,STRING>")
    assert documents(apply_documents(base, changes)) == replay_documents(held, log)


def test_present_null_overwrites_and_missing_keeps(spark):
    log = [(1, "insert", "x", {"a": "1", "b": "2"}), (2, "update", "x", {"a": None})]
    got = documents(apply_documents(None, spark.createDataFrame(log, CHANGE)))
    assert got == {"x": {"a": None, "b": "2"}}


def test_inserts_on_live_documents(spark):
    log = [(1, "update", "x", {}), (2, "insert", "x", {}), (3, "delete", "x", None), (4, "insert", "x", {})]
    got = inserts_on_live_documents(None, spark.createDataFrame(log, CHANGE))
    assert [r["seq"] for r in got.collect()] == [2]


def event(kind, key, doc=None, db="reporting", time="Timestamp(1560410354, 1)"):
    value = {"operationType": kind, "ns": {"db": db, "coll": "events"}, "documentKey": key,
             "clusterTime": time}
    if doc is not None:
        value["fullDocument"] = doc
    return value


def test_document_messages(spark):
    first = {"_id": "5d01", "event_id": "1002107", "is_login": "1"}
    sent = [
        event("bootstrap-start", None),
        event("bootstrap-insert", "5d01", first),
        event("bootstrap-complete", None),
        event("insert", {"_id": "5d02"}, {"_id": "5d02", "type": "8", "phone": ""}),
        event("update", {"_id": "5d01"}, {"is_login": 0, "os": None, "tags": ["a"]}),
        event("replace", {"_id": "5d02"}, {"type": "9"}),
        event("drop", None),
        "not json",
        event("delete", {"_id": "5d03"}, db=""),
    ]
    got = decode_documents(as_messages(spark, sent))
    routed = resolve_document_target(route_documents(got), "lib", "docs").cache()
    rows = routed.orderBy("m_offset").collect()
    assert [r["action"] for r in rows] == [
        "marker", "insert", "marker", "insert", "update", "update", "ignored", "malformed", "delete",
    ]
    assert tuple(rows[1]["clusterTime"]) == (1560410354, 1)
    assert rows[3]["target"] == "reporting.events" and rows[8]["target"] == "lib.docs"
    assert documents(apply_documents(None, document_changes(routed, F.col("m_offset")))) == {
        "5d01": {**first, "is_login": "0", "os": None, "tags": '["a"]'},
        "5d02": {"_id": "5d02", "type": "9", "phone": ""},
    }


def test_rows_into_documents(spark):
    routed = route_rows(decode_rows(as_messages(spark, INSERTS + UPDATES + DELETES)))
    one = documents(apply_documents(None, row_changes_as_documents(routed, ["id"], F.col("m_offset"))))
    assert sorted(one) == ["2", "4", "5", "6"] and one["5"]["sponsor_id"] == "5"
    two = documents(
        apply_documents(None, row_changes_as_documents(routed, ["id", "phone"], F.col("m_offset")))
    )
    assert json.loads(min(two)) == ["2", "22222"]
