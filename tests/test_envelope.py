import datetime
import decimal
import json

import pytest
from pyspark.sql import functions as F

from rivulet.operators import envelope as E
from rivulet.operators import routing as R
from rivulet.operators.batching import (
    assign_statements,
    commit_batches,
    commit_boundary,
    document_boundary,
    statement_runs,
)
from rivulet.schemas import ROWS_EVENT
from tests.fixtures import DELETES, INSERTS, UPDATES, as_messages
from tests.replay import replay_batches, replay_runs

ROW = (1, "a", decimal.Decimal("1.50"), datetime.date(2031, 3, 4), datetime.datetime(2031, 3, 4, 17, 59, 59, 250000),
       b"\x00\xff", None, {"x": [1, None]})
TYPES = ("id INT, name STRING, price DECIMAL(10,2), day DATE, at TIMESTAMP_NTZ, raw BINARY, "
         "none STRING, nested STRUCT<x: ARRAY<INT>>")


def test_snapshot_messages_keep_json_types(spark):
    df = spark.createDataFrame([ROW], TYPES)
    rows = E.snapshot_messages(df, "shop", "t", 7).orderBy("phase").collect()
    head = {"database": "shop", "table": "t", "topic": "shop-t", "ts": 7}
    assert [json.loads(r["value"]) for r in rows] == [
        {"type": "bootstrap-start", **head, "data": {}},
        {"type": "bootstrap-insert", **head, "data": {
            "id": 1, "name": "a", "price": "1.50", "day": "2031-03-04 00:00:00",
            "at": "2031-03-04 17:59:59", "raw": "AP8=", "none": None, "nested": {"x": [1, None]}}},
        {"type": "bootstrap-complete", **head, "data": {}},
    ]
    assert {r["topic"] for r in rows} == {"shop-t"}


def test_text_payload_and_round_trip(spark):
    df = spark.createDataFrame([ROW], TYPES)
    sent = E.encode_messages(E.snapshot_envelopes(df, "shop", "t", 7))
    got = E.decode_rows(sent).where("type = 'bootstrap-insert'").first()
    assert got["data"] == {
        "id": "1", "name": "a", "price": "1.50", "day": "2031-03-04 00:00:00",
        "at": "2031-03-04 17:59:59", "raw": "AP8=", "none": None, "nested": '{"x":[1,null]}',
    }
    assert got["old"] is None and got["ts"] == 7


def test_empty_snapshot_gives_markers_only(spark):
    df = spark.createDataFrame([], "id INT")
    assert [r["type"] for r in E.snapshot_envelopes(df, "d", "t", 1).collect()] == [
        "bootstrap-start", "bootstrap-complete",
    ]


def test_rows_events(spark):
    def image(n):
        return {"id": str(n)}

    events = [
        ("write", "d", "t", 5, 1, [(image(1), None, None), (image(2), None, None)]),
        ("update", "d", "t", 6, 2, [(None, image(2), image(3))]),
        ("delete", "d", "t", 7, 3, [(image(1), None, None)]),
        ("write", "d", "t", 8, 4, []),
    ]
    got = E.explode_rows_events(spark.createDataFrame(events, ROWS_EVENT)).orderBy("log_pos", "row_no")
    rows = [(r["type"], r["commit"], r["offset"], r["data"], r["old"], r["topic"]) for r in got.collect()]
    assert rows == [
        ("insert", None, 1, image(1), None, "d-t"),
        ("insert", True, None, image(2), None, "d-t"),
        ("update", True, None, image(3), image(2), "d-t"),
        ("delete", True, None, image(1), None, "d-t"),
    ]


def test_routing_and_malformed_messages(spark):
    odd = [{"type": "table-alter"}, {"type": "query"}, "broken {", {"no": "type"}, None]
    sent = as_messages(spark, [v for v in INSERTS + UPDATES + DELETES + odd if v is not None])
    routed = R.route_rows(E.decode_rows(sent))
    counts = {r[0]: r[1] for r in routed.groupBy("action").count().collect()}
    assert counts == {"marker": 2, "insert": 6, "update": 2, "delete": 2, "ddl": 1, "ignored": 1,
                      "malformed": 2}
    assert R.only_changes(routed).count() == 10
    null_value = sent.limit(1).withColumn("value", F.lit(None).cast("string"))
    assert R.route_rows(E.decode_rows(null_value)).first()["action"] == "malformed"
    as_bytes = sent.limit(1).withColumn("value", F.encode("value", "UTF-8"))
    assert E.decode_rows(as_bytes).first()["type"] == "bootstrap-start"


def test_parsing_happens_once(spark):
    routed = R.only_changes(R.route_rows(E.decode_rows(as_messages(spark, INSERTS))))
    plan = routed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_table_filters(spark):
    rows = [(d, t) for d in ("a", "b", "c") for t in ("x", "y")]
    df = spark.createDataFrame(rows, "database STRING, table STRING")
    tables = ["a.x", "b.y"]
    exact = {tuple(r) for r in R.keep_tables(df, tables).collect()}
    assert exact == {("a", "x"), ("b", "y")}
    listed = spark.createDataFrame([("a", "x"), ("b", "y")], "database STRING, table STRING")
    assert {tuple(r) for r in R.keep_tables_in(df, listed).collect()} == exact
    assert R.keep_schemas(df, tables).count() == 4


def test_repairs(spark):
    data = {"at": "2031-03-04 20:00:00", "raw": "aGk=", "empty": "", "none": None}
    df = spark.createDataFrame([(data, {"at": "2031-03-04 10:00:00"}), (None, None)],
                               "data MAP<STRING,STRING>, old MAP<STRING,STRING>")
    shifted = R.shift_timestamps(df, ["at", "empty", "none", "absent"]).collect()
    assert shifted[0]["data"]["at"] == "2031-03-05 04:00:00"
    assert shifted[0]["old"]["at"] == "2031-03-04 18:00:00"
    assert shifted[0]["data"]["empty"] == "" and shifted[1]["data"] is None
    decoded = R.decode_binaries(df, ["raw", "empty", "none", "absent"]).first()
    assert {k: bytes(v) for k, v in decoded["binaries"].items()} == {"raw": b"hi"}
    over = R.before_image(df).collect()
    assert over[0]["before"]["at"] == "2031-03-04 10:00:00" and over[1]["before"] == {}


def test_row_targets(spark):
    df = spark.createDataFrame([("d", "t"), ("", "t"), (None, None)], "database STRING, table STRING")
    got = [r["target"] for r in R.resolve_row_target(df, "x", "y").collect()]
    assert got == ["d.t", "x.t", "x.y"]
    assert {r["target"] for r in R.resolve_row_target(df, "x", "y", forced=True).collect()} == {"x.y"}


def test_table_sets(spark):
    wanted = spark.createDataFrame([("a.x",), ("a.y",), ("a.x",)], "table STRING")
    known = spark.createDataFrame([("a.y",), ("b.z",)], "table STRING")
    assert {tuple(r) for r in R.table_sets(wanted, known).collect()} == {("a.x", "new"), ("a.y", "old")}


@pytest.mark.parametrize("cap", [7, 1000])
def test_commit_batches(spark, cap):
    kinds = ["bootstrap-insert"] * 9 + ["bootstrap-complete"] + ["insert"] * 30
    commits = [None] * 10 + [i % 4 == 3 for i in range(30)]
    rows = list(zip(range(40), kinds, commits, strict=True))
    log = spark.createDataFrame(rows, "seq BIGINT, type STRING, commit BOOLEAN")
    cut = commit_batches(log, commit_boundary(F.col("commit"), F.col("type")), buffer_rows=4, cap=cap)
    flags = [k == "bootstrap-complete" or bool(c) for k, c in zip(kinds, commits, strict=True)]
    assert [(r["batch"], r["part"]) for r in cut.orderBy("seq").collect()] == replay_batches(flags, 4)
    docs = log.where(document_boundary(F.col("type")))
    assert docs.count() == 31


@pytest.mark.parametrize("cap", [7, 1000])
def test_statement_runs(spark, cap):
    words = list("iiiuuidddiiiiiiiiuuuui") * 3
    log = spark.createDataFrame(list(enumerate(words)), "seq BIGINT, w STRING")
    got = assign_statements(log, F.col("w"), max_rows=3, cap=cap).orderBy("seq").collect()
    assert [(r["run"], r["part"]) for r in got] == replay_runs(words, 3, lambda _: True)
    merges = F.col("w") == "i"
    got = assign_statements(log, F.col("w"), max_rows=3, merges=merges, cap=cap).orderBy("seq").collect()
    want = replay_runs(words, 3, lambda w: w == "i")
    assert [(r["run"], r["part"]) for r in got] == want
    runs = statement_runs(log, F.col("w"), max_rows=3, merges=merges, cap=cap)
    assert runs.count() == len(set(want)) and runs.agg(F.sum("n_rows")).first()[0] == len(words)
