import pytest
from pyspark.sql import functions as F

from rivulet.operators.apply_rows import Modes
from rivulet.operators.envelope import decode_rows, snapshot_envelopes
from rivulet.operators.progress import (
    document_position,
    log_position,
    snapshot_counts,
    start_time,
    table_position,
)
from rivulet.plans.pipeline import build_pipeline, read_tables
from rivulet.sources.metadata import column_types, columns_of_type, create_table_text
from rivulet.sources.snapshot import bounded_snapshot, jdbc_table, read_sql
from rivulet.util import scratch_dir, shared_dir
from tests.fixtures import ACCOUNT_COLUMNS, DELETES, INSERTS, UPDATES, as_messages


@pytest.mark.parametrize(
    ("args", "problem"),
    [
        (("relational", "document"), "exactly one"),
        (("messages", "messages"), "exactly one"),
        (("relational", "queue"), "unknown store"),
        (("relational", "messages"), "needs tables"),
        (("messages", "relational"), "needs topics"),
        (("messages", "relational", ["a.b"], "x"), "one text"),
    ],
)
def test_illegal_pairs(args, problem):
    with pytest.raises(ValueError, match=problem):
        build_pipeline(*args)


def test_producer_topics(spark):
    df = spark.createDataFrame([(1,)], "id INT")
    both = snapshot_envelopes(df, "a", "x", 1).unionByName(snapshot_envelopes(df, "b", "x", 1))
    each = build_pipeline("relational", "messages", "a.x,b.x")
    assert {r["topic"] for r in each.messages(both).collect()} == {"a-x", "b-x"}
    one = build_pipeline("relational", "messages", ["a.x"], "all")
    got = one.messages(both).collect()
    assert {r["topic"] for r in got} == {"all"} and len(got) == 3


def test_consumer_targets(spark):
    sent = as_messages(spark, INSERTS + UPDATES + DELETES).unionByName(
        as_messages(spark, INSERTS, topic="other")
    )
    modes = Modes("replace", "replace", match="key")
    own = build_pipeline("messages", "relational", topics="club-Member")
    got = own.apply_rows(sent, "club.Member", ACCOUNT_COLUMNS, ["id"], modes=modes)
    assert sorted(int(r["id"]) for r in got.collect()) == [1, 2, 3, 4, 5, 6]
    fixed = build_pipeline("messages", "relational", "reports.Patron", ["club-Member"])
    got = fixed.apply_rows(
        sent, "reports.Patron", ACCOUNT_COLUMNS, ["id"], modes=modes, forced=True
    )
    assert sorted(int(r["id"]) for r in got.collect()) == [2, 4, 5, 6]
    docs = build_pipeline("messages", "document", topics="club-Member")
    got = docs.apply_documents(sent, "club.Member", row_keys=["id"])
    assert got.count() == 6


def test_read_tables_follows_new_and_known(spark):
    rows = [(s, "d", t, ts, "insert") for s, (t, ts) in enumerate(
        [("old", 5), ("new", 99), ("new", 100), ("old", 20), ("skip", 7), ("new", 101), ("old", 12)])]
    log = spark.createDataFrame(rows, "seq BIGINT, database STRING, table STRING, ts BIGINT, type STRING")
    log = log.withColumns({"topic": F.lit("x"), "sid": F.lit("s"), "gno": F.col("seq")})
    current = spark.createDataFrame([(1,), (2,)], "id INT")
    tables = {"d.old": current, "d.new": current}
    positions = spark.createDataFrame([("d", "old", 10, 0)], "database STRING, table STRING, time BIGINT, inc INT")

    def seqs(df):
        return sorted(r["seq"] for r in df.where("phase = 3").collect())

    whole = read_tables(tables, log, 100, positions)
    assert seqs(whole) == [2, 3, 5] and whole.where("phase < 3").count() == 4
    snapshot = spark.createDataFrame([("s", 0, 4)], "sid STRING, lo BIGINT, hi BIGINT")
    assert seqs(read_tables(tables, log, 100, positions, snapshot)) == [3, 5]
    # Without earlier positions the log is aligned at once.
    assert seqs(read_tables(tables, log, 0, None, snapshot)) == [0, 1, 2, 3, 5]
    plain = read_tables(tables, log, 100, positions, bootstrap=False, resume=False)
    assert seqs(plain) == [0, 1, 2, 3, 5, 6] and plain.where("phase < 3").count() == 0


def test_positions(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5, 1), ("a", 2, 6, 2), ("a", 3, 6, None), ("b", 1, 4, 1)],
        "tbl STRING, seq BIGINT, ts BIGINT, offset INT",
    )
    last = table_position(rows, ["tbl"], F.col("seq"))
    assert sorted(tuple(r) for r in last.collect()) == [("a", 6, 0), ("b", 4, 1)]
    assert tuple(start_time(last).first()) == (4, 1)
    log = spark.createDataFrame([(1, "bin.1", 9), (2, "bin.2", 4)], "seq BIGINT, log_file STRING, log_pos BIGINT")
    assert tuple(log_position(log).first()) == ("bin.2", 4)
    docs = rows.select("tbl", "seq", F.struct(F.col("ts").alias("time"), F.lit(1).alias("inc")).alias("clusterTime"))
    assert sorted(tuple(r) for r in document_position(docs, ["tbl"], F.col("seq")).collect()) == [
        ("a", 6, 1), ("b", 4, 1),
    ]
    counted = snapshot_counts(decode_rows(as_messages(spark, INSERTS)))
    assert [tuple(r) for r in counted.collect()] == [("club", "Member", 4)]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    bounded = bounded_snapshot(spark.read.parquet(path), "id")
    assert bounded.count() == 10
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(id,9)" in plan
    assert bounded_snapshot(spark.range(10), "id", 3).count() == 4
    assert bounded_snapshot(spark.range(0), "id").count() == 0
    spark.range(5).createOrReplaceTempView("five")
    assert read_sql(spark, "select * from five where id >= :low", {"low": 3}).count() == 2
    with pytest.raises(ValueError, match="bounds"):
        jdbc_table(spark, "jdbc:x", "t", split_column="id")


def test_metadata(spark):
    df = spark.createDataFrame([], "id BIGINT NOT NULL, raw BINARY, at TIMESTAMP")
    types = column_types(df)
    assert columns_of_type(types, ("binary", "blob")) == ["raw"]
    assert create_table_text(df, "d.t") == "CREATE TABLE d.t (id BIGINT NOT NULL, raw BINARY, at TIMESTAMP)"


class Context:
    applicationId = "app"

    def __init__(self, master):
        self.master = master


class Session:
    def __init__(self, master, folder=None):
        self.sparkContext = Context(master)
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}


def test_scratch_folders_follow_the_session():
    assert shared_dir(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert scratch_dir(Session("yarn", "/x"), "a").startswith("/x/a-")
    local = Session("local[2]")
    assert shared_dir(local) == shared_dir(local)
    assert scratch_dir(local, "a") != scratch_dir(local, "a")
    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_dir(Session("yarn"))
