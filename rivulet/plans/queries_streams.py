"""Queries that run as streams until drained, and composed source-to-sink jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet import functions as R
from rivulet.operators.apply_rows import Modes, apply_changes
from rivulet.operators.envelope import encode
from rivulet.operators.progress import consumer_progress, progress_tokens
from rivulet.plans import sql_parts as S
from rivulet.plans.inputs import (
    ACCOUNT,
    account_log,
    account_messages,
    document_messages,
    table,
)
from rivulet.plans.pipeline import build_pipeline
from rivulet.plans.queries_changes import _collections, _fields
from rivulet.plans.registry import query
from rivulet.sinks.groups import TableGroup
from rivulet.sinks.messages import write_files
from rivulet.sinks.tables import BucketedTable
from rivulet.sources.log import MessageLog, read_log
from rivulet.sources.messages import read_files
from rivulet.streaming import apply_documents_stream, apply_rows_stream, drain, gate_stream
from rivulet.streaming.apply import progress_store
from rivulet.streaming.gate import position_store
from rivulet.streaming.rejects import RejectStore
from rivulet.util import scratch_dir, stage

_ACCOUNT_DDL = ", ".join(f"{name} {kind}" for name, kind in ACCOUNT.items())
_REPLACE = Modes(imode="replace", umode="replace", match="key")


# Messages of a file, about: what one task sorts, whatever the size of the log.
_FILE_MESSAGES = 500_000


def _write_keyed(messages: DataFrame, path: str) -> int:
    """Write a message log so that the changes of one `key` stay in one file, in order; gives
    the files of a batch, half of them. There are four files, and more for a larger log."""
    files = max(4, -(-messages.count() // _FILE_MESSAGES))
    keyed = messages.withColumn("topic", F.lit("shop"))
    spread = keyed.repartition(files, "key").sortWithinPartitions("partition", "offset")
    write_files(spread.drop("key"), path)
    return -(-files // 2)


def _account_target(spark: SparkSession, home: str) -> BucketedTable:
    return BucketedTable(spark, f"{home}/target", _ACCOUNT_DDL, ["user_id"], buckets=8)


def _run_apply(
    spark: SparkSession, home: str, target: BucketedTable, files: int, modes: Modes = _REPLACE
) -> None:
    stream = read_files(spark, f"{home}/log", "shop", streaming=True, files_per_trigger=files)
    drain(
        apply_rows_stream(
            stream, target, ACCOUNT, f"{home}/checkpoint", modes,
            progress=progress_store(spark, f"{home}/progress"),
        )
    )


@query(S.REPLACED)
def stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replace mode as a stream of message files."""
    home = scratch_dir(spark, "stream-apply")
    files = _write_keyed(account_messages(spark, sf_dir, keyed=True), f"{home}/log")
    target = _account_target(spark, home)
    _run_apply(spark, home, target, files)
    return target.read()


@query(S.REPLACED)
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one checkpoint; the second sees only the later half of the log."""
    home = scratch_dir(spark, "stream-resume")
    messages = account_messages(spark, sf_dir, keyed=True)
    middle = messages.agg(F.max("offset") / 2).scalar()
    target = _account_target(spark, home)
    for part in (F.col("offset") <= middle, F.col("offset") > middle):
        files = _write_keyed(messages.where(part), f"{home}/log")
        _run_apply(spark, home, target, files)
    return target.read()


@query(
    f"""with {S.LOG} select 'shop' as topic, (seq % 4)::int as "partition", seq as "offset",
  case when seq % 19 = 0 then 'malformed' when seq % 17 = 0 then 'bad_key' else 'bad_value' end as reason,
  case when seq % 19 = 0 then '' when seq % 17 = 0 and seq % 13 = 0 then 'user_id,value'
    when seq % 17 = 0 then 'user_id' else 'value' end as fields
from log where seq % 19 = 0 or (type <> 'replace' and (seq % 17 = 0 or seq % 13 = 0))"""
)
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream could not apply: broken texts, keys and values of another type."""
    home = scratch_dir(spark, "stream-rejects")
    log = account_log(spark, sf_dir)
    seq = F.col("seq")
    data = F.transform_values(
        "data",
        lambda k, v: F.when((k == "user_id") & (seq % 17 == 0), F.concat(F.lit("u"), v))
        .when((k == "value") & (seq % 13 == 0), F.lit("n/a")).otherwise(v),
    )
    faulty = log.withColumn("data", data)
    fields = [c for c in log.columns if c != "seq"]
    messages = faulty.select(
        F.lit("shop").alias("topic"), (seq % 4).cast("int").alias("partition"), seq.alias("offset"),
        F.when(seq % 19 == 0, F.lit("not json")).otherwise(encode(faulty, fields)).alias("value"),
        F.col("data")["user_id"].alias("key"),
    )
    files = _write_keyed(messages, f"{home}/log")
    stream = read_files(spark, f"{home}/log", "shop", streaming=True, files_per_trigger=files)
    rejects = RejectStore(spark, f"{home}/rejects")
    target = _account_target(spark, home)
    drain(apply_rows_stream(stream, target, ACCOUNT, f"{home}/checkpoint", _REPLACE, rejects=rejects))
    found = rejects.read()
    return found.select("topic", "partition", "offset", "reason", F.array_join("fields", ",").alias("fields"))


@query(S.REPLACED)
def stream_split_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replace mode into a table that begins with one bucket and splits on the way."""
    home = scratch_dir(spark, "stream-splits")
    files = _write_keyed(account_messages(spark, sf_dir, keyed=True), f"{home}/log")
    users = table(spark, sf_dir, "events").agg(F.count_distinct("user_id")).first()[0]
    target = BucketedTable(
        spark, f"{home}/target", _ACCOUNT_DDL, ["user_id"], buckets=1, bucket_rows=1 + users // 24
    )
    _run_apply(spark, home, target, files)
    return target.read()


@query(
    f"""with {S.LOG} select 'shop.' || (user_id % 4) as token, max(seq) + 1 as next_offset
from log group by 1"""
)
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress saved by a stream after each committed batch."""
    home = scratch_dir(spark, "stream-progress")
    files = _write_keyed(account_messages(spark, sf_dir, keyed=True), f"{home}/log")
    _run_apply(spark, home, _account_target(spark, home), files)
    return progress_store(spark, f"{home}/progress").before()


# Of the log's partitions 0 to 3, the last one appears with the later half.
_LATER = f"""with {S.LOG}, m as (select max(seq) / 2 as middle from log)
select 'shop' as topic, (user_id % 4)::int as "partition", seq as "offset" from log, m
where user_id % 4 = 3 or seq > middle"""


def _late_partition(messages: DataFrame, late: bool) -> DataFrame:
    """The earlier or later half of the log; the last partition is all in the later one."""
    middle = messages.agg(F.max("offset") / 2).scalar()
    is_late = (F.col("offset") > middle) | (F.col("partition") == 3)
    return messages.withColumn("topic", F.lit("shop")).where(is_late if late else ~is_late)


@query(_LATER)
def log_from_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log read from stored tokens; a partition that has none is read from 0."""
    log = MessageLog(spark, f"{scratch_dir(spark, 'log')}/log")
    messages = account_messages(spark, sf_dir)
    log.append(_late_partition(messages, False), "early")
    tokens = stage(progress_tokens(consumer_progress(read_log(spark, log.path, "shop"))))
    log.append(_late_partition(messages, True), "late")
    return read_log(spark, log.path, "shop", tokens=tokens).select("topic", "partition", "offset")


@query(_LATER)
def stream_from_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that starts at the latest message, is stopped, and goes on when more came."""
    home = scratch_dir(spark, "stream-latest")
    log = MessageLog(spark, f"{home}/log")
    messages = account_messages(spark, sf_dir)
    for late in (False, True):
        log.append(_late_partition(messages, late), f"late-{late}")
        stream = read_log(
            spark, log.path, "shop", earliest=False, streaming=True, anchor=f"{home}/anchor"
        )
        found = stream.select("topic", "partition", "offset")
        drain(
            found.writeStream.format("parquet")
            .option("path", f"{home}/out").option("checkpointLocation", f"{home}/checkpoint")
            .trigger(availableNow=True).start()
        )
    return spark.read.schema(found.schema).parquet(f"{home}/out")


@query(S.REPLACED)
def stream_apply_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replace mode as a running stream over a log, in batches of bounded messages."""
    home = scratch_dir(spark, "stream-log")
    log = MessageLog(spark, f"{home}/log")
    messages = account_messages(spark, sf_dir).withColumn("topic", F.lit("shop"))
    log.append(messages, "all")
    size = messages.agg(F.max("offset") - F.min("offset") + 1).first()[0] or 1
    stream = read_log(
        spark, log.path, "shop", streaming=True, per_trigger=2 * size, anchor=f"{home}/anchor"
    )
    target = _account_target(spark, home)
    running = apply_rows_stream(
        stream, target, ACCOUNT, f"{home}/checkpoint", _REPLACE, trigger={"processingTime": "0 seconds"}
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return target.read()


@query(S.DOC_FIELDS)
def stream_apply_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = scratch_dir(spark, "stream-docs")
    files = _write_keyed(document_messages(spark, sf_dir, keyed=True), f"{home}/log")
    target = BucketedTable(
        spark, f"{home}/target", "_id STRING, doc MAP<STRING,STRING>", ["_id"], buckets=8
    )
    stream = read_files(spark, f"{home}/log", "shop", streaming=True, files_per_trigger=files)
    drain(apply_documents_stream(stream, target, f"{home}/checkpoint"))
    return _fields(target.read())


_GATED = f"""with {S.LOG}, g as (select log.*, max(ts_s) over (partition by log.db, log.tbl order by seq
        rows between unbounded preceding and 1 preceding) as seen from log)
select seq, db as database, tbl as "table", ts_s as ts from g where seen is null or ts_s >= seen"""


@query(_GATED)
def stream_late_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late gate over a stream whose batches follow the log; runs twice on one
    checkpoint, so that positions carry over."""
    home = scratch_dir(spark, "stream-gate")
    log = account_log(spark, sf_dir).select("seq", "database", "table", "ts")
    middle = log.agg(F.max("seq") / 2).scalar()
    for part in (F.col("seq") <= middle, F.col("seq") > middle):
        log.where(part).write.mode("append").parquet(f"{home}/log")
        stream = spark.readStream.schema(log.schema).parquet(f"{home}/log")
        drain(
            gate_stream(
                stream, ["database", "table"], f"{home}/state", f"{home}/out", f"{home}/checkpoint"
            )
        )
    return spark.read.schema(log.schema).parquet(f"{home}/out").select(*log.columns)


@query(
    f"""with {S.LOG} select db as database, tbl as "table", max(ts_s) as time from log group by 1, 2"""
)
def stream_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table positions that the streaming gate leaves behind."""
    home = scratch_dir(spark, "stream-positions")
    log = account_log(spark, sf_dir).select("seq", "database", "table", "ts")
    log.write.parquet(f"{home}/log")
    stream = spark.readStream.schema(log.schema).parquet(f"{home}/log")
    drain(
        gate_stream(
            stream, ["database", "table"], f"{home}/state", f"{home}/out", f"{home}/checkpoint"
        )
    )
    return position_store(spark, f"{home}/state", ["database", "table"]).before().drop("inc")


@query(
    f"""with {S.DOCS},
c as (select *, 'c' || (seq % 3) as coll, t * 16 + i as pos from docs),
g as (select c.*, max(pos) over (partition by coll order by seq
        rows between unbounded preceding and 1 preceding) as seen from c)
select seq, coll, t as time, i as inc from g where seen is null or pos >= seen"""
)
def stream_late_gate_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late gate on cluster times, over two runs on one checkpoint."""
    home = scratch_dir(spark, "stream-doc-gate")
    log = _collections(spark, sf_dir)
    middle = log.agg(F.max("seq") / 2).scalar()
    for part in (F.col("seq") <= middle, F.col("seq") > middle):
        log.where(part).write.mode("append").parquet(f"{home}/log")
        stream = spark.readStream.schema(log.schema).parquet(f"{home}/log")
        drain(
            gate_stream(
                stream, ["coll"], f"{home}/state", f"{home}/out", f"{home}/checkpoint",
                ts="clusterTime", documents=True,
            )
        )
    out = spark.read.schema(log.schema).parquet(f"{home}/out")
    return out.select(
        "seq", "coll", "clusterTime.time", F.col("clusterTime.inc").cast("bigint").alias("inc")
    )


_TABLE_STATE = f"""with {S.LOG}, c as (select * from log where type <> 'replace' and db = 'db1' and tbl = 't2'),
last as (select *, row_number() over (partition by user_id order by seq desc) as rn from c)
select user_id, event_type, value, created from last where rn = 1 and type <> 'delete'"""


@query(_TABLE_STATE)
def replay_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several topics to one of their tables, through the composer."""
    job = build_pipeline(
        "messages", "relational",
        topics="events-click,events-purchase,events-signup,events-error,events-view",
    )
    return job.apply_rows(
        account_messages(spark, sf_dir), "db1.t2", ACCOUNT, ["user_id"], modes=_REPLACE
    )


@query(S.REPLACED)
def replay_single_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of the topics to one configured table."""
    job = build_pipeline(
        "messages", "relational", tables="shop.account",
        topics="events-click,events-purchase,events-signup,events-error,events-view",
    )
    return job.apply_rows(
        account_messages(spark, sf_dir), "shop.account", ACCOUNT, ["user_id"],
        modes=_REPLACE, forced=True,
    )


@query(S.DOC_FIELDS)
def replay_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = build_pipeline("messages", "document", topics="shop-profile")
    return _fields(job.apply_documents(document_messages(spark, sf_dir), "shop.profile"))


@query(
    """select 'shop-customer' as topic, 'bootstrap-insert' as type, count(*) as n from customer
union all select 'shop-customer', 'bootstrap-start', 1
union all select 'shop-customer', 'bootstrap-complete', 1"""
)
def publish_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots to messages through the composer; unlisted tables are left out."""
    from rivulet.operators.envelope import decode_rows, snapshot_envelopes

    job = build_pipeline("relational", "messages", tables="shop.customer,shop.absent")
    both = snapshot_envelopes(table(spark, sf_dir, "customer"), "shop", "customer", 1).unionByName(
        snapshot_envelopes(table(spark, sf_dir, "supplier"), "shop", "supplier", 1)
    )
    got = decode_rows(job.messages(both))
    return got.groupBy(F.col("m_topic").alias("topic"), "type").agg(F.count(F.lit(1)).alias("n"))


_TWO_TABLES = f"""with {S.LOG}, c as (
  select * from log where type <> 'replace' and ((db = 'db1' and tbl = 't2') or (db = 'db0' and tbl = 't1'))),
last as (select *, row_number() over (partition by db, user_id order by seq desc) as rn from c)
select db || '.' || tbl as target, user_id, event_type, value, created
from last where rn = 1 and type <> 'delete'"""


@query(_TWO_TABLES)
def stream_two_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic that carries many tables, streamed to the targets of two of them."""
    home = scratch_dir(spark, "stream-two")
    files = _write_keyed(account_messages(spark, sf_dir, keyed=True), f"{home}/log")
    job = build_pipeline("messages", "relational", topics="shop")
    targets = {
        name: (_account_target(spark, f"{home}/{name}"), ACCOUNT) for name in ("db1.t2", "db0.t1")
    }
    stream = read_files(spark, f"{home}/log", "shop", streaming=True, files_per_trigger=files)
    drain(
        job.start(
            stream, targets, f"{home}/checkpoint", modes=_REPLACE, trigger={"availableNow": True}
        )
    )
    rows = [t.read().select(F.lit(n).alias("target"), *ACCOUNT) for n, (t, _) in targets.items()]
    return rows[0].unionByName(rows[1])


@query(_TWO_TABLES)
def stream_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of one topic that change together, by one commit a batch."""
    home = scratch_dir(spark, "stream-group")
    files = _write_keyed(account_messages(spark, sf_dir, keyed=True), f"{home}/log")
    job = build_pipeline("messages", "relational", topics="shop")
    tables = {name: _account_target(spark, f"{home}/{name}") for name in ("db1.t2", "db0.t1")}
    group = TableGroup(spark, f"{home}/group", tables, progress_store(spark, f"{home}/progress"))
    stream = read_files(spark, f"{home}/log", "shop", streaming=True, files_per_trigger=files)
    drain(
        job.start(
            stream, {n: (t, ACCOUNT) for n, t in tables.items()}, f"{home}/checkpoint",
            modes=_REPLACE, trigger={"availableNow": True}, group=group,
        )
    )
    rows = [t.read().select(F.lit(n).alias("target"), *ACCOUNT) for n, t in tables.items()]
    return rows[0].unionByName(rows[1])


@query(
    """select o_orderkey as id, case when o_orderkey % 7 = 0 then 'changed' else o_orderstatus end as v,
  case when o_orderkey % 7 = 0 then null else o_custkey end as bucket from orders
where o_orderkey % 7 <> 0 or o_orderkey % 3 <> 0"""
)
def table_clashing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target with columns `v` and `bucket`, changed after it was opened otherwise."""
    home = scratch_dir(spark, "clash")
    schema = "id BIGINT, v STRING, bucket BIGINT"
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("v"),
        F.col("o_custkey").alias("bucket"),
    )
    first = BucketedTable(spark, f"{home}/target", schema, ["id"], buckets=4)
    first.apply(0, orders.select("id"), lambda _: orders)
    again = BucketedTable(spark, f"{home}/target", schema, ["id"], buckets=9)
    touched = orders.where("id % 7 = 0").select("id")
    changed = touched.where("id % 3 <> 0").select(
        "id", F.lit("changed").alias("v"), F.lit(None).cast("bigint").alias("bucket")
    )
    again.apply(
        1, touched, lambda old: old.join(touched, "id", "left_anti").unionByName(changed)
    )
    return again.read()


@query("select doc_id as id, text from documents")
def replay_binaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts sent as base64 fields of messages and replayed into a BINARY column."""
    data = F.create_map(
        F.lit("id"), F.col("doc_id").cast("string"),
        F.lit("body"), R.b64_encode(F.encode("text", "UTF-8")),
    )
    envelopes = table(spark, sf_dir, "documents").select(
        F.lit("insert").alias("type"), F.lit("shop").alias("database"),
        F.lit("page").alias("table"), F.lit("shop-page").alias("topic"),
        F.lit(1).cast("bigint").alias("ts"), data.alias("data"), F.col("doc_id").alias("seq"),
    )
    messages = envelopes.select(
        "topic", F.lit(0).alias("partition"), F.col("seq").alias("offset"),
        encode(envelopes, ["type", "database", "table", "ts", "data"]).alias("value"),
    )
    job = build_pipeline("messages", "relational", topics="shop-page")
    rows = job.apply_rows(
        messages, "shop.page", {"id": "bigint", "body": "binary"}, ["id"], modes=_REPLACE
    )
    return rows.select("id", F.col("body").cast("string").alias("text"))


@query(
    """with m as (
  select o_custkey as c, o_orderkey, o_orderstatus as s, o_orderkey % 3 <> 0 as hits,
    row_number() over (partition by o_custkey, o_orderkey % 3 <> 0 order by o_orderkey desc) as back
  from orders
), n as (select c, count(*) filter (hits) as moves, max(s) filter (hits and back = 1) as s from m group by c)
select c_custkey + coalesce(moves, 0) * 1000000000 as k, coalesce(s, 'base') as state
from customer left join n on c = c_custkey"""
)
def apply_key_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order moves its customer's row to a new key; every third one finds no row."""
    orders = table(spark, sf_dir, "orders").where("o_custkey is not null")
    hits = F.col("o_orderkey") % 3 != 0
    before = Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(
        Window.unboundedPreceding, -1
    )
    done = F.coalesce(F.sum(hits.cast("bigint")).over(before), F.lit(0))
    here = F.col("o_custkey") + done * 1_000_000_000
    changes = orders.select(
        F.col("o_orderkey").alias("seq"), F.lit("update").alias("op"),
        F.struct((here + 1_000_000_000).alias("k"), F.col("o_orderstatus").alias("state")).alias("row"),
        F.struct(F.when(hits, here).otherwise(-here).alias("k"), F.lit("?").alias("state")).alias("old"),
    )
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.lit("base").alias("state")
    )
    return apply_changes(base, changes, ["k"], Modes(match="key"))
