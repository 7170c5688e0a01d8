"""Queries over snapshots, envelopes, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet import functions as R
from rivulet.operators import envelope, routing
from rivulet.plans import sql_parts as S
from rivulet.plans.inputs import (
    ACCOUNT,
    account_log,
    account_messages,
    document_messages,
    order_events,
    table,
)
from rivulet.plans.pipeline import full_then_incremental
from rivulet.plans.registry import query
from rivulet.sinks.messages import write_files
from rivulet.sources.messages import read_files
from rivulet.sources.metadata import column_types, columns_of_type
from rivulet.sources.snapshot import bounded_snapshot, read_sql
from rivulet.util import scratch_dir

SNAPSHOT_TS = 1_700_000_000


@query(
    """select 0 as phase, 'bootstrap-start' as type, 'shop' as database, 'customer' as "table",
  'shop-customer' as topic, cast(1700000000 as bigint) as ts, cast(null as bigint) as c_custkey,
  cast(null as varchar) as c_name, cast(null as double) as c_acctbal, cast(0 as bigint) as n_fields
union all
select 1, 'bootstrap-insert', 'shop', 'customer', 'shop-customer', 1700000000, c_custkey, c_name,
  c_acctbal, 5 from customer
union all
select 2, 'bootstrap-complete', 'shop', 'customer', 'shop-customer', 1700000000, null, null, null, 0"""
)
def snapshot_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = envelope.snapshot_envelopes(
        table(spark, sf_dir, "customer"), "shop", "customer", SNAPSHOT_TS
    )
    fields = {"c_custkey": "bigint", "c_name": "string", "c_acctbal": "double"}
    return rows.select(
        "phase", "type", "database", "table", "topic", "ts",
        *routing.project(F.col("data"), fields),
        F.size("data").cast("bigint").alias("n_fields"),
    )


@query(
    """select 1 as phase, 'shop-orders' as topic, o_orderkey, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate from orders
union all select 0, 'shop-orders', null, null, null
union all select 2, 'shop-orders', null, null, null"""
)
def snapshot_typed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot messages that keep JSON types, decoded again."""
    sent = envelope.snapshot_messages(table(spark, sf_dir, "orders"), "shop", "orders", SNAPSHOT_TS)
    got = envelope.decode_rows(sent)
    fields = {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderdate": "string"}
    return got.select(
        F.col("m_phase").alias("phase"), "topic", *routing.project(F.col("data"), fields)
    )


@query(
    """select 1 as phase, 'bootstrap-insert' as operation, 'shop-documents' as topic,
  cast(doc_id as varchar) as document_key, text, lang from documents
union all select 0, 'bootstrap-start', 'shop-documents', null, null, null
union all select 2, 'bootstrap-complete', 'shop-documents', null, null, null"""
)
def snapshot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bounded_snapshot(table(spark, sf_dir, "documents"), "doc_id")
    rows = envelope.snapshot_documents(docs, "shop", "documents", "doc_id")
    return rows.select(
        "phase",
        F.col("operationType").alias("operation"),
        "topic",
        F.col("documentKey").alias("document_key"),
        F.try_element_at("fullDocument", F.lit("text")).alias("text"),
        F.try_element_at("fullDocument", F.lit("lang")).alias("lang"),
    )


@query(
    """select o_orderkey, o_custkey, o_totalprice from orders
where o_orderkey <= (select max(o_orderkey) from orders)"""
)
def snapshot_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bounded_snapshot(table(spark, sf_dir, "orders"), "o_orderkey")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


@query("select max(o_orderkey) as top_id, count(*) as n_rows from orders")
def top_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bound of a snapshot, and the rows within it."""
    return bounded_snapshot(table(spark, sf_dir, "orders"), "o_orderkey").agg(
        F.max("o_orderkey").alias("top_id"), F.count(F.lit(1)).alias("n_rows")
    )


@query(
    """with e as (
  select *, case o_orderstatus when 'O' then 'insert' when 'F' then 'update' else 'delete' end as type,
    1 + o_orderkey % 4 as n_rows from orders),
r as (select e.*, unnest(range(1, n_rows + 1)) as n from e)
select o_orderkey as log_pos, type, 'db' || (o_custkey % 3) || '-' || 't' || (o_custkey % 5) as topic,
  cast(epoch(o_orderdate) as bigint) as ts, n = n_rows as is_commit,
  case when n < n_rows then n end as "offset", n as row_no,
  o_orderkey || '/' || n as id,
  case when type = 'update' then n + 100 else n end as new_n,
  case when type = 'update' then n end as old_n
from r"""
)
def rows_event_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = envelope.explode_rows_events(order_events(spark, sf_dir))
    return rows.select(
        "log_pos", "type", "topic", "ts",
        F.coalesce("commit", F.lit(False)).alias("is_commit"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("row_no").cast("bigint").alias("row_no"),
        F.col("data")["id"].alias("id"),
        F.col("data")["n"].cast("bigint").alias("new_n"),
        F.col("old")["n"].cast("bigint").alias("old_n"),
    )


@query(
    f"""with {S.LOG}
select 0 as phase, 'bootstrap-start' as type, 'shop-customer' as topic, null as id
union all select 1, 'bootstrap-insert', 'shop-customer', c_custkey from customer
union all select 2, 'bootstrap-complete', 'shop-customer', null
union all select 3, type, topic, user_id from log"""
)
def full_plus_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = envelope.snapshot_envelopes(
        table(spark, sf_dir, "customer"), "shop", "customer", SNAPSHOT_TS
    )
    both = full_then_incremental(snapshot, account_log(spark, sf_dir))
    data = F.col("data")
    key = F.coalesce(
        F.try_element_at(data, F.lit("c_custkey")), F.try_element_at(data, F.lit("user_id"))
    )
    return both.select("phase", "type", "topic", key.cast("bigint").alias("id"))


@query(
    """select 'o_orderstatus' as column_name, 'string' as data_type, count(o_orderstatus) as n_values,
  max(length(o_orderstatus)) as longest from orders
union all
select 'o_orderpriority', 'string', count(o_orderpriority), max(length(o_orderpriority)) from orders"""
)
def typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a declared type, found in the metadata and measured over the table."""
    orders = table(spark, sf_dir, "orders")
    types = column_types(orders)
    names = columns_of_type(types, ["string"])
    cells = orders.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col(n).alias("v")) for n in names])).alias("c")
    )
    sizes = cells.groupBy(F.col("c.n").alias("column_name")).agg(
        F.count("c.v").alias("n_values"), F.max(F.length("c.v")).cast("bigint").alias("longest")
    )
    return sizes.join(F.broadcast(types), "column_name")


@query(
    "select o_orderpriority, count(*) as n_orders from orders where o_totalprice >= 1000 "
    "and o_orderstatus = 'O' group by 1"
)
def parameterised_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("rivulet_orders")
    return read_sql(
        spark,
        "select o_orderpriority, count(*) as n_orders from rivulet_orders "
        "where o_totalprice >= :floor and o_orderstatus = :status group by o_orderpriority",
        {"floor": 1000, "status": "O"},
    )


@query(
    f"""with {S.LOG}
select seq as "offset", user_id % 4 as "partition",
  case when type = 'replace' and seq % 10 = 0 then null else type end as type,
  case when type = 'replace' and seq % 10 = 0 then null else ts_s end as ts,
  case when type = 'replace' and seq % 10 = 0 then null else user_id end as user_id,
  case when type = 'replace' and seq % 10 = 0 then null else value end as value,
  case when type = 'replace' and seq % 10 = 0 then null else created end as created,
  case when type = 'update' then seq % 7 end as old_value
from log"""
)
def decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = envelope.decode_rows(account_messages(spark, sf_dir))
    fields = {"user_id": "bigint", "value": "double", "created": "string"}
    return got.select(
        F.col("m_offset").alias("offset"),
        F.col("m_partition").cast("bigint").alias("partition"),
        "type", "ts",
        *routing.project(F.col("data"), fields),
        F.try_element_at("old", F.lit("value")).cast("bigint").alias("old_value"),
    )


@query(
    f"""select event_id, {S.CREATED} as at, strftime(ts, '%Y-%m-%d') || ' 00:00:00' as day,
  props as bytes_text, props as nested, value, cast(null as varchar) as nothing from events"""
)
def encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times, dates, bytes and NULLs through JSON and back."""
    events = table(spark, sf_dir, "events")
    typed = events.select(
        "event_id",
        F.col("ts").alias("at"),
        F.col("ts").cast("date").alias("day"),
        F.encode("props", "UTF-8").alias("bytes"),
        F.col("props").alias("nested"),
        "value",
        F.lit(None).cast("string").alias("nothing"),
    )
    sent = typed.select(F.to_json(F.struct(envelope.payload(typed).alias("data"))).alias("value"))
    data = envelope.decode_rows(sent).select("data")
    get = lambda name: F.try_element_at("data", F.lit(name))
    return data.select(
        get("event_id").cast("bigint").alias("event_id"),
        get("at").alias("at"),
        get("day").alias("day"),
        R.to_text(R.b64_decode(get("bytes"))).alias("bytes_text"),
        get("nested").alias("nested"),
        get("value").cast("double").alias("value"),
        get("nothing").alias("nothing"),
    )


@query(
    f"""with {S.LOG}
select case when type = 'replace' and seq % 10 = 0 then 'malformed'
            when type = 'replace' then 'ignored' else type end as action, count(*) as n
from log group by 1"""
)
def route_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = envelope.decode_rows(account_messages(spark, sf_dir), ["type"])
    routed = routing.route_rows(got)
    return routed.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query(
    """with t as (select case event_id % 12 when 0 then 'bootstrap-start' when 1 then 'bootstrap-insert'
  when 2 then 'bootstrap-complete' when 3 then 'database-create' when 4 then 'database-alter'
  when 5 then 'database-drop' when 6 then 'table-create' when 7 then 'table-alter'
  when 8 then 'table-drop' when 9 then 'insert' when 10 then 'query' else 'delete' end as type from events)
select type, case when type in ('bootstrap-start', 'bootstrap-complete') then 'marker'
  when type in ('bootstrap-insert', 'insert') then 'insert' when type = 'delete' then 'delete'
  when type = 'query' then 'ignored' else 'ddl' end as action, count(*) as n from t group by 1, 2"""
)
def route_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definition changes are recognised, counted and skipped."""
    kinds = [
        "bootstrap-start", "bootstrap-insert", "bootstrap-complete", "database-create",
        "database-alter", "database-drop", "table-create", "table-alter", "table-drop",
        "insert", "query", "delete",
    ]
    turn = (F.col("event_id") % 12 + 1).cast("int")
    typed = table(spark, sf_dir, "events").select(
        F.element_at(F.array(*[F.lit(k) for k in kinds]), turn).alias("type")
    )
    return routing.route_rows(typed).groupBy("type", "action").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""with {S.DOCS}
select type, case type when 'bootstrap-insert' then 'insert' when 'replace' then 'update' else type end
  as action, count(*) as n from docs group by 1, 2"""
)
def route_document_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = envelope.decode_documents(document_messages(spark, sf_dir), ["operationType"])
    routed = routing.route_documents(got)
    return routed.groupBy(F.col("operationType").alias("type"), "action").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    f"""with {S.DOCS}
select seq as "offset", 'shop-profile' as topic, t as time, i as inc, id as _id,
  case when type <> 'delete' then pk end as pk from docs"""
)
def change_stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics, both key forms and driver time texts of document changes."""
    got = envelope.stream_envelopes(envelope.decode_documents(document_messages(spark, sf_dir)))
    pk = F.coalesce(*[F.try_element_at("fullDocument", F.lit(f"p{i}")) for i in range(3)])
    return got.select(
        F.col("m_offset").alias("offset"), "topic", "clusterTime.time",
        F.col("clusterTime.inc").cast("bigint").alias("inc"), "_id", pk.cast("bigint").alias("pk"),
    )


_TABLES = ["db0.t1", "db1.t2", "db2.t0"]


@query(
    f"""with {S.LOG} select db as database, tbl as "table", count(*) as n, max(seq) as last_seq from log
where (db, tbl) in (('db0', 't1'), ('db1', 't2'), ('db2', 't0')) group by 1, 2"""
)
def table_filter_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = routing.keep_tables(account_log(spark, sf_dir), _TABLES)
    return kept.groupBy("database", "table").agg(
        F.count(F.lit(1)).alias("n"), F.max("seq").alias("last_seq")
    )


@query(
    f"""with {S.LOG} select db as database, tbl as "table", count(*) as n from log
where db in ('db0', 'db1', 'db2') and tbl in ('t0', 't1', 't2') group by 1, 2"""
)
def table_filter_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = routing.keep_schemas(account_log(spark, sf_dir), _TABLES)
    return kept.groupBy("database", "table").agg(F.count(F.lit(1)).alias("n"))


@query(
    """select event_id, 'db' || (user_id % 3) || '-t' || (event_id % 4) as topic,
  'db' || (user_id % 3) || '.t' || (event_id % 4) as key,
  case when event_id % 2 = 0 then 'db' || (user_id % 3) else 'fallback' end || '.t' || (event_id % 4)
    as target,
  'one.target' as forced from events"""
)
def topic_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics, table addresses, and targets with and without own names."""
    log = account_log(spark, sf_dir)
    named = log.select(
        F.col("seq").alias("event_id"),
        envelope.topic_name(F.col("database"), F.col("table")).alias("topic"),
        envelope.table_key(F.col("database"), F.col("table")).alias("key"),
        F.when(F.col("seq") % 2 == 0, F.col("database")).alias("database"),
        "table",
    )
    own = routing.resolve_row_target(named, "fallback", "none")
    one = routing.resolve_row_target(
        own.withColumnRenamed("target", "own"), "one", "target", forced=True
    )
    return one.select(
        "event_id", "topic", "key", F.col("own").alias("target"), F.col("target").alias("forced")
    )


@query(
    """select doc_id, case when lang = 'en' then 'shop.' || source else 'lib.docs' end as target from documents"""
)
def document_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's own namespace counts only when both parts are there."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.struct(
            F.when(F.col("lang") == "en", "shop").alias("db"), F.col("source").alias("coll")
        ).alias("ns"),
    )
    return routing.resolve_document_target(docs, "lib", "docs").select("doc_id", "target")


@query(
    """select o_orderkey, o_custkey as k, case when o_orderkey % 5 = 0 then null else o_orderstatus end as status,
  case when o_orderkey % 3 = 0 then '1-URGENT' else o_orderpriority end as priority,
  cast(null as bigint) as missing from orders"""
)
def before_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed fields put back over the after image, then projected to typed columns."""
    orders = table(spark, sf_dir, "orders")
    data = F.create_map(
        F.lit("k"), F.col("o_custkey").cast("string"),
        F.lit("status"), F.col("o_orderstatus"),
        F.lit("priority"), F.col("o_orderpriority"),
    )
    none = F.create_map().cast("map<string,string>")
    urgent = F.when(
        F.col("o_orderkey") % 3 == 0, F.create_map(F.lit("priority"), F.lit("1-URGENT"))
    ).otherwise(none)
    cleared = F.when(
        F.col("o_orderkey") % 5 == 0, F.create_map(F.lit("status"), F.lit(None).cast("string"))
    ).otherwise(none)
    images = orders.select("o_orderkey", data.alias("data"), F.map_concat(urgent, cleared).alias("old"))
    fields = {"k": "bigint", "status": "string", "priority": "string", "missing": "bigint"}
    return routing.before_image(images).select(
        "o_orderkey", *routing.project(F.col("before"), fields)
    )


@query(
    """select doc_id, text as decoded, length(text) as n_chars, lang as plain,
  cast(null as bigint) as bad_bytes from documents"""
)
def binary_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base64 of whole texts, on one line, decoded again; broken text gives no bytes."""
    docs = table(spark, sf_dir, "documents")
    images = docs.select(
        "doc_id",
        F.create_map(
            F.lit("text"), R.b64_encode(R.to_bytes(F.col("text"))),
            F.lit("lang"), F.col("lang"),
            F.lit("bad"), F.lit("abc"),
        ).alias("data"),
    )
    decoded = routing.decode_binaries(images, ["text", "bad", "absent"])
    text = R.to_text(F.try_element_at("binaries", F.lit("text")))
    return decoded.select(
        "doc_id", text.alias("decoded"), F.length(text).cast("bigint").alias("n_chars"),
        F.col("data")["lang"].alias("plain"),
        F.length(F.try_element_at("binaries", F.lit("bad"))).cast("bigint").alias("bad_bytes"),
    )


@query(
    f"""select event_id, strftime(date_trunc('second', ts) + interval 8 hour, '%Y-%m-%d %H:%M:%S') as created,
  event_type as event_type from events"""
)
def tz_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = routing.shift_timestamps(account_log(spark, sf_dir), ["created"])
    return shifted.select(
        F.col("seq").alias("event_id"),
        F.col("data")["created"].alias("created"),
        F.col("data")["event_type"].alias("event_type"),
    )


@query(
    """with n as (select event_id, ' ' || event_id || ' ' as whole, '+' || event_id as signed,
  cast(value as varchar) as frac, event_type as word, event_id || 'e2' as expo from events)
select event_id, event_id as a, event_id as b, cast(-1 as bigint) as c, cast(-1 as bigint) as d,
  cast(frac as double) as e, cast(event_id as double) * 100 as f, cast(-2.0 as double) as g,
  true as h, event_id as i, cast(frac as double) as j, cast(-3.0 as double) as k, false as l from n"""
)
def scalar_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number conversions over texts made of every event."""
    text = F.col("event_id").cast("string")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit(" "), text, F.lit(" ")).alias("whole"),
        F.concat(F.lit("+"), text).alias("signed"),
        F.col("value").cast("string").alias("frac"),
        F.col("event_type").alias("word"),
        F.concat(text, F.lit("e2")).alias("expo"),
    )
    number = R.to_number(F.col("signed"))
    return rows.select(
        "event_id",
        R.to_int(F.col("whole"), -1).alias("a"),
        R.to_int(F.col("signed"), -1).alias("b"),
        R.to_int(F.concat("signed", F.lit(".0")), -1).alias("c"),
        R.to_int(F.col("word"), -1).alias("d"),
        R.to_float(F.col("frac"), -2.0).alias("e"),
        R.to_float(F.col("expo"), -2.0).alias("f"),
        R.to_float(F.col("word"), -2.0).alias("g"),
        number["is_int"].alias("h"),
        number["int_value"].cast("bigint").alias("i"),
        R.to_number(F.col("frac"))["value"].alias("j"),
        R.to_number(F.col("expo"), -3.0)["value"].alias("k"),
        R.to_number(F.col("frac"))["is_int"].alias("l"),
    )


@query(
    f"""select event_id, {S.CREATED} as parsed, strftime(ts, '%Y-%m-%d') as day,
  cast(null as varchar) as bad, '1970-01-01' as default_day,
  strftime(ts, '%Y-%m-%d') || ' 00:00:00' as day_text,
  strftime(date_trunc('second', ts) + interval 8 hour, '%Y-%m-%d %H:%M:%S') as shanghai,
  strftime(date_trunc('second', ts) - interval 8 hour, '%Y-%m-%d %H:%M:%S') as utc from events"""
)
def scalar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date conversions over texts made of every event."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("ts").cast("string").alias("text"), "event_type"
    )
    parsed = R.parse_seconds(F.col("text"))
    return rows.select(
        "event_id",
        R.format_seconds(parsed).alias("parsed"),
        R.to_day(F.col("text"), is_text=True).cast("string").alias("day"),
        R.parse_seconds(F.col("event_type")).cast("string").alias("bad"),
        R.to_day(F.col("event_type"), is_text=True).cast("string").alias("default_day"),
        R.format_day(R.parse_day(F.col("text"))).alias("day_text"),
        R.format_seconds(R.to_shanghai(parsed)).alias("shanghai"),
        R.format_seconds(R.to_utc(parsed)).alias("utc"),
    )


@query(
    f"""select event_id, {S.EPOCH} as time, event_id % 9 as inc, {S.EPOCH} as time2, event_id % 9 as inc2,
  case event_id % 3 when 0 then 'bin.' || event_id end as token_text,
  case event_id % 3 when 1 then event_id end as token_number from events"""
)
def position_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions through their stored and driver texts; token fields by name."""
    from rivulet.plans.inputs import epoch_seconds

    rows = table(spark, sf_dir, "events").select(
        "event_id", epoch_seconds(F.col("ts")).alias("t"), (F.col("event_id") % 9).alias("i")
    )
    stored = R.position_from_json(R.position_to_json(F.col("t"), F.col("i")))
    driver = R.cluster_time(F.format_string("Timestamp(%d, %d)", "t", "i"))
    turn = F.col("event_id") % 3
    name = F.when(turn == 0, "log_file").when(turn == 1, "log_pos").otherwise("server_id")
    value = F.when(turn == 0, F.concat(F.lit("bin."), F.col("event_id"))).when(
        turn == 1, F.col("event_id").cast("string")
    ).otherwise("x")
    token = R.decode_token(name, value)
    return rows.select(
        "event_id",
        stored["time"].alias("time"),
        stored["inc"].cast("bigint").alias("inc"),
        driver["time"].alias("time2"),
        driver["inc"].cast("bigint").alias("inc2"),
        token["text"].alias("token_text"),
        token["number"].alias("token_number"),
    )


@query(
    f"""with {S.LOG}
select topic, count(*) as n, min(seq) as first_offset, max(seq) as last_offset from log
where topic in ('events-click', 'events-error') group by 1"""
)
def message_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written by topic and read back with a topic filter."""
    path = scratch_dir(spark, "messages")
    write_files(account_messages(spark, sf_dir), path)
    got = read_files(spark, path, topics="events-click,events-error")
    return got.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


@query(
    f"""with {S.LOG}
select case when tbl = 't0' then 'fixed' else db || '-' || tbl end as topic, count(*) as n,
  max(seq) as last_seq from log group by 1"""
)
def message_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed topic for one table's messages and each table's own for the rest."""
    log = account_log(spark, sf_dir).withColumn(
        "topic", envelope.topic_name(F.col("database"), F.col("table"))
    )
    fixed = envelope.encode_messages(log.where(F.col("table") == "t0"), "fixed")
    own = envelope.encode_messages(log.where(F.col("table") != "t0"))
    got = envelope.decode_rows(fixed.unionByName(own))
    return got.groupBy(F.col("m_topic").alias("topic")).agg(
        F.count(F.lit(1)).alias("n"), F.max("xid").alias("last_seq")
    )


__all__ = ["ACCOUNT"]
